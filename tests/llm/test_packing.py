import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tributary.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    made = Tokenizer.from_file(PATH)
    made.encode_special_tokens = True
    return made


ODD = ["", " ", "\n", " \n  a", "a  b\t\n c ", "it's  we'll x   y", "  z", "é è　 ß", "a\u0085 b", "<|endoftext|> a", "x\r\n\r\n  y\n", "\x1c a\x1c b", "0 12 345,67", "日本 語", "\x00a\x00 b", "a.b,c!! d's.", "x_y-z''q", "é. à,b…,c", "A***b ###"]


def test_ids_are_those_of_whole_texts(plain, monkeypatch):
    import pyarrow as pa

    rng = random.Random(5)
    texts = ODD + ["".join(rng.choice(ODD + ["the", " of", "!!", " ", " "]) for _ in range(rng.randint(0, 30))) for _ in range(300)]
    for remembered in (10, 4_000_000):
        monkeypatch.setattr(packing, "REMEMBERED_IDS", remembered)
        packing._encoders.clear()
        for at in range(0, len(texts), 7):
            part = texts[at : at + 7]
            got = packing.token_ids(pa.chunked_array([pa.array(part + [None])]), PATH)
            assert [x.tolist() for x in got] == [plain.encode(t, add_special_tokens=False).ids for t in part] + [[]]


def check(rows, window, plain, want):
    by_place = {(r.sequence_id, r.offset): r for r in rows}
    assert len(by_place) == len(rows)
    at = 0
    while at < sum(r.length for r in rows):
        r = by_place.pop((at // window, at % window))  # gapless: windows are full but for the last
        assert r.offset + r.length <= window and r.length > 0
        at += r.length
    docs = {}
    for r in sorted(rows, key=lambda r: r.start):
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(ids) == r.length
        docs.setdefault(r.doc_id, []).append((r.start, ids, r.doc_tokens))
    got = {}
    for i, parts in docs.items():
        assert [p[0] for p in parts] == [sum(len(q[1]) for q in parts[:k]) for k in range(len(parts))]
        got[i] = [x for p in parts for x in p[1]]
        assert {p[2] for p in parts} == {len(got[i])}
    assert got == want


def test_pieces(spark, plain):
    rng = random.Random(2)
    rows = [(i, rng.choice(ODD) + " word%d" % i * rng.randint(0, 60)) for i in range(120)] + [(500, None), (501, ""), (None, "no id")]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id bigint, text string, part int, base int").repartition(5)
    got = packing.pack(df, PATH, window=64).collect()
    check(got, 64, plain, {i: plain.encode(t or "", add_special_tokens=False).ids + [1] for i, t in rows})
    assert packing.pack(df.where("false"), PATH).collect() == []


def test_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b")], "doc_id bigint, text string")
    got = packing.pack(df, PATH, with_ids=False).collect()
    assert sorted((r.sequence_id, r.offset, r.length, r.doc_tokens) for r in got) == [(0, 0, 3, 3), (0, 3, 3, 3)]
