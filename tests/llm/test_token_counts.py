import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tributary.llm import token_counts as T

PATH = public_tokenizers.path("word_bpe_49k.json")
PARTS = [
    "the", " of", "  ", "\n", "'re", "'", "it's", "x" * 40, "1234", "é", "́", "́" * 9, "é", "日本", "한", "한", "<|endoftext|>", "<|endof", "text|>", "|>", "<|startoftext|>",
    "...", "!?", "≠", "Å", "Å", "İ", "ß", " ", "\x85", "\x1c", "\x00", "\U0001f600‍\U0001f525", "Ķ́",
]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


def tokens(plain, text):
    return len(plain.encode(text or "", add_special_tokens=False).ids)


def made(rng, n):
    return "".join(rng.choice(PARTS) for _ in range(rng.randint(0, n)))


@pytest.mark.parametrize("chunk, overlap", [(3, 1), (24, 2), (40, 8), (64, 60)])
def test_spliced_chunks_equal_whole_texts(plain, chunk, overlap):
    rng = random.Random(chunk)
    count = T.Counter(PATH, chunk, overlap)
    for k in range(250):
        text = made(rng, 80)
        if k % 5 == 0:  # no boundary for a long way: the overlap has to widen
            text += rng.choice(["a", "́", "=", "日"]) * rng.randint(50, 400) + made(rng, 20)
        assert count.resynchronised(text) == tokens(plain, text), repr(text)


def test_batches_and_memory_of_units(plain, monkeypatch):
    import pyarrow as pa

    rng = random.Random(4)
    texts = [made(rng, 60) for _ in range(300)] + [None, "", " \n", "word " * 9000, "y" * 40_000]
    for remembered in (5, 10**6):
        monkeypatch.setattr(T, "REMEMBERED", remembered)
        count = T.Counter(PATH)
        for at in range(0, len(texts), 50):
            assert count.count(pa.chunked_array([pa.array(texts[at : at + 50])])).tolist() == [tokens(plain, t) for t in texts[at : at + 50]]


def test_rows(spark, plain):
    long = "The  naïve café—" * 9000 + "z" * 50_000
    rows = [(1, "a b"), (1, "a b"), (2, None), (3, ""), (None, "it's <|endoftext|>"), (4, long)]
    df = spark.createDataFrame([(*r, 5, 6) for r in rows], "doc_id bigint, text string, n_tokens int, n_bytes int").repartition(3)
    got = sorted(map(tuple, T.count_tokens(df, PATH, limit=3).collect()), key=str)
    assert got == sorted(((i, len((t or "").encode()), tokens(plain, t), tokens(plain, t) > 3) for i, t in rows), key=str)
    assert T.count_tokens(df.where("false"), PATH).collect() == []


def test_other_tokenizers_are_refused(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    with pytest.raises(ValueError):
        T.count_tokens(df, public_tokenizers.path("byte_bpe_50k.json"))  # white space is part of its tokens


def test_query(spark, plain):
    from tributary.llm import queries

    from .conftest import FOLDER

    got = {r.doc_id: r for r in queries.JOBS["op13_token_counts"](spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        n = tokens(plain, d.text)
        assert tuple(got[d.doc_id]) == (d.doc_id, len((d.text or "").encode()), n, n > 2048)
