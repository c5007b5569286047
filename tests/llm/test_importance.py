import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tributary.llm import crc
from tributary.llm import importance as I


def test_query_against_sql(against_sql):
    against_sql("op12_importance_resampling")


def test_crc_of_many_and_joined():
    rng = random.Random(1)
    parts = [bytes(rng.randrange(256) for _ in range(rng.choice([0, 1, 2, 7, 63, 64, 65, 300]))) for _ in range(400)]
    data = np.frombuffer(b"".join(parts), np.uint8)
    end = np.cumsum([len(p) for p in parts])
    start = end - np.array([len(p) for p in parts])
    got = crc.crc32s(data, start, end)
    assert got.tolist() == [zlib.crc32(p) for p in parts]
    before = np.array([zlib.crc32(b"x:")] * len(parts), np.uint32)
    assert crc.crc32s(data, start, end, before).tolist() == [zlib.crc32(b"x:" + p) for p in parts]
    other = got[::-1].copy()
    assert crc.joined(got, other, (end - start)[::-1]).tolist() == [zlib.crc32(a + b) for a, b in zip(parts, parts[::-1])]


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def grams(text, n):
    w = words(text)
    return [" ".join(w[i : i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


TEXTS = ["", None, "one", "A a-a_A  1a", "é È ß ÀB", " lead\ntail ", "日本 語x x日", "w" * 500, "a b a b a", "\x00q\x7fz~"]


@pytest.mark.parametrize("limit", [0, 3, 50, 10**6])
@pytest.mark.parametrize("n", [1, 2, 3])
def test_features_from_payloads(limit, n):
    """The same CRCs from the automaton, from bytes, and composed; also once the dictionary is full or grows."""
    I._dictionaries.clear()
    rng = random.Random(n)
    for _ in range(6):
        texts = TEXTS + [" ".join(rng.choice(["ab", "abc", "b", "é", "x1", "long" * 30, "c" + str(rng.randint(0, 99))]) for _ in range(rng.randint(0, 40))) for _ in range(20)]
        owner, found, n_words = I.features(pa.array(texts), n, limit)
        for k, t in enumerate(texts):
            assert Counter(found[owner == k].tolist()) == Counter(zlib.crc32(g.encode()) for g in grams(t, n))
            assert n_words[k] == len(words(t))
    assert len(I._dictionaries[limit].word) <= limit


def brute(rows, target, n, buckets, least, percent):
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s = Counter(bucket(g) for _, t in rows for g in grams(t, n))
    t = Counter(bucket(g) for x in target for g in grams(x, n))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    out = []
    for i, text in rows:
        g = grams(text, n)
        weight, score = sum(gain(bucket(x)) for x in g), None
        if i is not None:
            h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(g), weight, score, None, len(words(text)) >= least and i is not None])
    able = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0]))
    for k, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = k
    return sorted((tuple(r[:5]) for r in out), key=str)


@pytest.mark.parametrize("n, percent", [(1, 10), (2, 35)])
def test_draw_against_brute_force(spark, n, percent):
    rng = random.Random(n)
    some = lambda k: " ".join(f"w{int(rng.random() ** 2 * 90)}" for _ in range(k))
    rows = [(i, some(rng.randint(0, 50))) for i in rng.sample(range(10**9), 300)] + [(None, some(30)), (None, None), (5, None), (6, ""), (7, TEXTS[7]), (8, some(25)), (8, rows_text := some(28)), (8, rows_text)]
    target = [some(30).replace("w1", "t1") for _ in range(20)] + [None, ""]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, rank int, score string").repartition(5)
    wanted = spark.createDataFrame([(t, 3) for t in target], "text string, bucket int")
    got = I.resample(docs, wanted, max_words=n, buckets=997, percent=percent)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, target, n, 997, 20, percent)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    some = spark.createDataFrame([(i, "a b c " * 9) for i in range(20)], "doc_id bigint, text string")
    assert I.resample(none, some).collect() == []
    got = I.resample(some, none).collect()
    assert sorted(r.rank for r in got if r.rank) == [1, 2] and len(got) == 20
