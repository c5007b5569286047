import random

import pytest
from pyspark.sql import functions as F

from tributary.operators.ordering import row_rank, running_total
from tributary.operators.packing import batch_size_stats, pack_batches, pack_by_count
from tributary.sources.pods import merge_partial_lines


def greedy(rows, max_events, max_bytes):
    state, out = {}, {}
    for key, order, size in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        events, used, batches, seen = state.get(key, (0, 0, 0, 0))
        if events == 0 or events >= max_events or used + size > max_bytes:
            events, used, batches = 0, 0, batches + 1
        state[key] = (events + 1, used + size, batches, seen + 1)
        out[(key, order)] = (seen + 1, batches - 1)
    return out


def packed(spark, rows, max_events, max_bytes, chunks):
    df = spark.createDataFrame(rows, "k string, o bigint, s bigint")
    got = pack_batches(df, ["k"], ["o"], size=F.col("s"), max_events=max_events, max_bytes=max_bytes, chunks=chunks)
    return {(r.k, r.o): (r.seq, r.batch_id) for r in got.collect()}


@pytest.mark.parametrize("seed", range(6))
def test_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    hot = rnd.choice([0.3, 0.9, 1.0])
    keys = ["hot" if rnd.random() < hot else f"k{rnd.randrange(30)}" for _ in range(rnd.choice([50, 700, 2500]))]
    rows = [(None if k == "k0" else k, i, rnd.choice([1, 5, 9, 20, 70])) for i, k in enumerate(keys)]
    max_events, max_bytes = rnd.choice([(7, 60), (1000, 10**6), (3, 1000), (50, 300), (1000, 50), (1, 10)])
    chunks = rnd.choice([1, 7, 13, 40])
    assert packed(spark, rows, max_events, max_bytes, chunks) == greedy(rows, max_events, max_bytes)


# The published batch cases: (sizes of messages, limits) -> events per batch.
CASES = {
    "count": ([14] * 1500, 1000, 1_037_576, [1000, 500]),
    "bytes": ([1] * 38_899, 50_000, 1_047_576, [38_799, 100]),
    "large": ([200 * 1024] * 10, 1000, 1_037_576, [5, 5]),
    "both": ([1021] * 2000, 10_000, 1_047_576, [1000, 1000]),
    "one over": ([1000] * (1_047_576 // 1026 + 1), 10_000, 1_047_576, [1021, 1]),
    "oversize alone": ([10, 2_000_000, 10], 1000, 1_037_576, [1, 1, 1]),
}


@pytest.mark.parametrize("name", CASES)
def test_published_cases(spark, name):
    sizes, max_events, max_bytes, want = CASES[name]
    got = packed(spark, [("s", i, n + 26) for i, n in enumerate(sizes)], max_events, max_bytes, 5)
    counts = [0] * len(want)
    for _, batch in got.values():
        counts[batch] += 1
    assert counts == want


def test_messages_are_measured_in_bytes(spark):
    df = spark.createDataFrame([("a", 1, "é" * 10), ("a", 2, "x" * 10)], "k string, o int, message string")
    got = {r.o: r.batch_id for r in pack_batches(df, ["k"], ["o"], max_bytes=46 + 35, chunks=2).collect()}
    assert got == {1: 0, 2: 1}
    stats = batch_size_stats(pack_batches(df, ["k"], ["o"], chunks=2), ["k"]).first()
    assert (stats.events, stats.total_bytes, stats.message_bytes, stats.overhead_bytes) == (2, 82, 30, 52)


def test_overhead_share(spark):
    df = spark.createDataFrame([("s", i, m) for i, m in enumerate(["a", "bb", "ccc"])], "k string, o int, message string")
    stats = batch_size_stats(pack_batches(df, ["k"], ["o"], chunks=2), ["k"]).first()
    assert stats.total_bytes == 84 and stats.overhead_pct > 90


def test_count_packing_and_ranks(spark):
    rows = [("hot" if i % 3 else f"k{i % 7}", i) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, o bigint")
    got = {(r.k, r.o): (r.seq, r.batch_id) for r in pack_by_count(df, ["k"], ["o"], 4, chunks=6).collect()}
    assert got == greedy([(k, o, 1) for k, o in rows], 4, 10**9)
    ranks = {(r.k, r.o): r.rk for r in row_rank(df, ["k"], ["o"], "rk", chunks=9).collect()}
    assert ranks == {key: seq for key, (seq, _) in got.items()}


def test_running_total(spark):
    rnd = random.Random(3)
    rows = [(None if i % 5 == 0 else "a", i, rnd.randrange(-3, 9)) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, o int, v int")
    for inclusive in (True, False):
        got = {(r.k, r.o): r.t for r in running_total(df, ["k"], ["o"], F.col("v"), "t", inclusive, 7).collect()}
        totals, want = {}, {}
        for k, o, v in rows:
            before = totals.get(k, 0)
            totals[k] = before + v
            want[(k, o)] = before + v if inclusive else before
        assert got == want


def test_partial_lines(spark):
    pieces = ["ab", "cd", "ef", "gh", "i", "j"]
    partial = [True, False, False, True, True, True]
    rows = [("c", i, p, t) for i, (p, t) in enumerate(zip(partial, pieces))]
    df = spark.createDataFrame(rows, "c string, n int, p boolean, t string")
    got = merge_partial_lines(df, ["c"], ["n"], "p", "t", chunks=3).orderBy("run").collect()
    assert [r.t for r in got] == ["abcd", "ef", "ghij"]
