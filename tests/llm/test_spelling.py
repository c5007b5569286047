import random
import re
import zlib
from collections import Counter

import pytest

from tributary.llm import spelling as S


def test_query_against_sql(against_sql):
    against_sql("op11_spelling_variants")


def damaged(rows, least, damage):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                n[run] += 1
    return n


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, least=5, count=3, damage=97):
    n = {w: k for w, k in damaged(rows, least, damage).items() if k >= count}
    near = {w: [v for v in n if one_edit(v, w)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdeéÀ") for _ in range(rng.randint(5, 11))) for _ in range(60)]
    base += [f"{rng.choice('abcxyz')}{rng.choice('abcxyz')}{rng.choice('aexyz')}nation" for _ in range(90)] + ["x" * k for k in (5, 6, 7, 90, 91)]
    for w in list(base):
        k = rng.randrange(len(w))
        base += [w[:k] + w[k + 1 :], w[:k] + rng.choice("xyé") + w[k:], w[:k] + rng.choice("xyé") + w[k + 1 :]]
    weight = [rng.choice([1, 2, 5, 12, 30]) for _ in base]
    rows = []
    for i in range(120):
        picked = [w.upper() if rng.random() < 0.1 and w.isascii() else w for w in rng.choices(base, weight, k=120)]
        rows.append((rng.randint(0, 10**6), rng.choice([" ", "1", "\n", "—"]).join(picked)))
    return rows + [(7, None), (8, ""), (None, "straße straße straße Straße"), (9, "a÷bcd×e " * 3), (10, "÷÷÷÷÷ " * 4), (11, "naïve " * 3), (12, "naive " * 9), rows[0], rows[0]]


@pytest.mark.parametrize("seed, pairs", [(1, 4096), (2, 30), (3, 1)])
def test_against_all_pairs(spark, seed, pairs):
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, n int, word string").repartition(5)
    got = [tuple(r) for r in S.variants(df, pairs=pairs).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_all_damage(spark):
    """Every run loses a code point, in many texts of one id too."""
    rows = corpus(5)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {r.word: r.n for r in S.vocabulary(df, damage=1, least_count=1).collect()}
    assert got == dict(damaged(rows, 5, 1))


def test_a_common_chunk_is_parted(spark):
    """3,000 words of one ending: few candidates are left, no near pair is lost."""
    rng = random.Random(9)
    words = {"".join(rng.choice("abcdefghij") for _ in range(5)) + "ation" for _ in range(3000)}
    table = spark.createDataFrame([(w, 3) for w in words], "word string, n bigint")
    path = f"{spark.conf.get('spark.checkpoint.dir')}/ation"
    table.write.mode("overwrite").parquet(path)
    got = {(r.a, r.b) for r in S.near_pairs(spark.read.parquet(path)).collect()}
    want = {(w, w[:i] + c + w[i + 1 :]) for w in words for i in range(5) for c in "abcdefghij"}
    assert got == {(a, b) for a, b in want if a < b and b in words}


def test_paths_of_forms(spark):
    rows = [(f"w{i:03}", f"w{i + 1:03}") for i in range(37)] + [("zz", "w020")]
    got = {r.word: r.root for r in S._roots(spark.createDataFrame(rows, "word string, form string")).collect()}
    assert got == {a: "w037" for a, _ in rows}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert S.variants(df).collect() == []
    assert S.variants(spark.createDataFrame([(1, "solitary solitary solitary")], df.schema).repartition(1)).collect() == [("solitary", None, "solitary", 3, 0, None)]
