import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tributary.llm import quality_rules as Q


def counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if runs[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)), len(covered)


def values(c):
    n_words, chars, symbols, lines, dups, repeats = c
    share = lambda a, b, u: u * a // b if b else 0
    return {"symbols": share(symbols, chars, 1000), "dup_lines": share(dups, lines, 1000), "repeats": share(repeats, n_words, 1000), "word_length": share(chars, n_words, 100)}


def fence(rows):
    out = {}
    for k in Q.FLOORS:
        v = sorted(min(r[k], Q.TOP) for r in rows)
        q1, q3 = (next(x for i, x in enumerate(v, 1) if 4 * i >= q * len(v)) for q in (1, 3))
        width = Q.SPREAD * (q3 - q1) + Q.FLOORS[k]
        out[k] = q1 - width, q3 + width
    return out


def brute(rows):
    by = [defaultdict(list), defaultdict(list), defaultdict(list)]
    for _, t, lang, source in rows:
        for group, key in zip(by, ((lang, source), lang, None)):
            group[key].append(values(counts(t)))
    out = []
    for i, t, lang, source in rows:
        own = next((g[k] for g, k in zip(by[:2], ((lang, source), lang)) if len(g[k]) >= Q.ENOUGH), by[2][None])
        limits, v, c = fence(own), values(counts(t)), counts(t)
        failed = [k for k in Q.FLOORS if v[k] > limits[k][1] or k == "word_length" and v[k] < limits[k][0]]
        base = c[0] < 50 or 100 * c[5] > 50 * c[0]
        out.append((i, c[0], c[1], c[2], c[4], c[5], base, ",".join(failed), not base and not failed))
    return sorted(out, key=str)


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(Q, "ENOUGH", 20)
    rng = random.Random(9)
    rows = []
    for i in range(260):
        words = [rng.choice(["the", "of", "éa", f"w{rng.randint(0, 300)}", "a#b", "|"][: 4 if i % 9 else 6]) for _ in range(rng.randint(0, 160))]
        text = "".join(w + rng.choice([" ", "  ", "\n", "\t"]) for w in words) * rng.choice([1, 1, 1, 2])
        rows.append((i, text, rng.choice(["en", "en", "fr", None, "xx"]), rng.choice(["s0", "s0", "s0", "s1", None])))
    rows += [(900, None, "en", "s0"), (901, "", None, None), (902, "ab " * 9000, "en", "s1"), (903, "x" * 40_000, "en", "s0"), (None, "a b", "fr", "s1"), rows[3], rows[3]]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, lang string, source string, n_words int")
    got = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.failed_rules, r.kept) for r in Q.judge(df).collect()]
    assert sorted(got, key=str) == brute(rows)
    assert Q.judge(df.where("false")).collect() == []


def test_groups_of_long_words(spark):
    """Words of about 40, 900 and 9,000 code points: clean rows are kept, rows of far longer or shorter words are not."""
    rng = random.Random(3)
    rows = []
    for g, size in enumerate((40, 900, 9000)):
        for i in range(220):
            rows.append((1000 * g + i, " ".join(f"{k}".rjust(size + rng.randint(-size // 20, size // 20), "語") for k in range(50)), "ja", f"s{g}"))
        rows += [(1000 * g + 900 + j, " ".join(f"{k}".rjust(n, "語") for k in range(50)), "ja", f"s{g}") for j, n in enumerate((size // 3, 2 * size))]
    got = {r.doc_id: (r.kept, r.failed_rules) for r in Q.judge(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").repartition(8)).collect()}
    assert got == {i: (True, "") if i % 1000 < 900 else (False, "word_length") for i, *_ in rows}


def test_scale(spark):
    v = [0, 1, 1999, 2000, 2001, 2047, 2048, 2049, 4095, 4096, 4099, 10**6, 2**38 + 12345]
    got = [r.s for r in spark.createDataFrame([(x,) for x in v], "v bigint").select("v", Q.scaled(F.col("v")).alias("s")).orderBy("v").collect()]
    assert got == [x if x < 2048 else x >> (x.bit_length() - 11) << (x.bit_length() - 11) for x in v]


def test_sketches_merge(spark):
    df = spark.createDataFrame([(i, "a b c " * (i % 7), "en" if i % 2 else "fr", f"s{i % 3}") for i in range(60)], "doc_id bigint, text string, lang string, source string")
    parts = Q.sketches(Q.measures(df))
    merged = {tuple(r) for r in Q.merge(parts, "lang").select("lang", "measure", "value", "n").collect()}
    whole = {tuple(r) for r in Q.merge(Q.sketches(Q.measures(df.withColumn("source", df["lang"]))), "lang").select("lang", "measure", "value", "n").collect()}
    assert merged == whole
