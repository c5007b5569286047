import math
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tributary.llm import queries
from tributary.llm import quality_classifier as Q

FOLDER = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    got = queries.JOBS["op8_quality_classifier"](spark, FOLDER).toPandas()
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").toPandas()
    assert len(got) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert got.score.between(0, 1).all() and ((got.score >= 0.3) == (got.predicted == 1)).all()
    own = got[got.held_out].merge(labels, on="doc_id")
    right = (own.predicted == own.quality).mean()
    kept = own[own.quality == 1].predicted.mean()
    assert right > 0.97 and kept > 0.99, (right, kept)


def test_indicators_are_those_of_each_text_alone():
    texts = ["a b c", "", None, "x x x x y", "é" * 50, "\n\n", "a b c"] * 60
    together = np.concatenate([b for _, b in Q.indicators(pa.chunked_array([pa.array(texts)]))])
    alone = {t: next(Q.indicators(pa.chunked_array([pa.array([t])])))[1][0] for t in set(texts)}
    assert len(together) == len(texts)
    for t, row in zip(texts, together):
        assert (row == alone[t]).all()
    assert alone["x x x x y"][[2, 3, 4]].all()


def test_dual_descent_separates():
    rng = np.random.default_rng(1)
    rows = [np.unique(np.append(rng.integers(10, 200, 20), 5 if i % 2 else 7)) for i in range(200)]
    sign = np.where(np.arange(200) % 2, 1.0, -1.0)
    w, bias = Q._dual_descent(rows, sign, np.ones(Q.BUCKETS))
    assert all((w[x].sum() + bias) * s > 0 for x, s in zip(rows, sign))


def test_edges(spark):
    df = spark.createDataFrame([(1, "good text here", 1), (2, "$$$ *** %%%", 0), (3, None, None), (3, "x", 5), (None, "", 1), (1, "good text here", 1)], "doc_id bigint, text string, label int")
    model = Q.fit(df)
    got = Q.score(df, model).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert Q.score(df.where("false"), model).count() == 0
    one_class = Q.fit(df.where("label = 1"))
    assert len({r.score for r in Q.score(df, one_class).collect()}) == 1
    assert Q.fit(df.where("false")).probability(np.zeros(1))[0] == 0.5


def features(text):
    """Buckets of one text, from the description alone."""
    data = [32 if b < 33 else b for b in (text or "").encode() + b"\n"]
    out = set()
    for a, b, c in zip(data, data[1:], data[2:]):
        g = (a * 0x9E3779B1 + b * 0x85EBCA77 + c * 0xC2B2AE3D) % 2**32
        out.add(((g ^ (g >> 15)) * 0x85EBCA77 % 2**32) >> 17)
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    out |= {n for n in (2, 3, 4) for i in range(len(words) - n + 1) if len(set(words[i : i + n])) == 1}
    return sorted(out)


def descend(rows, signs, ratio, cost=0.05):
    """Dual coordinate descent on dictionaries; the order of rows follows the same random numbers."""
    w, bias, alpha = {}, 0.0, [0.0] * len(rows)
    share = {s: len(signs) / max(1, 2 * signs.count(s)) for s in (1, -1)}
    rng = np.random.default_rng(7)
    for _ in range(Q.EPOCHS):
        largest = 0.0
        for i in rng.permutation(len(rows)).tolist():
            g = signs[i] * (sum(w.get(f, 0.0) * ratio[f] for f in rows[i]) + bias) - 1
            new = min(max(alpha[i] - g / (sum(ratio[f] ** 2 for f in rows[i]) + 1), 0.0), cost * share[signs[i]])
            step, alpha[i] = new - alpha[i], new
            for f in rows[i]:
                w[f] = w.get(f, 0.0) + step * signs[i] * ratio[f]
            bias += step * signs[i]
            largest = max(largest, abs(step))
        if largest < 1e-4:
            break
    return lambda x: sum(w.get(f, 0.0) * ratio[f] for f in x) + bias


def test_scores_against_plain_python(spark):
    rng = random.Random(2)
    word = lambda good: "".join(rng.choice("etaoin srhl" if good else "xqz$#9 *") for _ in range(rng.randint(2, 8)))
    rows = [(i, " ".join(word((i % 3 > 0) ^ (rng.random() < 0.2)) for _ in range(rng.randint(0, 25))), int(i % 3 > 0)) for i in range(90)]
    rows += [(200, "same same same same", 0), (201, None, 1), (202, "é" * 9, 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, label int")
    order = [(r.text, r.label) for r in df.orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
    xs, signs = [features(t) for t, _ in order], [1 if y else -1 for _, y in order]
    count = {s: [1.0] * Q.BUCKETS for s in (1, -1)}
    for x, s in zip(xs, signs):
        for f in x:
            count[s][f] += 1
    total = {s: sum(count[s]) for s in (1, -1)}
    ratio = [math.log(a / total[1]) - math.log(b / total[-1]) for a, b in zip(count[1], count[-1])]
    margins = [0.0] * len(xs)
    for side in (0, 1):
        other = [i for i in range(len(xs)) if i % 2 != side]
        rate = descend([xs[i] for i in other], [signs[i] for i in other], ratio)
        for i in range(side, len(xs), 2):
            margins[i] = rate(xs[i])
    # The curve through the margins: the same penalised likelihood, found by small steps.
    pos, neg = signs.count(1), signs.count(-1)
    target = [(pos + 1) / (pos + 2) if s > 0 else 1 / (neg + 2) for s in signs]
    model = Q.fit(df)
    p = [1 / (1 + math.exp(-(model.slope * m + model.shift))) for m in margins]
    assert abs(sum((t - q) * m for t, q, m in zip(target, p, margins)) - 1e-3 * (model.slope - 1)) < 1e-4  # its gradient is nil
    assert abs(sum(t - q for t, q in zip(target, p)) - 1e-3 * model.shift) < 1e-4
    rate = descend(xs, signs, ratio)
    want = {i: 1 / (1 + math.exp(-(model.slope * rate(features(t)) + model.shift))) for i, t, _ in rows}
    got = {r.doc_id: r.score for r in Q.score(df, model).collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-4 for i in want)


def test_clashing_columns_and_null_ids(spark):
    df = spark.createDataFrame([(None, "good text", 1, 2.0, "p"), (3, "$$$", 0, 1.0, "q")], "doc_id bigint, text string, label int, `__score` double, predicted string")
    out = Q.score_rows(df, Q.fit(df))
    assert out.columns == ["doc_id", "text", "label", "__score", "score", "predicted"] and out.count() == 2
    assert [r.h for r in df.select(Q.held_out().alias("h")).collect()][0] is False
