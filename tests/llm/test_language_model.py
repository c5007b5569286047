import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tributary.llm import blocks
from tributary.llm import language_model as L

FOLDER = "/root/testdata/sf0.01"


def tokens_of(t):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None]


@pytest.fixture(scope="module")
def rows(spark):
    found = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    return found + [(90001, None), (90002, ""), (90003, "UNSEENWORD unseenword"), (0, found[0][1]), (None, "Null id")]


def test_base_and_gain(spark, rows, monkeypatch):
    monkeypatch.setattr(L, "BLOCK_BYTES", 300_000)
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, block int").repartition(7)
    got = L.score(df).collect()
    learnt = Counter(t for i, x in rows if i is None or zlib.crc32(str(i).encode()) % 7 != 2 for t in tokens_of(x))
    n, v = sum(learnt.values()), len(learnt)
    want = Counter()
    for i, x in rows:
        ts = tokens_of(x)
        want[i, i is not None and zlib.crc32(str(i).encode()) % 7 == 2, len(ts), sum(t in learnt for t in ts), n, round(sum(math.log10((learnt[t] + 1) / (n + v + 1)) for t in ts), 4)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    held = [r for r in got if r.held_out]
    assert all(r.score < 0 for r in got)
    assert sum(r.score for r in held) > 0.98 * sum(r.base_score for r in held)


def test_probabilities_sum_to_one(spark):
    """Over all known tokens and one unknown word of each class."""
    texts = ["the cat sat on the mat", "the dog sat on a log", "a cat and a dog", "le chat et le chien"] * 5
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    found = {}
    trained = L.train
    L.train = lambda *a: found.setdefault("model", trained(*a))
    try:
        L.score(df).collect()
    finally:
        L.train = trained
    model = found["model"]
    learnt = Counter(t for i, x in enumerate(texts) if zlib.crc32(str(i).encode()) % 7 != 2 for t in tokens_of(x))
    assert model.n_tokens == sum(learnt.values()) and model.n_types == len(learnt)
    known = sorted(t for t in learnt if t)
    t = L.tokenize(pa.array([" ".join(known)]))
    kind, count = model.classes(t), np.array([learnt[w] for w in known] + [learnt[None]])
    within = np.bincount(kind, weights=10 ** model.word_log(kind, count), minlength=L.CLASSES)
    unseen = np.where(np.arange(L.CLASSES) < L.ALONE, 0, 1 / (model.tokens + model.types + 1))
    used = np.arange(L.CLASSES) < len(model.alone)
    assert np.allclose((within + unseen)[used | (np.arange(L.CLASSES) >= L.ALONE)], 1)
    p = np.exp(L.class_logits(model.weights, L.feature_rows(t, kind)))
    assert p.shape == (len(known) + 1, L.CLASSES)


def test_features_do_not_cross_texts():
    alone = L.tokenize(pa.array(["a b c d"]))
    both = L.tokenize(pa.array(["x y z", "a b c d", None]))
    kind = lambda t: t.kind.astype(np.int64)
    assert (L.feature_rows(both, kind(both))[:, 4:9] == L.feature_rows(alone, kind(alone))).all()
    assert both.per_text.tolist() == [4, 5, 1]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert L.score(df).collect() == [] and blocks.total_bytes(df) == 0


M64 = 2**64


def mix(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 % M64
    x ^= x >> 27
    x = x * 0x94D049BB133111EB % M64
    return x ^ (x >> 31)


END = int(L.END)


def hashed(word):
    if word is None:
        return END
    return mix((sum((b + 1) * pow(0x9E3779B97F4A7C15, k, M64) for k, b in enumerate(word.encode())) + len(word.encode())) % M64)


def form(word):
    if word is None:
        return 0
    b = word.encode()
    return L.ALONE + mix(b[-1] * 256 + (b[-2] if len(b) > 1 else 0)) % (L.CLASSES - L.ALONE)


def test_scores_against_plain_python(spark):
    """Counts, four gradient steps and the softmax once more, on dictionaries."""
    rng = random.Random(6)
    vocabulary = [f"{rng.choice('abcdeé')}{rng.choice('xyz')}{i % 9}" for i in range(40)]
    rows = [(i, " ".join(rng.choices(vocabulary, [1 / (k + 1) for k in range(40)], k=rng.randint(0, 30)))) for i in range(60)] + [(500, None), (501, "Never SEEN before")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    step_of = {r.doc_id: r.s for r in df.select("doc_id", F.expr(f"pmod(xxhash64(doc_id, 1), {L.STEPS})").alias("s")).collect()}
    learnt = [(i, t) for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    count = Counter(w for _, t in learnt for w in tokens_of(t))
    signed = lambda w: hashed(w) - M64 * (hashed(w) >= M64 // 2)
    top = sorted((w for w in count if w is not None), key=lambda w: (-count[w], signed(w)))[: L.ALONE - 1]
    kind = lambda w: 0 if w is None else top.index(w) + 1 if w in top else form(w)
    tokens, types = Counter(), Counter()
    for w, n in count.items():
        tokens[kind(w)] += n
        types[kind(w)] += 1
    whole = sum(tokens.values())
    weights = {(0, c): math.log((tokens[c] + 0.5) / (whole + 0.5 * L.CLASSES)) for c in range(L.CLASSES)}

    def features(ws, i):
        back = lambda k: ws[i - k] if i >= k else None
        c1, c2, c3 = (kind(back(k)) for k in (1, 2, 3))
        word = lambda k: mix((hashed(back(k)) + k) % M64) % L.WORD_ROWS
        n, m = L.WORD_ROWS, L.PAIR_ROWS
        return [0, 1 + word(1), 1 + n + c1 * L.CLASSES + c2, 1 + n + m + word(2), 1 + 2 * n + m + c2 * L.CLASSES + c3]

    def softmax(rows_):
        z = [math.exp(sum(weights.get((r, c), 0.0) for r in rows_)) for c in range(L.CLASSES)]
        return [x / sum(z) for x in z]

    for step, rate in enumerate(L.RATES):
        seen, expected = Counter(), Counter()
        for i, t in learnt:
            ws = tokens_of(t)
            for k in range(len(ws)) if step_of[i] == step else ():
                fs = features(ws, k)
                for c, p in enumerate(softmax(fs)):
                    for f in fs:
                        expected[f, c] += p
                for f in fs:
                    seen[f, kind(ws[k])] += 1
        for cell in expected:
            weights[cell] = weights.get(cell, 0.0) + rate * (seen[cell] - expected[cell]) / (max(seen[cell], expected[cell]) + L.SMOOTHING)
    got = {r.doc_id: r.score for r in L.score(df).collect()}
    for i, t in rows:
        ws, want = tokens_of(t), 0.0
        for k, w in enumerate(ws):
            c = kind(w)
            want += math.log10(softmax(features(ws, k))[c]) + (0 if c < L.ALONE else math.log10((count[w] + 1) / (tokens[c] + types[c] + 1)))
        assert abs(got[i] - want) < 1e-3 * (1 + abs(want)), (i, got[i], want)


def test_history_of_frequent_words(spark, monkeypatch):
    """The word factor follows the previous word: one softmax in each class, fitted to the counts of pairs, better on held-out texts."""
    monkeypatch.setattr(L, "CUTOFF", 20)
    rng = random.Random(3)
    words = [f"{w}ab" for w in "cdefghijklmnop"] + [f"{w}xy" for w in "cdefghijklmnop"]  # two classes by form
    after = {w: rng.sample(words, 3) for w in words}
    texts = []
    for _ in range(300):
        text = [rng.choice(words)]
        for _ in range(20):
            text.append(rng.choice(after[text[-1]]) if rng.random() < 0.8 else rng.choice(words))
        texts.append(" ".join(text))
    df = spark.createDataFrame([*enumerate(texts)], "doc_id bigint, text string").repartition(3)
    found, trained = [], L.train
    monkeypatch.setattr(L, "train", lambda *a: found.append(trained(*a)) or found[0])
    got = L.score(df).collect()
    model = found[0]
    learnt = [tokens_of(t) for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 7 != 2]
    count = Counter(w for ws in learnt for w in ws)
    frequent = {int(h): k for k, h in enumerate(model.frequent)}
    names = [w for w in words if hashed(w) in frequent]
    assert len(names) == len(frequent) == len(words) - (L.ALONE - 1)
    row = lambda w: mix((hashed(w) + 1) % M64) % L.WORD_ROWS
    # The sum over a class after any word is one: its frequent words and the words never seen (no other word is known here).
    for kind in {form(w) for w in names}:
        whole = model.tokens[kind] + model.types[kind] + 1
        for before in [None, *words]:
            z = model.sums()[row(before), kind]
            inside = sum((count[w] + 1) / whole * math.exp(model.pair_weights[row(before), frequent[hashed(w)]] - z) for w in names if form(w) == kind)
            assert abs(inside + math.exp(-z) / whole - 1) < 1e-5
    # Scores of the texts, on dictionaries; the class factor is taken from the model.
    for r in got[:20]:
        ws = tokens_of(texts[r.doc_id])
        t = L.tokenize(pa.array([texts[r.doc_id]]))
        kinds = model.classes(t)
        logits = L.class_logits(model.weights, L.feature_rows(t, kinds))
        want = float((logits[np.arange(len(ws)), kinds] - np.log(np.exp(logits).sum(axis=1))).sum() / math.log(10))
        for before, w, k in zip([None, *ws], ws, kinds):
            if k >= L.ALONE:
                own = model.pair_weights[row(before), frequent[hashed(w)]] if hashed(w) in frequent else 0.0
                want += math.log10((count[w] + 1) / (model.tokens[k] + model.types[k] + 1)) + (own - model.sums()[row(before), k]) / math.log(10)
        assert abs(r.score - want) < 1e-3 * (1 + abs(want))
    monkeypatch.setattr(L, "CUTOFF", 10**9)
    found.clear()
    plain = sum(r.score for r in L.score(df).collect() if r.held_out)
    assert sum(r.score for r in got if r.held_out) > plain + 0.05 * abs(plain)
