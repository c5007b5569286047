import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tributary.llm import decontaminate as D


def folded(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute_scores(docs, items):
    """{(doc, item): best passage score over the item's threshold}."""
    ws = [folded(t) for t in items]
    lengths = [len(w) for w in ws if w]
    mean = max(1.0, sum(lengths) / len(lengths)) if lengths else 1.0
    df = Counter(t for w in ws for t in set(w))
    weight = lambda t, w: math.log1p((len(items) - df[t] + 0.5) / (df[t] + 0.5)) * (f := w.count(t)) * (D.K1 + 1) / (f + D.K1 * (1 - D.B + D.B * len(w) / mean))
    out = {}
    for d, text in enumerate(docs):
        w = folded(text)
        for p in range(0, max(1, len(w) - D.HALF), D.HALF):
            terms = set(w[p : p + 2 * D.HALF])
            for i, item in enumerate(ws):
                s = sum(weight(t, item) for t in sorted(set(item) & terms))
                own = sum(weight(t, item) for t in sorted(set(item)))
                if item and s / (D.SHARE * own) >= 1 - 1e-9:
                    out[d, i] = max(out.get((d, i), 0), s / (D.SHARE * own))
    return out


@pytest.fixture
def world():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)] + ["the", "of", "é", "x1"] * 30
    items = [" ".join(rng.choice(words) for _ in range(rng.randint(4, 60))) for _ in range(70)] + ["", "one", "Is it? Yes it is"]
    docs = []
    for _ in range(80):
        w = [rng.choice(words) for _ in range(rng.randint(0, 300))]
        if rng.random() < 0.5:
            at = rng.randint(0, len(w))
            own = items[rng.randrange(len(items))].split()
            w[at:at] = own[: rng.randint(1, len(own) + 1)] if own else []
        docs.append(rng.choice([" ", ", "]).join(w))
    return docs + ["", None, "IS IT? yes it is!"], items


def test_search_finds_all_above_the_threshold(world):
    docs, items = world
    index = D.build_index(pa.table({"item_id": list(range(len(items))), "text": items}))
    words = D.folded_words(pa.array(docs, pa.string()))
    half, half_text = D._passages(words)
    want = brute_scores(docs, items)
    assert len(want) > 20
    open_overlap, D.OVERLAP = D.OVERLAP, 0
    try:
        got = {(t, i): s for t, i, s, *_ in D.search_texts(index, pa.chunked_array([pa.array(docs, pa.string())]))}
    finally:
        D.OVERLAP = open_overlap
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_whole_items_are_found(spark, monkeypatch, world):
    _, items = world
    rng = random.Random(6)
    rows = []
    for i, item in enumerate(items):
        filler = [f"f{rng.randint(0, 5000)}" for _ in range(rng.randint(0, 200))]
        at = rng.randint(0, len(filler))
        rows.append((i, " ".join(filler[:at] + [re.sub("[a-z]", lambda m: m[0].upper(), item) if i % 3 == 0 else item] + filler[at:])))
    bench = spark.createDataFrame([(100 + i, t, "x") for i, t in enumerate(items)] + [(None, "f1", "x")], "item_id bigint, text string, doc_id string")
    docs = spark.createDataFrame([(*r, 1) for r in rows + [(None, rows[0][1])]], "doc_id bigint, text string, item_id int")
    want = {(i, 100 + i) for i, t in enumerate(items) if t} | {(None, 100)}
    for limit in (1 << 30, 2000):
        monkeypatch.setattr(D, "INDEX_BYTES", limit)
        got = D.find_leaks(docs, bench).collect()
        assert want <= {(r.doc_id, r.item_id) for r in got}
        assert all(r.score >= 1 and r.question_overlap >= 0.5 and r.answer_overlap >= 0.5 for r in got)
    assert D.find_leaks(docs.where("false"), bench).collect() == []
    assert D.find_leaks(docs, bench.where("false")).collect() == []


def test_index_bounds_hold():
    items = pa.table({"item_id": [1, 2, 3], "text": ["a b c d", "a a x y z", "q"]})
    index = D.build_index(items)
    for t in range(len(index.term)):
        cells = range(index.cell_at[t], index.cell_at[t + 1])
        assert index.most[t] == max(index.cell_most[c] for c in cells)
        for c in cells:
            assert index.cell_most[c] == np.max(index.posting_impact[index.posting_at[c] : index.posting_at[c + 1]])


def test_long_items_are_found():
    """Items of 200 to 2,000 words that stand verbatim at any offset in a document; the threshold is that of the best window."""
    rng = random.Random(12)
    words = [f"w{i}" for i in range(3000)] + ["the", "of", "and"] * 200
    items = [" ".join(rng.choice(words) for _ in range(n)) for n in (200, 300, 500, 1000, 2000, 30, 64, 65)]
    index = D.build_index(pa.table({"item_id": list(range(len(items))), "text": items}))
    for offset in (0, 1, 17, 31, 50):
        docs = [" ".join([f"f{k}" for k in range(offset)] + [t] + [f"g{k}" for k in range(40)]) for t in items]
        got = {(t, i) for t, i, *_ in D.search_texts(index, pa.chunked_array([pa.array(docs)]))}
        assert got == {(i, i) for i in range(len(items))}


def test_best_windows():
    rng = random.Random(2)
    items = [" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randint(1, 4) for _ in range(n)) for n in (0, 5, 63, 64, 65, 66, 150, 400)]
    words = D.folded_words(pa.array(items))
    term, inverse = np.unique(words.hashes(), return_inverse=True)
    weight = {(t, w): rng.random() for t, item in enumerate(items) for w in set(item.split())}
    each = np.array([weight[t, w] for t, item in enumerate(items) for w in item.split()])
    own = np.array([sum(weight[t, w] for w in set(item.split())) for t, item in enumerate(items)])
    got = D._best_windows(words, inverse, each, own)
    want = [max(sum(weight[t, w] for w in set(item.split()[a : a + 64])) for a in range(max(1, len(item.split()) - 63))) for t, item in enumerate(items)]
    assert np.allclose(got, want)


def test_parts_do_not_change_results(spark, monkeypatch, world):
    docs, items = world
    bench = spark.createDataFrame(list(enumerate(items)) + [(None, "f1")], "item_id bigint, text string")
    texts = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    got = []
    for limit in (1 << 30, 2000):
        monkeypatch.setattr(D, "INDEX_BYTES", limit)
        got.append(sorted(tuple(r) for r in D.find_leaks(texts, bench).collect()))
    assert len(got[0]) > 10 and got[0] == got[1]
