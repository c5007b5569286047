import random
import re

import pytest

from tributary.llm import blocks, substring_dedup
from tributary.llm.substring_dedup import SuffixAutomaton, remove_repeated_spans


def brute(rows, n):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    for (i, _), w in zip(rows, words):
        for k in range(len(w) - n + 1) if i is not None else ():
            key = tuple(w[k : k + n])
            first[key] = min(first.get(key, i), i)
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        for k in range(len(w) - n + 1) if i is not None else ():
            if first[tuple(w[k : k + n])] < i:
                gone.update(range(k, k + n))
        out.append((i, " ".join(x for j, x in enumerate(w) if j not in gone), len(w), len(gone)))
    return sorted(out, key=str)


def run(spark, rows, n):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id bigint, text string, block int, name string")
    return sorted([(r.doc_id, r.kept_text, r.n_words, r.n_removed) for r in remove_repeated_spans(df, min_words=n).collect()], key=str)


def corpus(seed, n_docs, vocabulary):
    rng = random.Random(seed)
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(5, 40))] for _ in range(12)]
    rows = []
    for i in range(n_docs):
        w = []
        for _ in range(rng.randint(0, 6)):
            w += rng.choice(passages) if rng.random() < 0.5 else [rng.choice(vocabulary) for _ in range(rng.randint(1, 30))]
        rows.append((rng.randint(0, 2 * n_docs), rng.choice([" ", "\n", "\t "]).join(w)))
    return rows


@pytest.mark.parametrize("seed,size", [(1, 2000), (2, 30)])
def test_against_brute_force(spark, monkeypatch, seed, size):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(substring_dedup, "COMMON_BLOCKS", 3)
    monkeypatch.setattr(substring_dedup, "AUTOMATON_WORDS", 100)
    rows = corpus(seed, 150, [f"w{i}é" for i in range(size)])
    rows += [(None, rows[0][1]), (7, None), (8, ""), (9, " \n\t"), (10, "a " * 500), (11, "a " * 300), rows[3], rows[3]]
    assert run(spark, rows, 7) == brute(rows, 7)


def test_edges(spark):
    text = " ".join(f"x{i}" for i in range(40))
    assert run(spark, [], 13) == []
    assert run(spark, [(1, text), (2, text), (2, text)], 13) == brute([(1, text), (2, text), (2, text)], 13)
    assert run(spark, [(3, text + " tail"), (-2, "head " + text)], 13) == [(-2, "head " + text, 41, 0), (3, "tail", 41, 40)]


def test_matching_statistics():
    a = SuffixAutomaton()
    for owner, s in enumerate(("abcbc", "bcbcd", "xyz")):
        a.add(s, owner)
    text, held = "zabcbcdxyabcz", ("abcbc", "bcbcd", "xyz")
    want = [max(n for n in range(i + 2) if any(text[i + 1 - n : i + 1] in h for h in held)) for i in range(len(text))]
    assert a.match(text)[0] == want
    owners = [min([k for k, h in enumerate(held) if i > 0 and text[i - 1 : i + 1] in h], default=None) for i in range(len(text))]
    assert a.match(text, 2)[1] == owners


def test_query(against_sql):
    against_sql("op1_substring_dedup")
