import re

from tributary.llm import license_scan as L


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hits = []
    for t in L.TEMPLATES:
        for i in range(len(words)):
            if words[i : i + len(t.key)] == t.key:
                same = sum(0 <= i - t.key_at + j < len(words) and words[i - t.key_at + j] == w for j, w in enumerate(t.words))
                hits.append((i, t.label, t.base, len(t.key), same / len(t.words)))
    return len(words), sorted(hits)


TEXTS = [
    "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "All rights reserved. ALL RIGHTS  reserved",
    "This work is licensed under the GNU General Public License, version 3.", "general public", "license general public license", "cc by cc by cc by", "by cc", "", None, " \n",
    "É CC BY", "mit license mit license", "all rights all rights reserved", "word " * 30_000 + "cc by", "reserved", "Permission is hereby granted, free of charge",
]


def test_against_brute_force(spark):
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(TEXTS)] + [(None, TEXTS[0], 1, 2), (0, TEXTS[0], 1, 2)], "doc_id bigint, text string, n_words int, hits int")
    got = sorted(((r.doc_id, r.n_words, [tuple(h) for h in r.hits]) for r in L.scan(df).collect()), key=str)
    want = [(i, *brute(t)) for i, t in [*enumerate(TEXTS), (None, TEXTS[0]), (0, TEXTS[0])]]
    assert got == sorted(want, key=str)
    assert L.scan(df.where("false")).collect() == []


def test_texts_that_begin_inside_a_key_phrase(spark):
    texts = [" ".join(t.key[i:]) + tail for t in L.TEMPLATES for i in range(1, len(t.key)) for tail in ("", " and more words", " " + " ".join(t.key))]
    # Frequent first words, so that the rare words of a phrase stand behind them.
    texts += [t.key[0] for t in L.TEMPLATES for _ in range(3 * len(texts))]
    got = [(r.n_words, [tuple(h) for h in r.hits]) for r in L.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(4)).orderBy("doc_id").collect()]
    assert got == [brute(t) for t in texts]


def test_query(against_sql):
    against_sql("op4_license_scan")
