r"""Licence scan with a positional index of rare words.

Texts are lower-cased (A-Z) and split into words of digits, a-z and characters beyond ASCII. The templates below are indexed
by word and position. How rare a licence word is comes from the document frequencies of the whole corpus. Each file looks up
the rarest words of every template; a posting at template position p and a file position i propose that the template
starts at i - p. Proposals that all the template's looked-up words share are kept, and a mandatory key phrase is verified
word by word at its place. Only the positions of the looked-up words are touched; all is column expressions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rarest words of a template that are looked up.
RARE_WORDS = 3


@dataclass(frozen=True)
class Template:
    label: str
    text: str  # words of the template
    phrase: str  # mandatory key phrase, words within the text
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key(self) -> list[str]:
        return self.phrase.split()

    @property
    def key_at(self) -> int:
        n = len(self.key)
        return next(i for i in range(len(self.words)) if self.words[i : i + n] == self.key)


# The base phrases, and opening or naming lines of well-known licences.
TEMPLATES = (
    Template("cc-by", "cc by", "cc by", base=True),
    Template("gpl", "general public license", "general public license", base=True),
    Template("reserved", "all rights reserved", "all rights reserved", base=True),
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template("mit", "released under the mit license", "mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("cc0", "cc0 1 0 universal", "cc0 1 0"),
    Template("gpl-3.0", "gnu general public license version 3", "general public license version 3"),
    Template("gpl-2.0", "gnu general public license version 2", "general public license version 2"),
    Template("lgpl", "gnu lesser general public license", "lesser general public license"),
    Template("agpl", "gnu affero general public license", "affero general public license"),
    Template("mpl-2.0", "mozilla public license version 2 0", "mozilla public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use copy modify and or distribute this software"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)


def words_of(text: Column) -> Column:
    """Words of a text; null has none."""
    spaced = F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), _NOT_WORD, " "))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " "))


def document_frequencies(docs: DataFrame, text_col: str, vocabulary: Sequence[str]) -> dict[str, int]:
    """Number of texts that hold each word of the licence vocabulary: one row per such word reaches the driver."""
    own = F.array_intersect(words_of(F.col(text_col)), F.lit(list(vocabulary)))
    found = docs.select(F.explode(own).alias("word")).groupBy("word").count().collect()
    return {r["word"]: r["count"] for r in found}


def _rare(template: Template, frequency: dict[str, int]) -> list[str]:
    """Words with the highest inverse document frequency; ties by the alphabet. Those of the key phrase come first, since a hit must hold it."""
    key = sorted(set(template.key), key=lambda w: (frequency.get(w, 0), w))
    return key[:RARE_WORDS]


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, hits [(label, base, start, length, share)] ordered by start.

    A hit is a place where a key phrase stands; start is where the phrase begins (words from 0) and share the part of its template's words
    found at their places around it (1 for all). Hits of different templates may overlap. A null or empty text has no
    words and no hits; repeated rows and null ids are scanned like any other row; other columns are ignored; an empty
    table gives no rows.
    """
    vocabulary = sorted({w for t in templates for w in t.key})
    frequency = document_frequencies(docs, text_col, vocabulary)
    rare = [_rare(t, frequency) for t in templates]
    postings: dict[str, list[tuple[int, int]]] = {}  # word -> (template, position)
    for k, (t, own) in enumerate(zip(templates, rare)):
        for p, w in enumerate(t.key):
            if w in own:
                postings.setdefault(w, []).append((k, p + t.key_at))
    looked_up = sorted(postings)
    index = F.create_map(*(x for w in looked_up for x in (F.lit(w), F.array(*(F.struct(F.lit(k).alias("k"), F.lit(p).alias("p")) for k, p in postings[w])))))
    facts = F.array(*(
        F.struct(
            F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), F.lit(len([p for ps in postings.values() for k2, p in ps if k2 == k])).alias("needed"),
            F.lit(t.key).alias("key"), F.lit(t.key_at).alias("key_at"), F.lit(t.words).alias("words"),
        )
        for k, t in enumerate(templates)
    ))

    def hits(ws: Column) -> Column:
        places = F.filter(F.transform(ws, lambda w, i: F.when(w.isin(*looked_up), F.struct(w.alias("w"), i.alias("i")))), lambda x: x.isNotNull())
        proposed = F.flatten(F.transform(places, lambda x: F.transform(F.element_at(index, x["w"]), lambda q: F.struct(q["k"].alias("k"), (x["i"] - q["p"]).alias("start")))))
        # Postings of one template with one start, in order: the last of a full run proposes it.
        ordered = F.sort_array(proposed)

        def complete(o: Column) -> Column:
            def full(x: Column, i: Column) -> Column:
                t = F.get(facts, x["k"])
                whole = F.coalesce(F.get(o, i - t["needed"] + 1) == x, F.lit(False)) & F.coalesce(F.get(o, i + 1) != x, F.lit(True))
                return whole & (x["start"] + t["key_at"] >= 0)  # a key phrase cut by the start of the text is no hit

            return F.filter(o, full)

        def verified(x: Column) -> Column:
            t = F.get(facts, x["k"])
            at = x["start"] + t["key_at"]
            same = F.size(F.filter(t["words"], lambda w, j: F.coalesce(F.get(ws, F.when(x["start"] + j >= 0, x["start"] + j)) == w, F.lit(False))))
            right = F.slice(ws, at + 1, F.size(t["key"])) == t["key"]
            return F.when(right, F.struct(at.cast("bigint").alias("start"), t["label"].alias("label"), t["base"].alias("base"), F.size(t["key"]).alias("length"), (same / F.size(t["words"])).alias("share")))

        return F.sort_array(F.filter(F.transform(_let(ordered, complete), verified), lambda x: x.isNotNull()))

    both = _let(words_of(F.col(text_col)), lambda ws: F.struct(F.size(ws).cast("bigint").alias("n_words"), hits(ws).alias("hits")))
    return docs.select(F.col(id_col).alias("doc_id"), both.alias("scan")).select("doc_id", "scan.n_words", "scan.hits")
