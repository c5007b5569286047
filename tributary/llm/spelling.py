"""Spelling variants: words one edit apart, found by asymmetric chunks.

Two words are near if one inserted, deleted or replaced code point turns one into the other. Of a pair, the shorter word (either, if they are equally long)
contributes two disjoint chunks, its halves; the other one contributes its grams of that size at every position that such a half can have come from
within a shift of one. One edit touches one half only, so the other half stands in the longer word, at its place from the front (the first half) or from the back
(the second half, shifted by the difference in length). Pairs that share a chunk are verified by edit distance.

A chunk such as a common ending may be shared by very many words, whose pairs are not formed: both words then agree outside the rest of the chunk's word, and
the one edit lies in that rest. So the rest is halved again by the same rule, and only words that share one of its chunks too stay together. This
goes on while a chunk has more than ``PAIRS`` candidate pairs, at most until one code point is left, where all words of a chunk are near each other.

1. One pass over the texts counts the words; counts are added in numpy per step, then by Spark.
2. The chunk join above, on the vocabulary only.
3. A word's form is its most frequent near word; roots follow forms by pointer doubling. Frequencies at least double along a path, so there is no cycle.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.blocks import small_batches
from tributary.llm.crc import crc32s
from tributary.llm.words import LOWER, U, mix, range_hashes, range_index, steps, strings, text_bytes
from tributary.session import scratch_path

LEAST_LENGTH = 5
LEAST_COUNT = 3
#: A word of which one in so many (document, run) pairs loses a code point.
DAMAGE = 97
#: A form has at least so many times the word's count.
RATIO = 2
#: Candidate pairs of a chunk above which its words are parted by further chunks.
PAIRS = 4096
#: Bytes of text worked on at once: more text means fewer rows for each distinct word.
STEP = 4 << 20
_STEP = U(0x9E3779B97F4A7C15)


def runs(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with A-Z in lower case; start, end and text of each maximal run of letters (a-z, U+00C0 to U+00FF); code points before each byte.

    The latter letters are those whose first byte in UTF-8 is 0xC3."""
    data, text_end = text_bytes(texts)
    data = LOWER[data]
    letter = (data >= 0x61) & (data <= 0x7A)
    lead = data == 0xC3
    letter |= lead
    letter[1:] |= lead[:-1]
    change = np.flatnonzero(np.diff(np.concatenate([[False], letter, [False]]).view(np.int8)))
    start, end = change[::2], change[1::2]
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return data, start, end, np.searchsorted(text_end, start), points


def _words(least: int, damage: int):
    def run(batches):
        for batch in batches:
            for part in steps(batch, "text", STEP):
                data, start, end, text, points = runs(part["text"])
                spelt = range_hashes(data, start, end)
                ids = part["doc_id"].to_pylist()
                front = np.array([0 if i is None else zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32)
                named = np.array([i is not None for i in ids], bool)
                _, first, inverse = np.unique(mix(spelt + text.astype(U) * _STEP), return_index=True, return_inverse=True)
                times = np.bincount(inverse, minlength=len(first))
                start, end, text, spelt = start[first], end[first], text[first], spelt[first]
                value = crc32s(data, start, end, front[text])
                hit = (value % np.uint32(damage) == 0) & named[text]
                changed: Counter[str] = Counter()
                for i in np.flatnonzero(hit).tolist():
                    word = data[start[i] : end[i]].tobytes().decode()
                    k = int(value[i]) % len(word)
                    if len(word) > least:
                        changed[word[:k] + word[k + 1 :]] += int(times[i])
                kept = np.flatnonzero(~hit & (points[end] - points[start] >= least))
                _, at, group = np.unique(spelt[kept], return_index=True, return_inverse=True)
                count = np.bincount(group, weights=times[kept], minlength=len(at)).astype(np.int64)
                size = (end - start)[kept][at]
                word = strings(data[range_index(start[kept][at], size)], np.concatenate([[0], np.cumsum(size)])).cast(pa.string())
                yield pa.record_batch({"word": word, "n": count})
                if changed:
                    yield pa.record_batch({"word": pa.array(list(changed), pa.string()), "n": pa.array(list(changed.values()), pa.int64())})

    return run


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, damage: int = DAMAGE) -> DataFrame:
    """(word, n): words of at least ``least_length`` code points and their occurrences, if there are ``least_count``."""
    small_batches(docs.sparkSession)
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counted = plain.mapInArrow(_words(least_length, damage), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least_count)


def _saved(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _halved(rows: DataFrame) -> DataFrame:
    """Each row twice: with the first, and with the second half of the open part [i, j) of the chunk's word taken into what is shared.

    ``longer`` is 1 for grams of words that are one code point longer than the chunk's word: their open part is longer by one as well."""
    half = (F.col("i") + F.floor((F.col("j") - F.col("i")) / 2)).cast("int")
    ranges = F.array(F.struct(half.alias("i"), F.col("j").alias("j")), F.struct(F.col("i").alias("i"), half.alias("j")))
    both = rows.select("word", "n", "role", "longer", F.explode(ranges).alias("open")).select("word", "n", "role", "longer", "open.i", "open.j")
    size = F.length("word") - F.col("longer")
    outside = F.concat_ws("\n", F.substring("word", F.lit(1), F.col("i")), F.substring("word", F.col("j") + F.col("longer") + 1, F.length("word")))
    return both.withColumn("chunk", F.xxhash64(size, "i", "j", outside))


def near_pairs(vocabulary: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """(a, n_a, b, n_b), each pair of near words once, of a written table (word, n) of distinct words."""
    whole = [F.lit(0).alias("i"), F.length("word")]
    sides = [(0, 0), (1, 0), (1, 1)]  # chunks; grams of equally long words; grams of longer ones
    rows = None
    for role, longer in sides:
        side = vocabulary.select("word", "n", F.lit(role).alias("role"), F.lit(longer).alias("longer"), whole[0], (whole[1] - longer).alias("j"))
        rows = side if rows is None else rows.unionByName(side)
    found = []
    while True:
        rows = _saved(_halved(rows), "chunks")
        is_chunk = F.col("role") == 0
        sizes = rows.groupBy("chunk").agg(
            F.count(F.when(is_chunk, 1)).alias("chunks"), F.count(F.when(~is_chunk, 1)).alias("grams"), F.min("word").alias("least"), F.max("word").alias("most"),
            F.max(F.col("j") - F.col("i")).alias("open"),
        ).where("chunks > 0 AND grams > 0 AND least <> most")
        hot = F.col("chunks") * F.col("grams") > pairs
        shared = _saved(rows.join(sizes.select("chunk", (hot & (F.col("open") > 1)).alias("hot")), "chunk"), "shared")
        few = shared.where("NOT hot")
        a = few.where("role = 0").select("chunk", F.col("word").alias("a"), F.col("n").alias("n_a"))
        b = few.where("role = 1").select("chunk", F.col("word").alias("b"), F.col("n").alias("n_b"), "longer")
        met = a.join(b, "chunk").where("(longer = 1 OR a < b) AND levenshtein(a, b, 1) = 1")
        found.append(met.select("a", "n_a", "b", "n_b"))
        rows = shared.where("hot").drop("chunk", "hot")
        if rows.isEmpty():
            break
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return _saved(every.distinct(), "near")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last word on the path of forms."""
    roots = _saved(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = roots.select(F.col("word").alias("at"), F.col("root").alias("onward"))
        joined = roots.join(onward, F.col("root") == F.col("at"), "left")
        roots = _saved(joined.select("word", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("moved")), "roots")
        if roots.where("moved").isEmpty():
            return roots.select("word", "root")
        roots = roots.drop("moved")


def variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, damage: int = DAMAGE, ratio: int = RATIO,
    pairs: int = PAIRS,
) -> DataFrame:
    """word, form, root, n, n_near, form_n: one row for each distinct word (see ``vocabulary``).

    form is the near word of largest n (ties: the smallest in code-point order) if its n is at least ``ratio`` times the word's, else null, as is form_n; root is the
    last word on the path of forms, the word itself without a form. Null and empty texts have no words. The runs of a row without an id stay as they are. Rows that repeat an
    id are documents of their own and lose the same code points. Other columns are ignored; an empty table gives no rows.
    """
    known = _saved(vocabulary(docs, id_col, text_col, least_length, least_count, damage), "vocabulary")
    near = near_pairs(known, pairs)
    directed = near.select(F.col("a").alias("word"), F.col("n_a").alias("n"), F.col("b").alias("other"), F.col("n_b").alias("m"))
    directed = directed.union(near.select("b", "n_b", "a", "n_a"))
    best = directed.groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("k"), "other")).alias("best"))
    able = -F.col("best.k") >= ratio * F.col("n")
    best = _saved(best.select("word", "n_near", F.when(able, F.col("best.other")).alias("form"), F.when(able, -F.col("best.k")).alias("form_n")), "forms")
    roots = _roots(best.where("form IS NOT NULL").select("word", "form"))
    out = known.join(best, "word", "left").join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n")
