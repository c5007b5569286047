"""Importance resampling toward a target distribution, with hashed word features found by an automaton.

A feature is a run of 1 to ``max_words`` consecutive words of a text; its bucket is the CRC-32 of its bytes modulo ``buckets``.

1. Each Python worker holds an Aho-Corasick dictionary of distinct words, each bounded by a delimiter on both sides, so a scan of the
   delimiter-bounded text finds whole words only. A word's payload is its CRC and its length. A scan emits payloads; payloads of adjacent
   words compose to the CRC of the run they form, without a look at its bytes. Words that the dictionary lacks get their payload
   from their bytes, and enter it when it is built anew (whenever there are as many new words as old ones, up to ``DICTIONARY``, which bounds its memory).
2. One pass over all documents writes each document's buckets. Their counts, and those of the target texts, are sums over tasks.
3. The gain of a bucket is the log ratio of its smoothed shares. A document's weight is the sum over its features; with Gumbel noise, seeded by
   its id, the highest scores are a draw without replacement. Ranks come from sorted ranges, so no task holds all scores.

What reaches the driver is one number for each bucket.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm import crc
from tributary.llm.blocks import small_batches
from tributary.llm.words import LOWER, U, Words, full_grams, split_words, steps
from tributary.operators.ordering import row_rank
from tributary.session import scratch_path

BUCKETS = 10_000
MAX_WORDS = 1
SEED = 2024
#: Texts with fewer words aren't drawn.
LEAST_WORDS = 20
#: Share of the others that is drawn, in percent.
PERCENT = 10
#: Most words in a worker's dictionary; beyond it a word's payload comes from its bytes each time.
DICTIONARY = 200_000
#: Gains are whole thousandths.
SCALE = 1000
#: A-Z to a-z; bytes below 0x80 that are no letter or digit part words.
_WRITTEN = LOWER.copy()
_WRITTEN[[c for c in range(0x80) if not chr(c).isalnum()]] = 0x20


class Dictionary:
    """Distinct words and their payloads, and the automaton over them."""

    def __init__(self, limit: int):
        self.limit = limit
        self.word: set[bytes] = set()  # all words, those that wait for the next automaton too
        self.waiting: list[bytes] = []
        self.built = 0
        self.automaton = None
        self.crc, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def learn(self, words: list[bytes], crcs: list[int]) -> None:
        import ahocorasick

        fresh = [(w, c) for w, c in zip(words, crcs) if w not in self.word][: self.limit - len(self.word)]
        self.word.update(w for w, _ in fresh)
        self.waiting += [w for w, _ in fresh]
        self.crc = np.append(self.crc, np.array([c for _, c in fresh], np.uint32))
        self.size = np.append(self.size, np.array([len(w) for w, _ in fresh], np.int64))
        full = len(self.word) == self.limit
        if self.waiting and (len(self.waiting) >= self.built or full):
            if self.automaton is None:
                self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
            for k, w in enumerate(self.waiting, self.built):
                self.automaton.add_word(f" {w.decode('latin-1')} ", k)
            self.built, self.waiting = self.built + len(self.waiting), []
            self.automaton.make_automaton()

    def scan(self, words: Words) -> np.ndarray:
        """The dictionary's number of each word, -1 for one that the automaton doesn't hold."""
        number = np.full(len(words.start), -1, np.int64)
        if self.built:
            found = self.automaton.iter(f" {words.data.tobytes().decode('latin-1')}")  # the space behind a word at i..j-1 stands at j + 1
            at = np.fromiter(chain.from_iterable(found), np.int64).reshape(-1, 2)
            number[np.searchsorted(words.end, at[:, 0] - 1)] = at[:, 1]
        return number


_dictionaries: dict[int, Dictionary] = {}


def payloads(words: Words, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """CRC and length in bytes of each word."""
    own = _dictionaries.setdefault(limit, Dictionary(limit))
    size = words.end - words.start
    if not len(size):
        return np.zeros(0, np.uint32), size
    number = own.scan(words)
    lacking = number < 0
    out = np.zeros(len(size), np.uint32)
    out[~lacking] = own.crc[number[~lacking]]
    if lacking.any():
        hashes, first, inverse = np.unique(words.hashes()[lacking], return_index=True, return_inverse=True)
        start, end = words.start[lacking][first], words.end[lacking][first]
        value = crc.crc32s(words.data, start, end)
        out[lacking] = value[inverse]
        if len(own.word) < limit:
            raw = words.data.tobytes()
            own.learn([raw[a:b] for a, b in zip(start.tolist(), end.tolist())], value.tolist())
    return out, size


def features(texts: pa.Array | pa.ChunkedArray, max_words: int, limit: int = DICTIONARY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, CRC) of every feature, in order of text, and the words of each text."""
    words = split_words(texts, _WRITTEN)
    words.data[words.text_end] = 0x20
    value, size = payloads(words, limit)
    space = np.full(len(value), np.uint32(0x20))
    gap = crc.crc32s(np.array([0x20], np.uint8), np.zeros(1, np.int64), np.ones(1, np.int64))[0]
    text, run, of_text = words.text, value, [words.text]
    every = [value]
    spaced = crc.joined(np.full(len(value), gap, np.uint32), value, size) if max_words > 1 else space
    for n in range(2, max_words + 1):
        inside = full_grams(text, n)
        count = len(inside)
        run = crc.joined(run[:count], spaced[n - 1 :], size[n - 1 :] + 1) if count else run[:0]
        every.append(run[inside])
        of_text.append(text[:count][inside])
    owner, found = np.concatenate(of_text), np.concatenate(every)
    if max_words > 1:
        order = np.argsort(owner, kind="stable")
        owner, found = owner[order], found[order]
    return owner, found, words.per_text


def _bucketed(max_words: int, buckets: int, limit: int):
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32

    def run(batches):
        for batch in batches:
            for part in steps(batch, "text"):
                owner, found, n_words = features(part["text"], max_words, limit)
                bucket = (found % np.uint32(buckets)).astype(kind)
                size = np.bincount(owner, minlength=len(n_words)).astype(np.int64)
                each = np.split(bucket, np.cumsum(size)[:-1])
                yield pa.record_batch({
                    "doc_id": part["doc_id"].combine_chunks(), "n_words": n_words.astype(np.int64), "n_features": size,
                    "buckets": pa.array([x.tobytes() for x in each], pa.binary()),
                })

    return run


def bucketed(texts: DataFrame, id_col: str | None, text_col: str = "text", max_words: int = MAX_WORDS, buckets: int = BUCKETS, limit: int = DICTIONARY) -> DataFrame:
    """doc_id, n_words, n_features and the buckets of all features (packed little-endian integers) of every row, as a written table."""
    small_batches(texts.sparkSession)
    own = F.col(id_col) if id_col else F.lit(None)
    plain = texts.select(own.cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    path = scratch_path(texts.sparkSession, "buckets")
    plain.mapInArrow(_bucketed(max_words, buckets, limit), "doc_id bigint, n_words bigint, n_features bigint, buckets binary").write.option("compression", "zstd").parquet(path)
    return texts.sparkSession.read.parquet(path)


def _flat(column: pa.Array, buckets: int) -> np.ndarray:
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]].view("<u2" if buckets <= 1 << 16 else "<u4")


def _summed(buckets: int):
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(_flat(batch["buckets"], buckets), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.record_batch({"bucket": some, "n": total[some]})

    return run


def bucket_counts(table: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features in each bucket; one row a task and bucket is shuffled."""
    return table.select("buckets").mapInArrow(_summed(buckets), "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of each bucket in thousandths, from bucket counts of the source and the target: one number a bucket for the driver."""
    spark = source.sparkSession
    both = spark.range(buckets).select(F.col("id").alias("bucket"))
    both = both.join(source.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left")
    s, t = (F.coalesce(c, F.lit(0)).cast("double") for c in ("s", "t"))
    of_source, of_target = (df.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias("n")).first()["n"] for df in (source, target))
    ratio = (t + 1) * F.lit(of_source + buckets) / ((s + 1) * F.lit(of_target + buckets))
    rows = both.select("bucket", F.floor(F.lit(float(SCALE)) * F.log(ratio)).alias("gain")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["gain"]
    return out


def _weighed(gain: np.ndarray):
    def run(batches):
        for batch in batches:
            n = batch["n_features"].to_numpy()
            total = np.concatenate([[0], np.cumsum(gain[_flat(batch["buckets"], len(gain))])])
            end = np.cumsum(n)
            yield pa.record_batch({"doc_id": batch["doc_id"], "n_words": batch["n_words"], "n_features": n, "weight": total[end] - total[end - n]})

    return run


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text", max_words: int = MAX_WORDS, buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED, dictionary: int = DICTIONARY,
) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row of ``docs``; rank counts the drawn ones from 1, others have none.

    A null or empty text has no features and a weight of 0. A row without an id has no noise: its score and rank are null, and it isn't among the documents drawn from.
    Ties in score go to the smaller id; rows that repeat an id and a text share the noise and stand in the ranking one behind the other. An empty target or an
    empty table works: counts are smoothed. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = bucketed(docs, id_col, text_col, max_words, buckets, dictionary)
    wanted = bucketed(target, None, target_text_col, max_words, buckets, dictionary)
    gain = gains(bucket_counts(rows, buckets), bucket_counts(wanted, buckets), buckets)
    weighed = rows.mapInArrow(_weighed(gain), "doc_id bigint, n_words bigint, n_features bigint, weight bigint")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-float(SCALE)) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    path = scratch_path(spark, "scores")
    weighed.withColumn("score", F.col("weight") + noise).write.parquet(path)
    scored = spark.read.parquet(path)
    able = scored.where(f"n_words >= {least_words} AND score IS NOT NULL")
    drawn = percent * able.count() // 100
    order = ["_score", "doc_id", "n_features", "weight"]
    ranked = row_rank(able.withColumn("_score", -F.col("score")), [], order, "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.where(f"NOT (n_words >= {least_words} AND score IS NOT NULL)").withColumn("rank", F.lit(None).cast("bigint"))
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    return ranked.select(*columns).unionByName(rest.select(*columns))
