"""Benchmark decontamination: a BM25 index of test items, searched with every training passage under block-max bounds.

Items are the indexed texts, and overlapping passages of every document are the queries. An impact is divided by the item's
threshold (``SHARE`` of the best score that a window of the item, as long as a passage, has with the item: for items of one passage, of what
the item scores with itself), so a score of 1 is a hit for any item. Items stand in blocks, and each
term knows its largest impact at all and in each block. A batch of passages is searched together: passages whose bounds add up to less
than 1 go; then the blocks a passage cannot reach 1 in; only what is left is scored, and everything from 1 on
is retrieved. Hits are verified against the whole document: of the item's question and of its answer, word runs must overlap.

The index is broadcast and so must be bounded: beyond ``INDEX_BYTES`` of item text it is built and searched in
parts. Document frequencies and the mean length are then counted once over all items, so scores do not depend on the parts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.blocks import small_batches
from tributary.llm.words import U, Words, gram_hashes, range_index, split_words, steps, text_bytes
from tributary.session import scratch_path

K1, B = 1.2, 0.75
SHARE = 0.4
#: A passage is two neighbouring half passages.
HALF = 32
BLOCK_ITEMS = 16
RUN = 3
OVERLAP = 0.5
INDEX_BYTES = 32 << 20
_BITS = 18

#: A-Z to lower case, other ASCII that is neither digit nor letter to a space; the rest of UTF-8 stays.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 0x20
_FOLD[ord("0") : ord("9") + 1] = np.arange(ord("0"), ord("9") + 1)
_FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def folded_words(texts: pa.ChunkedArray | pa.Array) -> Words:
    """Words of digits, letters and characters beyond ASCII, lower-cased (A-Z)."""
    data, text_end = text_bytes(texts)
    data = _FOLD[data]
    change = np.flatnonzero(np.diff((data == 0x20).astype(np.int8), prepend=1))
    start, end = change[::2], change[1::2]
    return Words(data, text_end, start, end, np.searchsorted(text_end, start), len(text_end))


@dataclass
class Index:
    """Terms by hash; postings by (term, block), each with the block's bound; items with their run hashes."""

    item_id: np.ndarray
    term: np.ndarray  # sorted hashes
    bitmap: np.ndarray  # of the low bits of the hashes
    most: np.ndarray  # per term: largest impact
    cell_at: np.ndarray  # per term: its first (term, block) cell; one more at the end
    cell_block: np.ndarray
    cell_most: np.ndarray
    posting_at: np.ndarray  # per cell: its first posting; one more at the end
    posting_item: np.ndarray
    posting_impact: np.ndarray
    question: list[np.ndarray]
    answer: list[np.ndarray]

    def terms_of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the indexed words, and their terms."""
        at = np.flatnonzero(self.bitmap[(hashes & U((1 << _BITS) - 1)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.term, hashes[at]), max(0, len(self.term) - 1))
        known = self.term[place] == hashes[at] if len(self.term) else np.zeros(len(at), bool)
        return at[known], place[known]

    def search(self, passage: np.ndarray, term: np.ndarray, n_passages: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, item, score) of every score of at least 1. A repeated term of a passage counts once."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        bound = np.bincount(passage, weights=self.most[term], minlength=n_passages)
        some = bound[passage] >= 1
        pair = np.unique(passage[some] * len(self.term) + term[some])
        passage, term = pair // max(1, len(self.term)), pair % max(1, len(self.term))
        some = np.bincount(passage, weights=self.most[term], minlength=n_passages)[passage] >= 1
        passage, term = passage[some], term[some]
        if not len(term):
            return none
        blocks = int(self.cell_block.max()) + 1
        n = self.cell_at[term + 1] - self.cell_at[term]
        cell, owner = range_index(self.cell_at[term], n), np.repeat(passage, n)
        pair, inverse = np.unique(owner * blocks + self.cell_block[cell], return_inverse=True)
        some = np.bincount(inverse, weights=self.cell_most[cell])[inverse] >= 1
        cell, owner = cell[some], owner[some]
        n = self.posting_at[cell + 1] - self.posting_at[cell]
        posting, owner = range_index(self.posting_at[cell], n), np.repeat(owner, n)
        items = len(self.item_id)
        pair, inverse = np.unique(owner * items + self.posting_item[posting], return_inverse=True)
        score = np.bincount(inverse, weights=self.posting_impact[posting], minlength=len(pair))
        hit = score >= 1
        return pair[hit] // items, pair[hit] % items, score[hit]


def _halves(text: str) -> tuple[str, str]:
    """Question and answer of an item: cut behind the first question mark, else in the middle of its words."""
    head, mark, tail = text.partition("?")
    if mark and head.strip() and tail.strip():
        return head, tail
    words = text.split()
    return " ".join(words[: len(words) // 2]), " ".join(words[len(words) // 2 :])


def _runs(texts: list[str]) -> list[np.ndarray]:
    """Distinct hashes of RUN words of each text, or of all its words if it has fewer."""
    words = folded_words(pa.array(texts, pa.string()))
    each = np.split(words.hashes(), np.cumsum(words.per_text)[:-1]) if texts else []
    return [np.unique(gram_hashes(x, min(RUN, len(x)))) if len(x) else np.zeros(0, U) for x in each]


def _best_windows(words: Words, term: np.ndarray, weight: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Per text, the most that the distinct words of a run of one passage weigh together; ``own`` for texts of up to one passage."""
    long = words.per_text > 2 * HALF
    if not long.any():
        return own
    text, place = words.text, np.arange(len(term))
    begin = (np.cumsum(words.per_text) - words.per_text)[text]
    order = np.lexsort((place, term, text))
    before = np.full(len(term), -1)
    again = (term[order][1:] == term[order][:-1]) & (text[order][1:] == text[order][:-1])
    before[order[1:][again]] = order[:-1][again]
    # A word counts in the windows that start behind its last use and hold it.
    gain = np.zeros(len(term) + 1)
    np.add.at(gain, np.maximum(np.maximum(before + 1, place - 2 * HALF + 1), begin), weight)
    np.subtract.at(gain, place + 1, weight)
    best = np.zeros(words.n_texts)
    np.maximum.at(best, text, np.cumsum(gain[:-1]))
    return np.where(long, best, own)


@dataclass
class Counts:
    """Of all items: their number, the mean length of those with words, and the number of items that hold each term of a part."""

    items: int
    mean: float
    term: np.ndarray  # sorted hashes
    frequency: np.ndarray


def build_index(items: pa.Table, counts: Counts | None = None) -> Index:
    """Of (item_id, text); items without words are never hit. Without ``counts`` these are all items."""
    texts = [x or "" for x in items["text"].to_pylist()]
    words = folded_words(pa.array(texts, pa.string()))
    term, inverse = np.unique(words.hashes(), return_inverse=True)
    length = words.per_text
    mean = max(1.0, length[length > 0].mean() if (length > 0).any() else 1.0)
    pair, tf = np.unique(inverse.astype(np.int64) * max(1, len(texts)) + words.text, return_counts=True)
    of_term, item = pair // max(1, len(texts)), pair % max(1, len(texts))
    frequency, n_items = np.bincount(of_term, minlength=len(term)), len(texts)
    if counts is not None:
        mean, n_items, frequency = counts.mean, counts.items, counts.frequency[np.searchsorted(counts.term, term)]
    idf = np.log1p((n_items - frequency + 0.5) / (frequency + 0.5))
    impact = idf[of_term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[item] / mean))
    own = np.bincount(item, weights=impact, minlength=len(texts))
    of_word = np.searchsorted(pair, inverse.astype(np.int64) * max(1, len(texts)) + words.text)
    own = _best_windows(words, inverse, impact[of_word], own)
    impact = impact / np.maximum(SHARE * own, 1e-12)[item]
    # Postings are in order of term and item, so of term and block too.
    block = item // BLOCK_ITEMS
    cell_start = np.flatnonzero(np.concatenate([[True], (of_term[1:] != of_term[:-1]) | (block[1:] != block[:-1])])) if len(pair) else np.zeros(0, np.int64)
    cell_most = np.maximum.reduceat(impact, cell_start) if len(cell_start) else np.zeros(0)
    cell_at = np.searchsorted(of_term[cell_start], np.arange(len(term) + 1))
    bitmap = np.zeros(1 << _BITS, bool)
    bitmap[(term & U((1 << _BITS) - 1)).astype(np.int64)] = True
    question, answer = zip(*map(_halves, texts)) if texts else ((), ())
    return Index(
        items["item_id"].to_numpy().astype(np.int64), term, bitmap, np.maximum.reduceat(cell_most, cell_at[:-1]) if len(term) else np.zeros(0), cell_at,
        block[cell_start], cell_most, np.append(cell_start, len(pair)), item, impact, _runs(list(question)), _runs(list(answer)),
    )


_HITS = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("passages", pa.int64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())])


def _passages(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Number of each word's half passage, counted through all texts, and the text of each half passage."""
    per_text = words.per_text
    halves = np.maximum(1, -(-per_text // HALF))
    in_text = np.arange(len(words.text)) - (np.cumsum(per_text) - per_text)[words.text]
    return (np.cumsum(halves) - halves)[words.text] + in_text // HALF, np.repeat(np.arange(words.n_texts), halves)


def _overlap(runs: np.ndarray, of_doc: np.ndarray) -> float:
    return float(np.isin(runs, of_doc).mean()) if len(runs) else 1.0


def search_texts(index: Index, texts: pa.ChunkedArray) -> list[tuple[int, int, float, int, float, float]]:
    """(text, item, best score, passages, question overlap, answer overlap) of the verified hits."""
    words = folded_words(texts)
    hashes = words.hashes()
    half, half_text = _passages(words)
    at, term = index.terms_of(hashes)
    # A passage is named by its first half; the last half of a text opens one only if it is the first too.
    last = np.append(half_text[1:] != half_text[:-1], True)
    first = np.insert(half_text[1:] != half_text[:-1], 0, True)
    mine = half[at]
    opens, closes = ~last[mine] | first[mine], ~first[mine]
    passage, item, score = index.search(np.concatenate([mine[opens], mine[closes] - 1]), np.concatenate([term[opens], term[closes]]), len(half_text))
    found: dict[tuple[int, int], list] = {}
    for t, i, s in zip(half_text[passage].tolist(), item.tolist(), score.tolist()):
        best = found.setdefault((t, i), [0.0, 0])
        best[0], best[1] = max(best[0], s), best[1] + 1
    ends = np.cumsum(words.per_text)
    out, runs = [], {}
    for (t, i), (s, n) in found.items():
        if t not in runs:
            own = hashes[ends[t - 1] if t else 0 : ends[t]]
            runs = {t: np.concatenate([gram_hashes(own, k) for k in range(1, RUN + 1)])}
        q, a = _overlap(index.question[i], runs[t]), _overlap(index.answer[i], runs[t])
        if q >= OVERLAP and a >= OVERLAP:
            out.append((t, i, s, n, q, a))
    return out


def _search(index):
    def run(batches):
        for batch in batches:
            for part in steps(batch, "text"):
                hits = search_texts(index.value, part["text"])
                if hits:
                    text, item, *rest = map(np.array, zip(*hits))
                    ids = part["doc_id"].combine_chunks().take(pa.array(text))
                    yield pa.record_batch([ids, index.value.item_id[item], *rest], schema=_HITS)

    return run


def _terms(batches):
    """(item, term, length): a row for each distinct term of an item, and one without a term that has its length."""
    for batch in batches:
        for part in steps(batch, "text"):
            words = folded_words(part["text"])
            order = np.lexsort((words.hashes(), words.text))
            term, text = words.hashes()[order], words.text[order]
            new = np.concatenate([[True], (term[1:] != term[:-1]) | (text[1:] != text[:-1])])[: len(term)]
            yield pa.record_batch({
                "part": pa.concat_arrays([part["part"].combine_chunks(), part["part"].combine_chunks().take(pa.array(text[new]))]),
                "term": pa.array(np.concatenate([np.zeros(words.n_texts, np.int64), term[new].view(np.int64)]), mask=np.arange(words.n_texts + new.sum()) < words.n_texts),
                "length": pa.array(np.concatenate([words.per_text, np.zeros(new.sum(), np.int64)]).astype(np.int64)),
            })


def _counted(items: DataFrame) -> tuple[int, float, DataFrame]:
    """Number of items (item_id, text, part), mean length, and (part, term, n): the items that hold each term, for the parts that hold it."""
    spark = items.sparkSession
    path = scratch_path(spark, "item_terms")
    items.mapInArrow(_terms, "part int, term bigint, length bigint").write.parquet(path)
    rows = spark.read.parquet(path)
    n, with_words, total = rows.where("term IS NULL").agg(F.count("*"), F.count_if(F.col("length") > 0), F.sum("length")).first()
    frequency = rows.where("term IS NOT NULL").groupBy("term").agg(F.count("*").alias("n"), F.collect_set("part").alias("parts"))
    path = scratch_path(spark, "item_frequencies")
    frequency.select(F.explode("parts").alias("part"), "term", "n").write.partitionBy("part").parquet(path)
    return n, max(1.0, total / with_words if with_words else 1.0), spark.read.parquet(path)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, score, passages, question_overlap, answer_overlap): one row for each row of ``docs`` and item it holds.

    A null or empty document has no passages, and an item without words or with a null id is never hit. Items with equal texts are
    all returned. Repeated document rows are searched each; a null doc_id stays null. Other columns are ignored; an empty table on
    either side gives no rows. Texts are searched whole.
    """
    spark = docs.sparkSession
    small_batches(spark)
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    items = benchmark.select(F.col(item_id_col).cast("bigint").alias("item_id"), F.col(item_text_col).cast("string").alias("text")).where("item_id IS NOT NULL")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    parts = max(1, -(-size // INDEX_BYTES))
    items = items.withColumn("part", F.pmod(F.xxhash64("item_id"), F.lit(parts)).cast("int"))
    n, mean, frequency = _counted(items) if parts > 1 else (0, 0.0, None)
    out = None
    for k in range(parts):
        own = items.where(F.col("part") == k).orderBy("item_id", "text").toArrow()  # at most about INDEX_BYTES
        counts = None
        if frequency is not None:
            of_part = frequency.where(F.col("part") == k).select("term", "n").toArrow()  # the terms of the part
            term = of_part["term"].to_numpy().view(U)
            order = np.argsort(term)
            counts = Counts(n, mean, term[order], of_part["n"].to_numpy()[order])
        index = spark.sparkContext.broadcast(build_index(own, counts))
        found = plain.mapInArrow(_search(index), "doc_id bigint, item_id bigint, score double, passages bigint, question_overlap double, answer_overlap double")
        out = found if out is None else out.unionByName(found)
    return out
