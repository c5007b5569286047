"""Concatenate and cut: all documents form one long run of token ids, cut into windows of fixed size.

Pass 1 tokenizes every text once and writes the ids beside the running token count inside the write task. The token
totals of the tasks, prefix-summed, give each task's offset in the whole run. Pass 2 reads the written ids, adds the
two numbers, and cuts each document at the multiples of the window size; a document that crosses a boundary gives
one record for each window it reaches into. No text and no id is shuffled. The written table fixes the order, so
a lost task recomputes the same pieces.
"""

from __future__ import annotations

import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.blocks import small_batches
from tributary.llm.words import U, range_hashes, range_index, steps, text_bytes
from tributary.session import scratch_path

SEQUENCE_TOKENS = 2048
END_ID = 1
#: Bytes of text encoded at once; more text means fewer new words each time.
STEP = 2 << 20
#: Word ids a Python worker remembers between batches; beyond it starts anew.
REMEMBERED_IDS = 2_000_000
#: White space that the pre-tokenizer knows and the word splitter does not.
_OTHER_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Kinds of bytes: 0 white space, 2 letter, 3 punctuation but the apostrophe, 1 any other.
_KIND = np.ones(256, np.uint8)
_KIND[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 2
_KIND[[c for c in range(0x21, 0x7F) if not chr(c).isalnum() and c != 0x27]] = 3
_encoders: dict[str, "Encoder"] = {}


class Encoder:
    """Byte-level BPE ids of many texts. The pre-tokenizer never joins a word with the white space behind it, so the
    ids of a text are those of its units (white space, then a word) one after the other; equal units are encoded once."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.forget()

    def forget(self) -> None:
        self.unit, self.at, self.size = np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, unit: np.ndarray, texts: list[str]) -> None:
        """unit: in order, none of them known."""
        encoded = self._encode(texts)
        size = np.fromiter(map(len, encoded), np.int64, len(encoded))
        at = len(self.ids) + np.cumsum(size) - size
        self.ids = np.concatenate([self.ids, np.fromiter((i for x in encoded for i in x), np.uint32, int(size.sum()))])
        place = np.searchsorted(self.unit, unit)
        self.unit, self.at, self.size = np.insert(self.unit, place, unit), np.insert(self.at, place, at), np.insert(self.size, place, size)

    def _place(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.minimum(np.searchsorted(self.unit, unit), max(0, len(self.unit) - 1))
        return place, (self.unit[place] == unit) if len(self.unit) else np.zeros(len(unit), bool)

    def encode(self, texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and the number of ids of each."""
        data, text_end = text_bytes(texts)
        # Units end where words end, between an ASCII letter and ASCII punctuation (which the pre-tokenizer always parts, but for the
        # apostrophe), and where texts end (the line feed behind a text belongs to none).
        kind = _KIND[data]
        ends = np.zeros(len(data), bool)
        ends[1:] = (kind[:-1] != 0) & (kind[1:] == 0) | (kind[:-1] == 2) & (kind[1:] == 3)
        ends[text_end] = True
        stop = np.flatnonzero(ends)
        text = np.searchsorted(text_end, stop)
        start = np.zeros(len(stop), np.int64)
        start[1:] = stop[:-1] + (text_end[text] == stop)[:-1]
        some = start < stop
        start, stop, text = start[some], stop[some], text[some]
        unit = range_hashes(data, start, stop)
        distinct, first, inverse = np.unique(unit, return_index=True, return_inverse=True)
        if len(self.ids) > REMEMBERED_IDS:
            self.forget()
        place, known = self._place(distinct)
        if not known.all():
            new = first[~known]
            raw = data.tobytes()
            self._learn(distinct[~known], [raw[a:b].decode() for a, b in zip(start[new].tolist(), stop[new].tolist())])
            place, _ = self._place(distinct)
        size = self.size[place][inverse]
        ids = self.ids[range_index(self.at[place][inverse], size)]
        per_text = np.bincount(text, weights=size, minlength=len(text_end)).astype(np.int64)
        return ids, per_text


def encoder(path: str) -> Encoder:
    """One for each file in a Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def token_ids(texts: pa.ChunkedArray, path: str) -> list[np.ndarray]:
    """Ids of each text (null: none)."""
    enc = encoder(path)
    filled = texts.cast(pa.large_string()).fill_null("")
    ids, per_text = enc.encode(filled)
    out = np.split(ids, np.cumsum(per_text)[:-1]) if len(per_text) else []
    odd = [i for i, x in enumerate(filled.to_pylist()) if not x.isascii() and _OTHER_SPACE.search(x)]
    for i, whole in zip(odd, enc._encode([filled[i].as_py() for i in odd])):
        out[i] = np.array(whole, np.uint32)
    return out


def _tokenize(path: str, end_id: int):
    def run(batches):
        before = 0
        for batch in batches:
            for part in steps(batch, "text", STEP):
                ids = [np.append(x, np.uint32(end_id)) for x in token_ids(part["text"], path)]
                size = np.fromiter(map(len, ids), np.int64, len(ids))
                wide = max((int(x.max()) for x in ids), default=0) > 0xFFFF
                kind = np.uint32 if wide else np.uint16
                yield pa.record_batch({
                    "doc_id": part["doc_id"].combine_chunks(), "before": before + np.cumsum(size) - size, "n_tokens": size,
                    "id_bytes": pa.array([kind().itemsize] * len(ids), pa.int32()), "ids": pa.array([x.astype(kind).tobytes() for x in ids], pa.binary()),
                })
                before += int(size.sum())

    return run


def _cut(window: int, with_ids: bool):
    def run(batches):
        for batch in batches:
            base = batch["base"].to_numpy() + batch["before"].to_numpy()
            n = batch["n_tokens"].to_numpy()
            first, last = base // window, (base + n - 1) // window
            pieces = last - first + 1
            doc = np.repeat(np.arange(len(n)), pieces)
            sequence = range_index(first, pieces)
            start = np.maximum(sequence * window, base[doc])
            stop = np.minimum((sequence + 1) * window, (base + n)[doc])
            ids = [np.frombuffer(x, "<u2" if w == 2 else "<u4").astype("<u4").tobytes() for x, w in zip(batch["ids"].to_pylist(), batch["id_bytes"].to_pylist())]
            part = [memoryview(ids[d])[4 * i : 4 * j] for d, i, j in zip(doc.tolist(), (start - base[doc]).tolist(), (stop - base[doc]).tolist())]
            out = {
                "doc_id": pc.take(batch["doc_id"], pa.array(doc)), "start": start - base[doc], "length": stop - start,
                "ids_crc32": pa.array([zlib.crc32(x) for x in part], pa.int64()), "doc_tokens": n[doc], "sequence_id": sequence, "offset": start - sequence * window,
            }
            if with_ids:
                out["ids"] = pa.array([x.tobytes() for x in part], pa.binary())
            yield pa.record_batch(out)

    return run


def pack(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = SEQUENCE_TOKENS, end_id: int = END_ID, with_ids: bool = True
) -> DataFrame:
    """Pieces of all rows in sequences of ``window`` tokens; only the last sequence may be shorter.

    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, with_ids, ids (little-endian
    unsigned 32-bit), one row per piece. A null or empty text is the end id alone. Repeated rows and null ids are packed like any other row.
    Other columns are ignored; an empty table gives no pieces. Texts are tokenized whole.
    """
    spark = docs.sparkSession
    small_batches(spark)
    path = scratch_path(spark, "tokens")
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    plain.mapInArrow(_tokenize(tokenizer_path, end_id), "doc_id bigint, before bigint, n_tokens bigint, id_bytes int, ids binary").withColumn(
        "part", F.spark_partition_id()
    ).write.option("compression", "zstd").parquet(path)
    tokens = spark.read.parquet(path)
    totals = tokens.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # one row for each task of pass 1
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    # One row for each task of pass 1: that bounds what is broadcast.
    placed = tokens.join(F.broadcast(offsets), "part").select("doc_id", "before", "n_tokens", "id_bytes", "ids", "base")
    schema = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return placed.mapInArrow(_cut(window, with_ids), schema + ", ids binary" * with_ids)
