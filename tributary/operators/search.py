"""Log search that opens only objects that may hold the term.

Beside the objects lies an index: for each object a bit set over hashes of all runs of three bytes in its lines. A line that holds a term of three bytes
or more has all runs of the term, so an object that lacks one of their bits is never opened. A bit set is the list of its bits, so a small object has a
small one. Bit sets merge by union, so parts of an object, or indexes of several runs, can be put together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.session import ship_with_tasks
from tributary.sources.objects import read_whole_objects

ship_with_tasks(__name__)

#: Bits of one block, and blocks of a bit set: 131,072 bits for an object of up to 64 MB.
BLOCK_BITS, BLOCKS = 32_768, 4


def run_bits(data: np.ndarray, blocks: int) -> np.ndarray:
    """Bits of the runs of three bytes within a line."""
    if len(data) < 3:
        return np.zeros(0, np.int64)
    wide = data.astype(np.uint64)
    run = (wide[:-2] << np.uint64(16)) | (wide[1:-1] << np.uint64(8)) | wide[2:]
    broken = data == 10
    run = run[~(broken[:-2] | broken[1:-1] | broken[2:])]
    mixed = (run * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    return np.unique(mixed % np.uint64(BLOCK_BITS * blocks)).astype(np.int64)


def _index(blocks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch["object_key"].dictionary_encode()
            code = key.indices.to_numpy(zero_copy_only=False)
            order = np.argsort(code, kind="stable")
            lines = pc.binary_join_element_wise(batch["line"].fill_null("").cast(pa.large_string()), pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string())).take(pa.array(order))
            offsets = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset : lines.offset + len(lines) + 1]
            data = np.frombuffer(lines.buffers()[2] or b"", np.uint8)
            cuts = np.flatnonzero(np.diff(code[order], prepend=-1, append=-1)) if len(order) else np.zeros(0, np.int64)
            names, found = [], []
            for a, b in zip(cuts, cuts[1:]):
                names.append(key.dictionary[int(code[order[a]])].as_py())
                found.append(run_bits(data[offsets[a] : offsets[b]], blocks).astype(np.int32))
            bits = pa.ListArray.from_arrays(np.cumsum([0, *map(len, found)]).astype(np.int32), pa.array(np.concatenate([np.zeros(0, np.int32), *found])))
            yield pa.record_batch({"object_key": pa.array(names, pa.string()), "bits": bits})

    return run


def _together(parts: DataFrame) -> DataFrame:
    return parts.groupBy("object_key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("bits")))).alias("bits"))


def build_index(lines: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """(object_key, bits) of lines (object_key, line), one row an object. Rows of one batch are folded before anything moves."""
    return _together(lines.select("object_key", "line").mapInArrow(_index(blocks), "object_key string, bits array<int>"))


def merge_indexes(one: DataFrame, other: DataFrame) -> DataFrame:
    """The index of the lines of both."""
    return _together(one.unionByName(other))


def may_hold(index: DataFrame, term: str, blocks: int = BLOCKS) -> DataFrame:
    """Keys of the objects that may hold a term. One shorter than three bytes may be anywhere."""
    bits = run_bits(np.frombuffer(term.encode(), np.uint8), blocks).tolist()
    needed = F.lit(True)
    for bit in bits:
        needed = needed & F.array_contains("bits", F.lit(bit))
    return index.where(needed).select("object_key")


def search_objects(spark: SparkSession, path: str, index: DataFrame, term: str, blocks: int = BLOCKS) -> DataFrame:
    """(object_key, line_no, line, error_code) of the lines that hold the term; only objects that may hold it are opened."""
    found = read_whole_objects(spark, path, may_hold(index, term, blocks))
    lines = found.select("object_key", "error_code", F.posexplode_outer(F.split("content", "\n")).alias("line_no", "line"))
    return lines.where(F.contains("line", F.lit(term)) | F.col("error_code").isNotNull()).select("object_key", "line_no", "line", "error_code")
