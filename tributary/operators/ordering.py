"""Ordered work per key without putting a whole key into one task.

A window over a hot key would sort that key in a single task. Here the rows are range-partitioned on
(key, order), so a hot key spreads over many sorted chunks. Each chunk works alone, and the little a
chunk must know about its predecessors travels as one carry row per chunk.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.session import ensure_checkpoint_dir, ship_with_tasks

ship_with_tasks(__name__)

CHUNK = "_chunk"


def range_chunks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunks: int | None = None, costly: bool = False
) -> DataFrame:
    """Rows sorted by keys and order, cut into numbered chunks.

    The range bounds come from a sample, so two runs of the same plan may cut differently. The
    checkpoint pins chunk numbers and survives a lost executor. ``order`` must be unique per key.

    Sampling runs the input once more. For ``costly`` input (parsed, joined) one hash shuffle comes
    first: its files serve the sample and the real run, and the unique order spreads rows evenly.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = chunks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartition(n, *keys, *order) if costly else df
    return (
        rows.repartitionByRange(n, *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn(CHUNK, F.spark_partition_id())
        .checkpoint()
    )


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """NULL-safe equality on the keys and the chunk number."""
    condition = left[CHUNK] == right[CHUNK]
    for k in keys:
        condition = condition & left[k].eqNullSafe(right[k])
    return condition


def _same_as_before(column: pa.Array) -> np.ndarray:
    """Whether each value but the first equals the one before; NULL equals NULL."""
    now, before = column.slice(1), column.slice(0, len(column) - 1)
    nulls = pc.and_(pc.is_null(now), pc.is_null(before))
    return pc.or_(nulls, pc.fill_null(pc.equal(now, before), False)).to_numpy(zero_copy_only=False)


def _chunk_sums(keys: Sequence[str], inclusive: bool):
    """Running sums of ``_v`` per key along the sorted rows of one chunk, block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carried = None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            value = batch["_v"].to_numpy()
            begins = np.zeros(n, bool)
            for k in keys:
                begins[1:] |= ~_same_as_before(batch[k])
            begins[0] = last != [batch[k][0].as_py() for k in keys]
            total = np.cumsum(value)
            # What the sum had reached when the key of a row began; less than 0 for a key that goes on from the block before.
            at = np.maximum.accumulate(np.where(begins, np.arange(n), -1))
            base = np.where(at >= 0, (total - value)[at], -carried)
            local = total - base
            last, carried = [batch[k][n - 1].as_py() for k in keys], int(local[-1])
            out = local if inclusive else local - value
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], [*batch.schema.names, "_local"])

    return run


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    out: str,
    inclusive: bool = True,
    chunks: int | None = None,
    costly: bool = False,
) -> DataFrame:
    """Running sum of a bigint expression per key, exact for keys of any size.

    A NULL value counts as 0. The rows of a chunk lie sorted in one partition, so they are summed where they are, block by
    block: behind the range shuffle nothing but the carry rows moves.
    """
    pinned = range_chunks(df.withColumn("_v", F.coalesce(value.cast("bigint"), F.lit(0).cast("bigint"))), keys, order, chunks, costly)
    local = pinned.mapInArrow(_chunk_sums(list(keys), inclusive), T.StructType([*pinned.schema.fields, T.StructField("_local", T.LongType())]))

    # Rows per key: the chunks it touches. Only the first key of a chunk can have a predecessor, so
    # at most one carry row per chunk is left and the broadcast is bounded by the chunk count.
    before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        pinned.groupBy(CHUNK, *keys)
        .agg(F.sum("_v").alias("_total"))
        .withColumn("_carry", F.sum("_total").over(before))
        .filter(F.col("_carry") != 0)
        .select(CHUNK, *keys, "_carry")
    )
    joined = local.join(F.broadcast(carry), same_keys(local, carry, keys), "left")
    result = (F.col("_local") + F.coalesce(F.col("_carry"), F.lit(0))).alias(out)
    return joined.select(*[local[c] for c in df.columns], result)


def row_rank(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, chunks: int | None = None, costly: bool = False
) -> DataFrame:
    """1-based row number per key."""
    return running_total(df, keys, order, F.lit(1), out, chunks=chunks, costly=costly)
