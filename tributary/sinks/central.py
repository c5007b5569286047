"""Central store: gzip NDJSON objects below the four routing dimensions."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tributary.constants import CENTRAL_OBJECT_BYTES, CENTRAL_OBJECT_SECONDS
from tributary.functions.keys import DIMENSIONS
from tributary.session import ship_with_tasks
from tributary.sinks.objects import EMPTY_FOLDER, write_lines
from tributary.sources.objects import read_log_objects, store_root

ship_with_tasks(__name__)

# The dimensions stay in the record; copies of them name the folders.
FOLDERS = tuple(f"key_{name}" for name in DIMENSIONS)
STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
BATCH, ROLL = "batch", "roll"


def _with_folders(df: DataFrame) -> DataFrame:
    return df.withColumns({folder: F.col(name) for folder, name in zip(FOLDERS, DIMENSIONS)})


def _roll(limit: int):
    """Numbers the objects of each folder in a task, so that the lines of one stay within ``limit`` bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_object: dict[tuple, tuple[int, int]] = {}  # folder -> (number, bytes so far)
        for batch in batches:
            size = batch["_bytes"].to_numpy()
            names = list(zip(*(batch[f].to_pylist() for f in FOLDERS)))
            known = {name: i for i, name in enumerate(dict.fromkeys(names))}
            folder = np.fromiter((known[n] for n in names), np.int64, len(names))
            roll = np.zeros(len(size), np.int64)
            for name, i in known.items():
                at = np.flatnonzero(folder == i)
                upto = np.cumsum(size[at])
                number, used = open_object.get(name, (0, 0))
                first, before = 0, 0
                while first < len(at):
                    stop = int(np.searchsorted(upto, before + limit - used, side="right"))
                    if stop == first and not used:
                        stop += 1  # a line above the limit has an object of its own
                    roll[at[first:stop]] = number
                    if stop < len(at):
                        number, used, before = number + 1, 0, upto[stop - 1] if stop else 0
                    else:
                        used += int(upto[-1] - before)
                    first = stop
                open_object[name] = (number, used)
            rest = [c for c in batch.schema.names if c != "_bytes"]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in rest), pa.array(roll)], [*rest, ROLL])

    return run


def in_arrival_order(rows: DataFrame, folders: Sequence[str]) -> DataFrame:
    """Rows of each folder one after the other within a task, in the order in which they came."""
    return rows.withColumn("_at", F.monotonically_increasing_id()).sortWithinPartitions(*folders, "_at").drop("_at")


def write_central(df: DataFrame, path: str, mode: str = "append", object_bytes: int = CENTRAL_OBJECT_BYTES) -> None:
    """Writes enriched log lines as ``.json.gz`` objects below cluster/namespace/application/pod.

    Rebalancing by folder splits a hot one over many tasks and joins cold ones into few. An object holds
    at most ``object_bytes`` of unpacked lines, or one longer line. Tasks write and name the objects themselves where they can open
    the folder; on other file systems Spark's own writer does, which lists and renames them in the driver.
    """
    folded = _with_folders(df)
    line = F.to_json(F.struct(*df.columns), {"timestampFormat": STAMP})
    if mode in ("append", "overwrite") and store_root(df.sparkSession, path, make=True):
        if mode == "overwrite":
            place = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
        lines = folded.hint("rebalance", *FOLDERS).select(*[F.col(f).cast("string").alias(f) for f in FOLDERS], line.alias("line"))
        return write_lines(in_arrival_order(lines, FOLDERS), path, FOLDERS, ".json.gz", ROLL, object_bytes)
    sized = folded.hint("rebalance", *FOLDERS).withColumn("_bytes", F.octet_length(line).cast("bigint") + 1)
    schema = T.StructType([*folded.schema.fields, T.StructField(ROLL, T.LongType())])
    (
        sized.mapInArrow(_roll(object_bytes), schema)
        .write.mode(mode)
        .partitionBy(*FOLDERS, ROLL)
        .option("compression", "gzip")
        .option("timestampFormat", STAMP)
        .json(path)
    )


def stream_central(
    df: DataFrame, path: str, checkpoint: str, once: bool = False, object_bytes: int = CENTRAL_OBJECT_BYTES
) -> StreamingQuery:
    """The streaming form; a batch is closed every five minutes, or after all there is with ``once``.

    Each micro-batch goes through :func:`write_central` to a folder of its own, which a replay overwrites.
    """

    def write(rows: DataFrame, number: int) -> None:
        write_central(rows, f"{path.rstrip('/')}/{BATCH}={number}", "overwrite", object_bytes)

    trigger = {"availableNow": True} if once else {"processingTime": f"{CENTRAL_OBJECT_SECONDS} seconds"}
    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def bare_key(key: Column) -> Column:
    """``key_cluster_id=a/key_namespace=b/..`` -> ``a/b/..``; the folder of empty values becomes empty, those of
    micro-batches and of rolled objects go."""
    ours = F.regexp_replace(key, rf"(^|/)(?:{BATCH}|{ROLL})=[0-9]+/", "$1")
    plain = F.regexp_replace(ours, rf"(^|/)(?:{'|'.join(FOLDERS)})=", "$1")
    return F.replace(F.try_url_decode(F.replace(plain, F.lit("+"), F.lit("%2B"))), F.lit(EMPTY_FOLDER), F.lit(""))


def read_central(spark: SparkSession, path: str) -> DataFrame:
    """(object_key, line_no, line) of a central store, with keys in the bare layout."""
    return read_log_objects(spark, path).withColumn("object_key", bare_key(F.col("object_key")))


def fan_out(df: DataFrame, sinks: Sequence[Callable[[DataFrame], None]]) -> None:
    """Feeds several sinks from one computation of the rows."""
    kept = df.persist()
    try:
        for sink in sinks:
            sink(kept)
    finally:
        kept.unpersist()


def stream_fan_out(
    df: DataFrame, sinks: Sequence[Callable[[DataFrame, int], None]], checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Streaming form of :func:`fan_out`; sinks get the batch number to write replays in place."""

    def batch(rows: DataFrame, number: int) -> None:
        fan_out(rows, [lambda d, s=s: s(d, number) for s in sinks])

    trigger = {"availableNow": True} if once else {"processingTime": f"{CENTRAL_OBJECT_SECONDS} seconds"}
    return df.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**trigger).start()
