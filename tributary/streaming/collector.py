"""Pod log lines -> event time -> central store, continuously."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tributary.operators.enrich import collect
from tributary.schemas import POD_LOG
from tributary.sinks.central import stream_central
from tributary.sources.pods import select_labelled


def now_ms() -> Column:
    """Start time of the micro-batch, for jobs that run without a fixed time."""
    return F.unix_millis(F.current_timestamp())


def read_pod_logs(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(POD_LOG)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def start_collector(
    logs: DataFrame,
    cluster_id: str,
    path: str,
    checkpoint: str,
    label: tuple[str, str] | None = None,
    as_of=None,
    once: bool = False,
) -> StreamingQuery:
    """One stateless query: label filter, metadata, event time, central sink."""
    chosen = select_labelled(logs, *label) if label else logs
    return stream_central(collect(chosen, cluster_id, now_ms() if as_of is None else as_of), path, checkpoint, once)
