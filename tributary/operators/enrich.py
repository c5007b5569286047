"""Collector transforms: metadata, event time, storage shape, and the registry that chains them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions import timestamps as T
from tributary.functions.records import trimmed, with_json_object
from tributary.functions.rules import log_level
from tributary.functions.timestamps import millis

UNKNOWN = "unknown"


def pipeline(steps: Sequence[tuple[str, Callable[[DataFrame], DataFrame]]]) -> Callable[[DataFrame], DataFrame]:
    """Named row transforms applied in order."""

    def run(df: DataFrame) -> DataFrame:
        for _, step in steps:
            df = df.transform(step)
        return df

    return run


def enrich_metadata(df: DataFrame, cluster_id: str | Column | None, as_of) -> DataFrame:
    """Adds the four routing dimensions and the ingest time.

    Only a missing value becomes ``unknown``; an empty one stays and shows up later as a bad key.
    The ingest time is taken before any event time is read.
    """
    known = F.col("kubernetes")
    cluster = cluster_id if isinstance(cluster_id, Column) else F.lit(cluster_id)

    def or_unknown(value: Column) -> Column:
        return F.coalesce(value, F.lit(UNKNOWN))

    stamped = F.coalesce(F.col("timestamp"), F.timestamp_millis(millis(as_of)))
    return df.withColumns(
        {
            "cluster_id": or_unknown(cluster.cast("string")),
            "namespace": or_unknown(known["pod_namespace"]),
            "application": or_unknown(F.try_element_at(known["pod_labels"], F.lit("app"))),
            "pod_name": or_unknown(known["pod_name"]),
            "timestamp": stamped,
            "ingest_timestamp": stamped,
        }
    )


def with_json_event_time(df: DataFrame, assume_utc: bool = True) -> DataFrame:
    """Event time from messages that are JSON objects. The message itself is not touched."""
    return T.with_json_event_time(df, "message", "timestamp", assume_utc)


def with_text_event_time(df: DataFrame, as_of, assume_utc: bool = True) -> DataFrame:
    return T.with_text_event_time(df, "message", "timestamp", as_of, assume_utc)


def with_event_time(df: DataFrame, as_of, assume_utc: bool = True) -> DataFrame:
    """JSON reading first, then the text reading on the same message."""
    return df.transform(with_json_event_time, assume_utc).transform(with_text_event_time, as_of, assume_utc)


def collect(df: DataFrame, cluster_id: str | Column | None, as_of) -> DataFrame:
    """The whole collector chain."""
    steps = [
        ("enrich_metadata", lambda d: enrich_metadata(d, cluster_id, as_of)),
        ("parse_json_logs", with_json_event_time),
        ("parse_plain_text_timestamps", lambda d: with_text_event_time(d, as_of)),
    ]
    return pipeline(steps)(df)


def merge_json_message(df: DataFrame, record: str = "record", message: str = "message") -> DataFrame:
    """Shallow merge of a JSON-object message into a map<string,variant> record; parsed keys win.

    Anything but an object leaves the record as it is.
    """
    parsed = with_json_object(df, trimmed(F.col(message)), "_v").withColumn("_parsed", F.col("_v").cast("map<string,variant>"))
    kept = F.map_filter(record, lambda k, _: ~F.map_contains_key(F.col("_parsed"), k))
    merged = F.when(F.col("_parsed").isNull(), F.col(record)).otherwise(F.map_concat(kept, F.col("_parsed")))
    return parsed.withColumn(record, merged).drop("_v", "_parsed")


def extract_log_level(df: DataFrame, message: str = "message") -> DataFrame:
    return df.withColumn("log_level", log_level(F.col(message)))


STORAGE_COLUMNS = (
    "timestamp",
    "customer_id",
    "cluster_id",
    "environment",
    "application",
    "pod_name",
    "log_level",
    "message",
    "source",
)


def structure_record(df: DataFrame, source: str) -> DataFrame:
    """The nine storage columns and nothing else."""
    return df.withColumn("source", F.lit(source)).select(*STORAGE_COLUMNS)


def render_object_key(df: DataFrame, time: str = "timestamp_ms", suffix: str = ".json.gz") -> DataFrame:
    """Key of the object a row would be written to; a content hash stands in for the random id."""
    stamp = F.date_format(F.timestamp_millis(F.col(time)), "yyyyMMdd-HHmmss")
    name = F.concat(stamp, F.lit("-"), F.md5(F.col("message")), F.lit(suffix))
    dims = ("cluster_id", "namespace", "application", "pod_name")
    return df.withColumn("object_key", F.concat_ws("/", *dims, name))
