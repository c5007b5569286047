"""From routed objects to event batches and copy plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.constants import COPY_ACL, MAX_BATCH_BYTES, MAX_BATCH_EVENTS
from tributary.functions import keys as K
from tributary.functions.timestamps import millis
from tributary.operators.packing import pack_batches
from tributary.operators.records import PLACE, fallback_ts, parse_lines, to_log_events
from tributary.operators.routing import (
    event_destination,
    extract_tenant_info,
    lookup_join,
    route,
    split_valid_keys,
)

# One delivery: the events of one object going to one stream.
DELIVERY = ["tenant_id", "type", "log_group", "log_stream", "object_key"]


def with_destination_key(routed: DataFrame) -> DataFrame:
    return routed.withColumn(
        "dst_key",
        K.destination_key(
            F.col("bucket_prefix"), F.col("tenant_id"), F.col("application"), F.col("pod_name"), F.col("object_key")
        ),
    )


def delivery_metadata(as_of) -> Column:
    """Six traceability entries of a copied object; the cluster id is not among them."""
    pairs = {
        "source-bucket": F.col("bucket"),
        "source-key": F.col("object_key"),
        "tenant-id": F.col("tenant_id"),
        "application": F.col("application"),
        "pod-name": F.col("pod_name"),
        "delivery-timestamp": F.floor(millis(as_of) / 1000).cast("string"),
    }
    return F.create_map(*[c for name, value in pairs.items() for c in (F.lit(name), value)])


def plan_object_copies(routed: DataFrame, as_of) -> DataFrame:
    """One copy per (object, s3 config): where from, where to, with what metadata."""
    planned = with_destination_key(routed.filter("type = 's3'"))
    return planned.select(
        "tenant_id",
        F.concat_ws("/", "bucket", "object_key").alias("copy_source"),
        "bucket",
        "object_key",
        F.col("bucket_name").alias("dst_bucket"),
        "dst_key",
        delivery_metadata(as_of).alias("metadata"),
        F.lit(COPY_ACL).alias("acl"),
    )


# What a line carries from routing to packing.
STREAM = ["tenant_id", "type", "log_group", "log_stream", "upload_ms"]


def lines_to_deliver(lines: DataFrame, configs: DataFrame, salt: int | None = None) -> DataFrame:
    """Lines of objects with an event delivery, with the stream they go to; needs ``upload_ms`` per line.

    The key alone decides, so routing comes before any parsing and needs no listing: with a config
    table below the broadcast size the lines are not shuffled at all, above it AQE or ``salt`` split
    a hot tenant.
    """
    valid, _ = split_valid_keys(lines)
    named = extract_tenant_info(valid).select(*lines.columns, "tenant_id", "application", "pod_name")
    streams = configs.filter("type = 'cloudwatch'").select("tenant_id", "type", "log_group_name", "desired_logs")
    routed = event_destination(route(named, streams, salt))
    return routed.select(*lines.columns, *[c for c in STREAM if c not in lines.columns])


def lines_of_routed(lines: DataFrame, routed: DataFrame, salt: int | None = None) -> DataFrame:
    """Lines of routed objects, once per event delivery, with their stream and the upload time of the object.

    For callers that have a listing: the join comes before the parse, so lines that go nowhere are not parsed.
    """
    streams = event_destination(routed.filter("type = 'cloudwatch'")).select("object_key", *STREAM)
    return lookup_join(lines, streams, ["object_key"], salt)


def routed_events(lines: DataFrame, as_of) -> DataFrame:
    """Events of routed lines with the time sent to their stream."""
    return fallback_ts(to_log_events(parse_lines(lines), as_of, STREAM)).drop("upload_ms")


def pack_deliveries(
    deliveries: DataFrame,
    max_events: int = MAX_BATCH_EVENTS,
    max_bytes: int = MAX_BATCH_BYTES,
    chunks: int | None = None,
) -> DataFrame:
    """Chronological order and batch numbers per delivery."""
    order = ["event_ts_ms", *[c for c in PLACE if c not in DELIVERY]]
    return pack_batches(deliveries, DELIVERY, order, max_events=max_events, max_bytes=max_bytes, chunks=chunks, costly=True)


def delivery_batches(packed: DataFrame, keys: Sequence[str] = tuple(DELIVERY)) -> DataFrame:
    """One row per batch with its events in order. A batch is bounded, so the list is too."""
    event = F.struct("seq", "event_ts_ms", "message")
    return packed.groupBy(*keys, "batch_id").agg(
        F.count("*").alias("events"), F.sort_array(F.collect_list(event)).alias("log_events")
    )
