"""Liveness, log search, retention and listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.constants import ARCHIVE_DAYS, DEEP_ARCHIVE_DAYS, HEARTBEAT_MAX_GAP_S, RETENTION_DAYS
from tributary.functions.timestamps import millis

DAY_MS = 86_400_000


def search_events(
    events: DataFrame,
    pattern: str | None = None,
    json_path: str | None = None,
    equals: str | None = None,
    start_ms: int | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Events whose message holds a substring, or whose JSON field equals a text, from a start time on.

    A limited search returns the earliest events.
    """
    found = events
    if start_ms is not None:
        found = found.filter(F.col("event_ts_ms") >= start_ms)
    if pattern is not None:
        found = found.filter(F.col("message").contains(pattern))
    if json_path is not None:
        found = found.filter(F.try_variant_get(F.try_parse_json("message"), json_path, "string") == equals)
    if limit is not None:
        found = found.orderBy("event_ts_ms", *[c for c in found.columns if c != "event_ts_ms"]).limit(limit)
    return found


def audit_keys(listing: DataFrame) -> DataFrame:
    """Objects written with an empty path segment. Works on key strings: file systems fold slashes."""
    return listing.filter(F.col("object_key").contains("//"))


def expired_objects(listing: DataFrame, as_of, days: int = RETENTION_DAYS) -> DataFrame:
    if days < 1:
        raise ValueError("retention is at least one day")
    return listing.filter(F.col("modified_ms") < millis(as_of) - F.lit(days * DAY_MS))


def storage_tier(listing: DataFrame, as_of) -> DataFrame:
    age = F.floor((millis(as_of) - F.col("modified_ms")) / DAY_MS)
    tier = F.when(age >= DEEP_ARCHIVE_DAYS, "deep_archive").when(age >= ARCHIVE_DAYS, "archive").otherwise("standard")
    return listing.withColumn("age_days", age.cast("bigint")).withColumn("tier", tier)


def heartbeat_gaps(beats: DataFrame, as_of, key: str = "cluster_id", max_gap_s: int = HEARTBEAT_MAX_GAP_S) -> DataFrame:
    """Silences longer than the limit: key, from_ms, to_ms, gap_ms, ongoing.

    Beats fold into time buckets as wide as the limit first. Two beats of one bucket are never a
    silence apart, so only bucket edges are compared, and a busy key shrinks to its buckets before
    anything is ordered.
    """
    width = max_gap_s * 1000
    edges = beats.groupBy(key, F.floor(F.col("ts_ms") / width).alias("_bucket")).agg(
        F.min("ts_ms").alias("_first"), F.max("ts_ms").alias("_last")
    )
    following = F.lead("_first").over(Window.partitionBy(key).orderBy("_bucket"))
    paired = edges.withColumn("_next", following).withColumn("to_ms", F.coalesce("_next", millis(as_of)))
    gap = F.col("to_ms") - F.col("_last")
    return paired.filter(gap > width).select(
        key, F.col("_last").alias("from_ms"), "to_ms", gap.alias("gap_ms"), F.col("_next").isNull().alias("ongoing")
    )


def heartbeat_records(events: DataFrame) -> DataFrame:
    """Messages that are heartbeat records (JSON with ``heartbeat`` true)."""
    flag = F.try_variant_get(F.try_parse_json("message"), "$.heartbeat", "boolean")
    return events.filter(F.col("message").startswith("{") & F.coalesce(flag, F.lit(False)))


def streams_by_recency(events: DataFrame, n: int, keys: Sequence[str] = ("log_group", "log_stream")) -> DataFrame:
    """The n streams with the newest last event."""
    latest = events.groupBy(*keys).agg(F.max("event_ts_ms").alias("last_event_ms"))
    return latest.orderBy(F.desc("last_event_ms"), *keys).limit(n)


def latest_objects(listing: DataFrame, n: int) -> DataFrame:
    return listing.orderBy(F.desc("modified_ms"), F.desc("object_key")).limit(n)


def object_counts(listing: DataFrame, keys: Sequence[str]) -> DataFrame:
    return listing.groupBy(*keys).agg(F.count("*").alias("objects"))


def storage_stats(listing: DataFrame) -> DataFrame:
    """Objects and bytes per day, with the average object size."""
    day = F.floor(F.col("modified_ms") / DAY_MS).cast("bigint")
    return listing.groupBy(day.alias("epoch_day")).agg(
        F.count("*").alias("objects"),
        F.sum("size_bytes").alias("total_bytes"),
        (F.sum("size_bytes") / F.count("*")).alias("avg_bytes"),
    )
