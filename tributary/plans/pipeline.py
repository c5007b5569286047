"""Compositions of the operators: the flows a user runs end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions.rules import application_enabled
from tributary.operators import accounting as A
from tributary.operators.enrich import with_event_time
from tributary.operators.routing import extract_tenant_info, lookup_join, split_valid_keys
from tributary.sources.notifications import parse_notifications


def route_summary(raw: DataFrame, configs: DataFrame, as_of, salt: int | None = None) -> DataFrame:
    """Events and time span per (tenant, delivery type, application).

    The key of a line decides where it goes, so lines meet the configs first, once per tenant, and only those that go somewhere are
    parsed. They fold into one row per tenant and application before the delivery types part.
    """
    delivery = F.struct("type", "desired_logs")
    per_tenant = configs.groupBy("tenant_id").agg(F.collect_list(delivery).alias("_deliveries"))
    valid, _ = split_valid_keys(raw.select("object_key", "message", "ingest_ms"))
    named = lookup_join(extract_tenant_info(valid), per_tenant, ["tenant_id"], salt)
    types = F.transform(F.filter("_deliveries", lambda d: application_enabled(d["desired_logs"], F.col("application"))), lambda d: d["type"])
    wanted = named.withColumn("_types", types).where("size(_types) > 0").select("tenant_id", "application", "_types", "message", F.timestamp_millis("ingest_ms").alias("timestamp"))
    timed = wanted.transform(with_event_time, as_of)
    folded = timed.groupBy("tenant_id", "application").agg(
        F.count("*").alias("events"), F.min(F.unix_millis("timestamp")).alias("first_event_ms"), F.max(F.unix_millis("timestamp")).alias("last_event_ms"), F.first("_types").alias("_types")
    )
    return folded.select("tenant_id", F.explode("_types").alias("type"), "application", "events", "first_event_ms", "last_event_ms")


def attempts_of(routed: DataFrame) -> DataFrame:
    """Delivery attempts with a reproducible outcome, for queries that need outcomes to count."""
    eid = F.col("eid")
    tries = routed.select(
        "object_key",
        "tenant_id",
        "type",
        (eid % 6 != 0).alias("succeeded"),
        "upload_ms",
        (F.col("upload_ms") + 1000 + eid % 977).alias("delivered_ms"),
        "eid",
    )
    return tries.withColumn("ts", F.timestamp_millis("delivered_ms"))


def message_results(t) -> DataFrame:
    """One row per message: error class and delivery counts over its objects."""
    notes = parse_notifications(t.messages.select("message_id", "body"))
    counts = A.delivery_stats(attempts_of(t.routed), ["object_key"])
    # Messages without a key meet nothing: each gets a key of its own, so that they do not gather in one task.
    own = notes.withColumn("_key", F.coalesce("object_key", F.concat(F.lit("\0"), "message_id")))
    joined = own.join(counts.withColumnRenamed("object_key", "_key"), "_key", "left")
    return joined.groupBy("message_id").agg(
        F.min("error_class").alias("error_class"),
        F.coalesce(F.sum("successful_deliveries"), F.lit(0)).alias("successful_deliveries"),
        F.coalesce(F.sum("failed_deliveries"), F.lit(0)).alias("failed_deliveries"),
    )
