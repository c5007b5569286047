"""Outcomes, statistics and metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.rules import metric_name
from tributary.functions.timestamps import millis


def message_actions(outcomes: DataFrame) -> DataFrame:
    """Delete finished and hopeless messages, keep those worth a retry.

    ``outcomes`` has one row per record or message with ``error_class``; the worst one decides.
    """
    return outcomes.groupBy("message_id").agg(
        F.when(F.bool_or(F.coalesce(F.col("error_class") == "recoverable", F.lit(False))), "retry")
        .otherwise("delete")
        .alias("action")
    )


def batch_summary(results: DataFrame) -> DataFrame:
    """Totals over message results (error_class, successful_deliveries, failed_deliveries)."""
    ok = F.col("error_class").isNull()
    return results.agg(
        F.count_if(ok).alias("successful_records"),
        F.count_if(F.col("error_class") == "recoverable").alias("failed_records"),
        F.count_if(F.col("error_class") == "non_recoverable").alias("undeliverable_records"),
        F.coalesce(F.sum(F.when(ok, F.col("successful_deliveries"))), F.lit(0)).alias("successful_deliveries"),
        F.coalesce(F.sum(F.when(ok, F.col("failed_deliveries"))), F.lit(0)).alias("failed_deliveries"),
    )


def batch_item_failures(results: DataFrame) -> DataFrame:
    """Messages to hand back to the queue, as rows: the list may be long."""
    return results.filter("error_class = 'recoverable'").select(F.col("message_id").alias("item_identifier"))


def delivery_stats(attempts: DataFrame, keys: Sequence[str] = ("message_id",)) -> DataFrame:
    return attempts.groupBy(*keys).agg(
        F.count_if("succeeded").alias("successful_deliveries"),
        F.count_if(~F.col("succeeded")).alias("failed_deliveries"),
    )


def all_attempts(events: DataFrame, copies: DataFrame) -> DataFrame:
    """Event deliveries and object copies as one table."""
    return events.unionByName(copies, allowMissingColumns=True)


def rejected_count(events: Column, too_new_start: Column, too_old_end: Column, expired_end: Column) -> Column:
    """Events a destination refused: from the first too-new one on, up to the last too-old and expired ones."""
    zero = F.lit(0).cast("bigint")
    return (
        F.coalesce(events - too_new_start, zero)
        + F.coalesce(too_old_end + 1, zero)
        + F.coalesce(expired_end + 1, zero)
    )


def rejection_stats(batches: DataFrame) -> DataFrame:
    """Adds rejected, successful_events and failed_events to batches with the three indexes."""
    counted = batches.withColumn(
        "rejected",
        rejected_count(F.col("events"), F.col("too_new_start"), F.col("too_old_end"), F.col("expired_end")),
    )
    return counted.withColumns(
        {
            "successful_events": F.greatest(F.lit(0), F.col("events") - F.col("rejected")),
            "failed_events": F.greatest(F.lit(0), F.col("rejected")),
        }
    )


def late_events(
    events: DataFrame,
    as_of,
    keys: Sequence[str],
    max_age_ms: int = 14 * 86_400_000,
    max_ahead_ms: int = 2 * 3_600_000,
) -> DataFrame:
    """Events a destination would refuse for their time; one refused event fails the delivery."""
    age = millis(as_of) - F.col("event_ts_ms")
    old, new = age > max_age_ms, age < -max_ahead_ms
    return events.groupBy(*keys).agg(
        F.count("*").alias("events"),
        F.count_if(old).alias("too_old"),
        F.count_if(new).alias("too_new"),
        (F.count_if(old | new) == 0).alias("delivered"),
    )


def event_stats(batches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Events per delivery: batches behind a failed one are never sent, earlier successes stay.

    ``batches`` has events, successful_events, failed_events, failed (the call itself failed). The
    first failed batch is found by an aggregate, so a delivery is never sorted as a whole.
    """
    first_failed = F.min(F.when(F.col("failed"), F.col("batch_id")))
    stop = batches.groupBy(*keys).agg(first_failed.alias("_stop"))
    joined = batches.join(stop, list(keys))
    sent = F.col("_stop").isNull() | (F.col("batch_id") < F.col("_stop"))
    at_stop = F.col("batch_id") == F.col("_stop")
    return joined.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(sent, F.col("successful_events"))), F.lit(0)).alias("successful_events"),
        F.coalesce(
            F.sum(F.when(sent, F.col("failed_events")).when(at_stop, F.col("events"))), F.lit(0)
        ).alias("failed_events"),
        # The event that triggers a send is counted after it, so a stop leaves later batches out.
        F.coalesce(F.sum(F.when(sent | at_stop, F.col("events"))), F.lit(0)).alias("total_processed"),
    )


def reported_stats(stats: DataFrame, events: str = "events") -> DataFrame:
    """What is reported for a delivery: one refused or unsent event makes all its events count as failed.

    ``events`` is the number of events the delivery set out to send.
    """
    whole = F.col("failed_events") == 0
    return stats.withColumns(
        {
            "successful_events": F.when(whole, F.col("successful_events")).otherwise(0),
            "failed_events": F.when(whole, F.lit(0)).otherwise(F.col(events)),
        }
    )


# -- metrics --------------------------------------------------------------------------------------

def _metric_rows(df: DataFrame, method: Column, values: dict[str, Column]) -> DataFrame:
    """Long metric rows; NULL values are not published."""
    entries = [F.struct(F.lit(name).alias("name"), v.cast("double").alias("value")) for name, v in values.items()]
    rows = df.select("tenant_id", "ts", method.alias("_method"), F.explode(F.array(*entries)).alias("_m"))
    return rows.filter("_m.value is not null").select(
        "ts",
        F.col("tenant_id").alias("tenant"),
        metric_name(F.col("_method"), F.col("_m.name")).alias("metric"),
        F.col("_m.value").alias("value"),
        F.lit("Count").alias("unit"),
    )


def event_delivery_metrics(stats: DataFrame) -> DataFrame:
    """Metrics of event deliveries: both event counts always, one verdict if there were events."""
    ok, bad = F.col("successful_events"), F.col("failed_events")
    return _metric_rows(
        stats,
        F.lit("cloudwatch"),
        {
            "successful_events": ok,
            "failed_events": bad,
            "successful_delivery": F.when((bad == 0) & (ok > 0), 1),
            "failed_delivery": F.when(bad > 0, 1),
        },
    )


def object_delivery_metrics(attempts: DataFrame) -> DataFrame:
    return _metric_rows(
        attempts,
        F.lit("s3"),
        {
            "successful_delivery": F.when(F.col("succeeded"), 1),
            "failed_delivery": F.when(~F.col("succeeded"), 1),
        },
    )


def latency_metrics(attempts: DataFrame) -> DataFrame:
    """Delivery minus upload time in ms, for deliveries that succeeded."""
    return _metric_rows(
        attempts.filter("succeeded"),
        F.col("type"),
        {"delivery_latency": F.col("delivered_ms") - F.col("upload_ms")},
    )


STATISTICS = {"sum": F.sum, "average": F.avg, "maximum": F.max, "minimum": F.min, "samples": F.count}


def metric_statistics(
    metrics: DataFrame,
    period: int,
    stats: Sequence[str] = ("sum", "average", "maximum"),
    start: str | None = None,
    end: str | None = None,
    keys: Sequence[str] = ("metric", "tenant"),
) -> DataFrame:
    """Statistics per period of seconds. ``start`` is inside, ``end`` outside, as timestamps."""
    chosen = metrics
    if start is not None:
        chosen = chosen.filter(F.col("ts") >= F.lit(start).cast("timestamp"))
    if end is not None:
        chosen = chosen.filter(F.col("ts") < F.lit(end).cast("timestamp"))
    grouped = chosen.groupBy(F.window("ts", f"{period} seconds"), *keys).agg(
        *[STATISTICS[s]("value").alias(s) for s in stats]
    )
    return grouped.select(F.col("window.start").alias("period_start"), *keys, *stats)


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """Events and errors per pipeline stage; an ``error`` column, where present, marks errors."""
    rows = None
    for name, df in stages.items():
        errors = F.count_if("error") if "error" in df.columns else F.lit(0).cast("bigint")
        one = df.agg(F.count("*").alias("events"), errors.alias("errors")).select(F.lit(name).alias("stage"), "*")
        rows = one if rows is None else rows.unionByName(one)
    return rows


def record_stage_counts(records: DataFrame) -> DataFrame:
    """Stage counts of lines, records and events of parsed records, in one pass over them."""
    one = records.agg(
        F.count_if(F.col("item_no") == 0).alias("lines"),
        F.count_if((F.col("item_no") == 0) & F.col("parse_error")).alias("broken"),
        F.count_if(~F.col("parse_error")).alias("records"),
        F.count_if("is_object").alias("events"),
    )
    stage = lambda name, n, bad: F.struct(F.lit(name).alias("stage"), F.col(n).alias("events"), bad.cast("bigint").alias("errors"))
    return one.select(F.inline(F.array(stage("lines", "lines", F.col("broken")), stage("records", "records", F.lit(0)), stage("events", "events", F.lit(0)))))


def dedupe_deliveries(attempts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per delivery key; redelivery repeats are dropped, the earliest attempt stays."""
    rest = [c for c in attempts.columns if c not in keys]
    row = F.struct("delivered_ms", *[c for c in rest if c != "delivered_ms"])
    return attempts.groupBy(*keys).agg(F.min(row).alias("_row")).select(*keys, "_row.*")
