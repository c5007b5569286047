"""The message table: retries, visibility, dead letters. Columns: message_id, body, receipt_handle,
receive_count, sent_ms, visible_ms (times in epoch ms)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.constants import MAX_RECEIVE_COUNT, MAX_RETRIES, MESSAGE_RETENTION_S, VISIBILITY_TIMEOUT_S
from tributary.functions.records import settle, trimmed, with_json_object
from tributary.functions.rules import retry_delay_s
from tributary.functions.timestamps import millis


def _utc_stamp(as_of):
    return F.concat(
        F.date_format(F.timestamp_millis(millis(as_of)), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")
    )


def event_failures(attempts: DataFrame) -> DataFrame:
    """Failed event deliveries, the only ones that go back to the queue; failed copies are just counted."""
    return attempts.filter((F.col("type") == "cloudwatch") & ~F.col("succeeded"))


def requeue(failures: DataFrame, as_of, max_retries: int = MAX_RETRIES) -> DataFrame:
    """Failed event deliveries go back with their offset, one more retry and a growing delay.

    Input: message_id, body, receipt_handle, offset, retry_count. Messages whose new count is above
    the limit, or that came without a receipt handle, are dropped. The offset is kept as it came.
    Output: message_id, body, offset, retry_count, delay_s, visible_ms.
    """
    eligible = failures.filter(
        (F.coalesce(F.col("receipt_handle"), F.lit("")) != "") & (F.col("retry_count") + 1 <= max_retries)
    )
    opened = with_json_object(eligible, trimmed(F.col("body")), "_v")
    parsed = settle(opened, {"_body": F.col("_v").cast("map<string,variant>")}).filter("_body is not null")
    old = F.try_element_at(F.col("_body"), F.lit("processing_metadata"))
    kept_meta = F.when(F.schema_of_variant(old).startswith("OBJECT"), old.cast("map<string,variant>"))
    written = {
        "offset": F.to_variant_object(F.array(F.col("offset"))),
        "retry_count": F.to_variant_object(F.array(F.col("retry_count") + 1)),
        "original_receipt_handle": F.to_variant_object(F.array(F.col("receipt_handle"))),
        "requeued_at": F.to_variant_object(F.array(_utc_stamp(as_of))),
    }
    fresh = F.create_map(
        *[c for name, v in written.items() for c in (F.lit(name), F.try_variant_get(v, "$[0]", "variant"))]
    )
    rest = F.map_filter(F.coalesce(kept_meta, F.create_map().cast("map<string,variant>")), lambda k, _: ~k.isin(*written))
    meta = F.map_concat(rest, fresh)
    others = F.map_filter("_body", lambda k, _: k != "processing_metadata")
    body = F.map_concat(others, F.create_map(F.lit("processing_metadata"), F.to_variant_object(meta)))
    delay = retry_delay_s(F.col("retry_count"))
    return parsed.select(
        "message_id",
        F.to_json(F.to_variant_object(body)).alias("body"),
        "offset",
        (F.col("retry_count") + 1).alias("retry_count"),
        delay.alias("delay_s"),
        (millis(as_of) + delay.cast("bigint") * 1000).alias("visible_ms"),
    )


def visible_messages(msgs: DataFrame, as_of) -> DataFrame:
    return msgs.filter(F.col("visible_ms") <= millis(as_of))


def receive(msgs: DataFrame, as_of, visibility_s: int = VISIBILITY_TIMEOUT_S) -> DataFrame:
    """Visible messages, counted as received and hidden for the visibility time."""
    return visible_messages(msgs, as_of).withColumns(
        {
            "receive_count": F.col("receive_count") + 1,
            "visible_ms": millis(as_of) + F.lit(visibility_s * 1000),
        }
    )


def queue_state(as_of, max_receive: int = MAX_RECEIVE_COUNT, retention_s: int = MESSAGE_RETENTION_S):
    """expired / dead_letter / visible / delayed / in_flight, in this order of precedence."""
    now = millis(as_of)
    shown = F.col("visible_ms") <= now
    return (
        F.when(F.col("sent_ms") <= now - F.lit(retention_s * 1000), "expired")
        .when(shown & (F.col("receive_count") >= max_receive), "dead_letter")
        .when(shown, "visible")
        .when(F.col("receive_count") == 0, "delayed")
        .otherwise("in_flight")
    )


def split_dead_letters(
    msgs: DataFrame, as_of, max_receive: int = MAX_RECEIVE_COUNT, retention_s: int = MESSAGE_RETENTION_S
) -> tuple[DataFrame, DataFrame]:
    """Messages that stay, and messages for the dead-letter table; expired ones are in neither."""
    judged = msgs.withColumn("_state", queue_state(as_of, max_receive, retention_s))
    live = judged.filter(~F.col("_state").isin("expired", "dead_letter")).drop("_state")
    return live, judged.filter("_state = 'dead_letter'").drop("_state")


def queue_depth(msgs: DataFrame, as_of) -> DataFrame:
    """One row: visible, delayed, in flight, dead-lettered."""
    state = queue_state(as_of)
    return msgs.withColumn("_state", state).agg(
        *[F.count_if(F.col("_state") == s).alias(s) for s in ("visible", "delayed", "in_flight", "dead_letter")]
    )
