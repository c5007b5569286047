"""Log lines -> records -> events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.constants import DELIVERY_TYPES
from tributary.functions.records import (
    elements,
    is_object,
    json_text,
    message_text,
    sole_item,
    trimmed,
    without_metadata,
    wrapped_value,
)
from tributary.functions.rules import NON_BLANK
from tributary.functions.timestamps import delivery_ts_ms, effective_ts_ms
from tributary.operators.ordering import row_rank
from tributary.sources.objects import read_whole_objects

PLACE = ("object_key", "line_no", "item_no")


def drop_blank(lines: DataFrame, line: str = "line") -> DataFrame:
    return lines.filter(F.col(line).rlike(NON_BLANK))


def parse_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """One row per record: item_no, record (variant), is_object and parse_error.

    A line that is no JSON keeps one row with ``parse_error``. Array items become records of their
    own; an empty array leaves one row without a record so that the line still counts as read.
    """
    text = drop_blank(lines, line).withColumn("_text", trimmed(F.col(line)))
    parsed = text.withColumn("_w", wrapped_value(F.col("_text"))).withColumn("_v", sole_item(F.col("_w")))
    exploded = parsed.select(
        *lines.columns,
        F.substring("_text", 1, 1).alias("_first"),
        F.col("_v").isNull().alias("parse_error"),
        F.posexplode_outer(elements(F.col("_text"), F.col("_v"))).alias("item_no", "record"),
    )
    # Only array items need a look at their type; a single value shows it in its first character.
    # Both tests read the exploded record, so a filter on the result never pulls the parse below it.
    shape = F.when(F.col("_first") == "[", is_object(F.col("record"))).otherwise(
        (F.col("_first") == "{") & F.col("record").isNotNull()
    )
    return exploded.select(
        *lines.columns,
        "parse_error",
        F.coalesce("item_no", F.lit(0)).alias("item_no"),
        "record",
        shape.alias("is_object"),
    )


def to_log_events(records: DataFrame, as_of, keep: Sequence[str] = ()) -> DataFrame:
    """Records -> (object_key, line_no, item_no, event_ts_ms, message); non-objects are dropped.

    ``keep`` names further columns to carry along.
    """
    fields = records.filter("is_object").select(
        *PLACE,
        *keep,
        "record",
        F.try_variant_get("record", "$.timestamp", "variant").alias("_ts"),
        F.try_variant_get("record", "$.message", "variant").alias("_message"),
    )
    whole = json_text(without_metadata(F.col("record")))
    message = F.when(F.col("_message").isNotNull(), message_text(F.col("_message"))).otherwise(whole)
    return fields.select(
        *PLACE, *keep, delivery_ts_ms(F.col("_ts"), as_of).alias("event_ts_ms"), message.alias("message")
    )


def parse_stats(records: DataFrame) -> DataFrame:
    """Lines read, lines in error and events per object."""
    first_item = F.col("item_no") == 0
    return records.groupBy("object_key").agg(
        F.count_if(first_item & ~F.col("parse_error")).alias("lines_ok"),
        F.count_if(F.col("parse_error")).alias("lines_error"),
        F.count_if("is_object").alias("events"),
    )


def fallback_keys(stats: DataFrame) -> DataFrame:
    """Objects without events but with bad lines: only these are read again as one JSON value."""
    return stats.filter("events = 0 and lines_error > 0").select("object_key")


def parse_whole_objects(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """Records of whole files: an array of records or one pretty-printed record.

    A file that is no JSON value keeps one row with ``parse_error``: a recoverable failure. So does one that
    cannot be read, with an error_code.
    """
    files = read_whole_objects(spark, path, keys).withColumn("line_no", F.lit(0).cast("bigint"))
    # Unreadable files pass the parser as a text that is no JSON.
    shown = files.withColumn("content", F.coalesce("content", F.lit("unreadable")))
    return parse_lines(shown, "content").drop("content")


def whole_from_lines(lines: DataFrame, keys: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(object_key, line_no, content): the lines of the named objects put together again.

    Used where the lines are at hand already. One row per object, as one JSON value must be.
    """
    wanted = lines.join(keys, "object_key", "left_semi")
    pieces = F.sort_array(F.collect_list(F.struct("line_no", "line")))
    joined = F.array_join(F.transform(pieces, lambda p: p["line"]), "\n")
    return wanted.groupBy("object_key", *keep).agg(F.lit(0).cast("bigint").alias("line_no"), joined.alias("content"))


def object_events(
    lines: DataFrame, as_of, records: DataFrame | None = None, keep: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Events of all objects with the whole-file fallback, and the objects that could not be read.

    The records are read more than once; a caller that has them written or checkpointed passes them.
    ``keep`` names columns, constant per object, to carry along.
    """
    if records is None:
        records = parse_lines(lines)
    whole = whole_from_lines(lines, fallback_keys(parse_stats(records)), keep)
    again = parse_lines(whole, "content").drop("content")
    events = to_log_events(records, as_of, keep).unionByName(to_log_events(again, as_of, keep))
    failed = again.filter("parse_error").select("object_key", *keep, F.lit("recoverable").alias("error_class"))
    return events, failed


def fallback_ts(events: DataFrame, upload_ms: str = "upload_ms") -> DataFrame:
    """Replaces ``event_ts_ms`` by the time sent to the destination."""
    return events.withColumn("event_ts_ms", effective_ts_ms(F.col("event_ts_ms"), F.col(upload_ms)))


def skip_processed(events: DataFrame, offsets: DataFrame, chunks: int | None = None) -> DataFrame:
    """Drops the first ``offset`` events of an object, in file order.

    Only objects with a positive offset are numbered; all others pass without a shuffle of their own. Both branches are semi and anti joins on
    the key, which the optimizer moves below the parse: each line is parsed in one of them.
    """
    positive = offsets.filter("offset > 0").groupBy("object_key").agg(F.max("offset").alias("offset"))
    keys = positive.select("object_key")
    untouched = events.join(keys, "object_key", "left_anti")
    cut = events.join(keys, "object_key", "left_semi")
    numbered = row_rank(cut, ["object_key"], ["line_no", "item_no"], "_rank", chunks, costly=True).join(positive, "object_key")
    return untouched.unionByName(numbered.filter("_rank > offset").select(*events.columns))


def order_events(events: DataFrame, keys, chunks: int | None = None) -> DataFrame:
    """Adds ``seq``: chronological position per destination; ties follow the file position."""
    return row_rank(events, keys, ["event_ts_ms", *PLACE], "seq", chunks, costly=True)


def known_types(df: DataFrame, kind: str = "type") -> DataFrame:
    return df.filter(F.col(kind).isin(*DELIVERY_TYPES))
