"""Finding the event time. Every function is total: what cannot be read leaves the prior value.

``as_of`` is epoch milliseconds, a number or a column, so that reruns give the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.constants import EPOCH_MS_BOUNDARY
from tributary.functions.records import wrapped_object

# Fixed patterns of the log formats.
RFC3339 = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}([.,]\d+)?(Z|[+-]\d{2}:\d{2})\z"
ISO = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})?\z"
ISO_START = r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d{3,6})?Z?)"
TIME_FIELD = r'time="([^"]+)"'
KLOG_LINE = r"(?s)^[IWEF](\d{2})(\d{2})\s+(\d{2}:\d{2}:\d{2})\.(\d{3})\d{3}.*$"
GO_LINE = r"(?s)^(\d{4})/(\d{2})/(\d{2})\s+(\d{2}:\d{2}:\d{2}).*$"
JSON_TIME_KEYS = ("ts", "time", "stageTimestamp", "requestReceivedTimestamp")

# Seconds of years 0001 to 9999, the range a timestamp column holds.
MIN_EPOCH_S, MAX_EPOCH_S = -62_135_596_800, 253_402_300_799


def millis(value) -> Column:
    return value if isinstance(value, Column) else F.lit(int(value)).cast("bigint")


def year_of(as_of) -> Column:
    """UTC year of an epoch-ms value, whatever the session zone is."""
    days = F.floor(millis(as_of) / 86_400_000).cast("int")
    return F.year(F.date_add(F.lit("1970-01-01").cast("date"), days))


def rfc3339_time(text: Column) -> Column:
    """Strict RFC3339 with a zone; a comma may stand for the fraction point."""
    return F.when(text.rlike(RFC3339), F.replace(text, F.lit(","), F.lit("."))).try_cast("timestamp")


def zoned(text: Column, assume_utc: bool = True) -> Column:
    """ISO text with its zone; a missing zone is UTC, or NULL if ``assume_utc`` is off."""
    has_zone = text.endswith("Z") | F.substring(text, -6, 1).isin("+", "-")
    return F.when(has_zone, text).otherwise(F.concat(text, F.lit("Z")) if assume_utc else F.lit(None).cast("string"))


def iso_time(text: Column, assume_utc: bool = True) -> Column:
    """Collector reading of an ISO time."""
    return F.when(text.rlike(ISO), zoned(text, assume_utc)).try_cast("timestamp")


def variant_kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def is_number(kind: Column) -> Column:
    return kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")


def delivery_ts_ms(value: Column, as_of) -> Column:
    """Delivery time of a record's ``timestamp`` (a variant; NULL when absent) in ms.

    Numbers above the boundary are ms already, the boundary itself still counts as seconds.
    """
    kind = variant_kind(value)
    text = F.try_variant_get(value, "$", "string")
    number = F.try_variant_get(value, "$", "double")
    scaled = F.when(number > EPOCH_MS_BOUNDARY, number).otherwise(number * 1000)
    return F.coalesce(
        F.when(kind == "STRING", F.unix_millis(rfc3339_time(text))).when(is_number(kind), scaled.try_cast("bigint")),
        millis(as_of),
    )


def effective_ts_ms(event_ts_ms: Column, upload_ms: Column) -> Column:
    """Time sent to the destination: upload time for a missing or zero event time.

    The value then passes the seconds-or-milliseconds rule a second time, as published, so times
    before September 2001 are scaled up again.
    """
    chosen = F.coalesce(F.nullif(event_ts_ms, F.lit(0).cast("bigint")), upload_ms)
    return F.when(chosen > int(EPOCH_MS_BOUNDARY), chosen).otherwise(F.try_multiply(chosen, F.lit(1000).cast("bigint")))


def _epoch_time(number: Column) -> Column:
    """Epoch seconds or ms (from the boundary on), cut to whole seconds."""
    seconds = F.when(number < EPOCH_MS_BOUNDARY, number).otherwise(number / 1000)
    inside = seconds.between(MIN_EPOCH_S, MAX_EPOCH_S)
    return F.timestamp_seconds(F.when(inside, seconds).try_cast("bigint"))


# The next functions add columns step by step. An expression used twice inside a CASE is evaluated
# twice, a column only once, and short expressions keep the generated code small enough to compile.

def with_json_event_time(df: DataFrame, message: str, out: str, assume_utc: bool = True) -> DataFrame:
    """Replaces ``out`` by the event time inside messages that are one JSON object.

    The first time key that exists decides alone, a JSON null included. ISO text counts under every
    key; epoch numbers, also written as text, count under ``ts`` only.
    """
    wrapped = F.col("_json")
    found = [F.try_variant_get(wrapped, f"$[0].{key}", "variant") for key in JSON_TIME_KEYS]
    alone = F.try_variant_get(wrapped, "$[1]", "variant").isNull()
    kind, text = F.col("_kind"), F.col("_text")
    epoch_text = F.col("_is_ts") & (is_number(kind) | ((kind == "STRING") & ~text.rlike(ISO)))
    iso = iso_time(F.when(kind == "STRING", text), assume_utc)
    return (
        df.withColumn("_json", wrapped_object(F.col(message)))
        .withColumns({"_time": F.when(alone, F.coalesce(*found)), "_is_ts": found[0].isNotNull()})
        .withColumns({"_kind": variant_kind(F.col("_time")), "_text": F.try_variant_get("_time", "$", "string")})
        .withColumn("_number", F.when(epoch_text, text).try_cast("double"))
        .withColumn(out, F.coalesce(iso, _epoch_time(F.col("_number")), F.col(out)))
        .drop("_json", "_time", "_is_ts", "_kind", "_text", "_number")
    )


def with_text_event_time(df: DataFrame, message: str, out: str, as_of, assume_utc: bool = True) -> DataFrame:
    """Replaces ``out`` by the event time written in plain-text lines.

    A leading ISO time decides alone. Otherwise a leading klog time, or where the line is no klog
    line a leading Go time, wins over ``time="..."``; each falls back to the next when unreadable.
    The first characters choose the pattern, so most lines meet one regular expression at most.
    """
    line = F.col(message)
    fifth = F.substring(line, 5, 1)
    iso = F.when(fifth == "-", F.nullif(F.regexp_extract(line, ISO_START, 1), F.lit("")))
    year = F.lpad(year_of(as_of).cast("string"), 4, "0")
    klog = F.regexp_replace(line, F.lit(KLOG_LINE), F.concat(year, F.lit("-$1-$2T$3.$4Z")))
    # A line without the pattern stays as it is, and no such line reads as a time.
    leading = F.when(F.substring(line, 1, 1).isin("I", "W", "E", "F"), klog).when(
        fifth == "/", F.regexp_replace(line, GO_LINE, "$1-$2-$3T$4Z")
    )
    field = F.when(line.contains('time="'), F.regexp_extract(line, TIME_FIELD, 1))
    iso_found = F.col("_iso").isNotNull()
    other = F.when(~iso_found, F.coalesce(F.col("_leading").try_cast("timestamp"), iso_time(F.col("_field"), assume_utc)))
    return (
        df.withColumns({"_iso": iso, "_leading": leading, "_field": field})
        .withColumn(out, F.coalesce(zoned(F.col("_iso"), assume_utc).try_cast("timestamp"), other, F.col(out)))
        .drop("_iso", "_leading", "_field")
    )
