"""Validity rules, error classes, sizes, delays and metric names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.constants import (
    EVENT_OVERHEAD_BYTES,
    LOG_LEVELS,
    MAX_DELAY_S,
    PERMANENT_COPY_ERRORS,
    ROLE_ARN_PREFIX,
)

NON_BLANK = r"\S"


def is_blank(text: Column) -> Column:
    return text.isNull() | ~text.rlike(NON_BLANK)


def is_empty(text: Column) -> Column:
    return text.isNull() | (text == "")


# -- config fields ------------------------------------------------------------------------------

def valid_tenant_id(value: Column) -> Column:
    return F.coalesce(
        F.length(value).between(1, 128) & value.rlike(r"^(?=.*[\p{L}\p{N}])[\p{L}\p{N}_-]+\z"), F.lit(False)
    )


def valid_role_arn(value: Column) -> Column:
    return value.startswith(ROLE_ARN_PREFIX)


def valid_bucket(value: Column) -> Column:
    return value.rlike(r"^(?=.*[\p{L}\p{N}])[\p{L}\p{N}.-]+\z")


def valid_region(value: Column, allow_underscore: bool = False) -> Column:
    extra = "_" if allow_underscore else ""
    return value.rlike(rf"^(?=.*[\p{{L}}\p{{N}}])[\p{{L}}\p{{N}}{extra}-]+\z")


def valid_desired_logs(value: Column) -> Column:
    """NULL means all applications; items must be non-blank."""
    return F.coalesce(F.forall(value, lambda item: F.coalesce(item.rlike(NON_BLANK), F.lit(False))), F.lit(True))


REQUIRED_FIELDS = {
    "cloudwatch": ("log_distribution_role_arn", "log_group_name"),
    "s3": ("bucket_name",),
}


def missing_required(kind: Column, fields: dict[str, Column], blank_counts: bool = True) -> Column:
    """Names of required fields a config lacks. Delivery also refuses blanks, the API only empty text."""
    lacks = is_blank if blank_counts else is_empty
    names = [
        F.when((kind == t) & lacks(fields[name]), F.lit(name)) for t, req in REQUIRED_FIELDS.items() for name in req
    ]
    return F.array_compact(F.array(*names))


def application_enabled(desired: Column, application: Column) -> Column:
    """NULL, empty or one empty name selects all applications; otherwise exact membership."""
    everything = desired.isNull() | (F.size(desired) == 0) | (desired == F.array(F.lit("")))
    return everything | F.coalesce(F.array_contains(desired, application), F.lit(False))


# -- errors, queue --------------------------------------------------------------------------------

def copy_error_class(message: Column) -> Column:
    permanent = F.lit(False)
    for word in PERMANENT_COPY_ERRORS:
        permanent = permanent | message.contains(word)
    return F.when(message.isNull(), F.lit(None)).when(permanent, "non_recoverable").otherwise("recoverable")


def retry_delay_s(retry_count: Column) -> Column:
    return F.least(F.pow(F.lit(2.0), retry_count + 1), F.lit(float(MAX_DELAY_S))).cast("int")


# -- events, metrics ------------------------------------------------------------------------------

def event_size(message: Column) -> Column:
    return (F.octet_length(message) + EVENT_OVERHEAD_BYTES).cast("bigint")


def metric_name(method: Column, metric: Column) -> Column:
    return F.concat_ws("/", F.lit("LogCount"), method, metric)


def log_level(message: Column) -> Column:
    found = F.regexp_extract(message, f"({'|'.join(LOG_LEVELS)})", 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.lit("INFO"))


def preview(text: Column, n: int) -> Column:
    """First n bytes with an ellipsis, or the text itself when it is short enough.

    A character cut in half shows as the replacement character.
    """
    cut = F.make_valid_utf8(F.substring(F.encode(text, "UTF-8"), 1, n).cast("string"))
    return F.when(F.octet_length(text) <= n, text).otherwise(F.concat(cut, F.lit("...")))
