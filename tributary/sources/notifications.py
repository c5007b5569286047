"""Queue messages: JSON envelope -> JSON notification -> one row per object."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.keys import unescape_key
from tributary.functions.records import settle, trimmed, with_json_object
from tributary.functions.timestamps import rfc3339_time
from tributary.schemas import NOTIFICATION

NON_RECOVERABLE = "non_recoverable"
RECOVERABLE = "recoverable"


def _text_member(parsed: Column, *spellings: str) -> Column:
    """String field under the first spelling present; any other type is NULL."""
    value = F.coalesce(*[F.try_variant_get(parsed, f"$.{s}", "variant") for s in spellings])
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def _number(meta: Column, name: str) -> Column:
    """Whole number of a metadata field: absent or null is 0, any other type is NULL."""
    value = F.try_variant_get(meta, f"$.{name}", "variant")
    kind = F.schema_of_variant(value)
    return (
        F.when(value.isNull() | (kind == "VOID"), F.lit(0).cast("bigint"))
        .when(kind == "BIGINT", F.try_variant_get(value, "$", "bigint"))
    )


def with_processing_metadata(msgs: DataFrame, body: str = "body") -> DataFrame:
    """Adds offset, retry_count, original_receipt_handle and metadata_error.

    No metadata gives zeros; metadata of the wrong shape is an error worth a retry.
    """
    return _opened(msgs, body).drop("_body")


def _opened(msgs: DataFrame, body: str) -> DataFrame:
    """The message columns, those of with_processing_metadata, and the parsed body."""
    parsed = with_json_object(msgs, trimmed(F.col(body)), "_body").withColumn(
        "_meta", F.try_variant_get("_body", "$.processing_metadata", "variant")
    )
    kind = F.schema_of_variant(F.col("_meta"))
    absent = F.col("_meta").isNull() | (kind == "VOID")
    offset, retries = _number(F.col("_meta"), "offset"), _number(F.col("_meta"), "retry_count")
    handle = F.try_variant_get("_meta", "$.original_receipt_handle", "string")
    requeued = F.try_variant_get("_meta", "$.requeued_at", "string")
    bad_stamp = requeued.isNotNull() & rfc3339_time(requeued).isNull()
    broken = ~absent & (~kind.startswith("OBJECT") | offset.isNull() | retries.isNull() | bad_stamp)
    plain = absent | broken
    zero = F.lit(0).cast("bigint")
    found = {
        "offset": F.when(plain, zero).otherwise(offset),
        "retry_count": F.when(plain, zero).otherwise(retries),
        "original_receipt_handle": F.when(plain, F.lit("")).otherwise(F.coalesce(handle, F.lit(""))),
        "metadata_error": F.col("_body").isNotNull() & broken,
    }
    return settle(parsed, found).select(*msgs.columns, *found, "_body")


def parse_notifications(msgs: DataFrame, body: str = "body") -> DataFrame:
    """One row per record: message columns, record_idx, bucket, object_key, error_class, error_code.

    A broken envelope or notification condemns the whole message (one row, no key). Records are taken in order: at
    the first broken key escape there is an error row with its index, those before it stay, and those behind it are not
    looked at. Missing records leave one row with neither key nor error: the message succeeded with no work.
    """
    noted = _opened(msgs, body).withColumn("_text", _text_member(F.col("_body"), "Message", "message"))
    inner = with_json_object(noted, trimmed(F.col("_text")), "_inner")
    listed = inner.withColumn("_records", F.from_json(F.to_json("_inner"), NOTIFICATION, {"mode": "PERMISSIVE"})["Records"])
    code = (
        F.when(F.col("_body").isNull(), F.lit("invalid_envelope"))
        .when(F.col("_inner").isNull(), F.lit("invalid_notification"))
        .when(F.col("metadata_error"), F.lit("invalid_metadata"))
    )
    # All outcomes become items of one array. What comes out of the explode cannot be pushed below
    # it, so a later filter on the error or the key never repeats the parse.
    def row(idx: Column, bucket: Column, key: Column, problem: Column) -> Column:
        return F.struct(
            idx.cast("int").alias("record_idx"), bucket.alias("bucket"), key.alias("object_key"), problem.alias("error_code")
        )

    none = F.lit(None).cast("string")
    found = F.transform(
        "_records",
        lambda r, i: row(
            i,
            F.coalesce(r["s3"]["bucket"]["name"], F.lit("")),
            unescape_key(F.coalesce(r["s3"]["object"]["key"], F.lit(""))),
            none,
        ),
    )
    broken_at = F.array_position(F.transform("_found", lambda r: r["object_key"].isNull()), True).cast("int")
    in_order = F.when(broken_at == 0, F.col("_found")).otherwise(
        F.concat(F.slice("_found", F.lit(1), broken_at - 1), F.array(row(broken_at - 1, none, none, F.lit("invalid_escape"))))
    )
    items = (
        F.when(F.col("_code").isNotNull(), F.array(row(F.lit(None), none, none, F.col("_code"))))
        .when(F.size("_records") > 0, in_order)
        .otherwise(F.array(row(F.lit(None), none, none, none)))
    )
    rows = listed.withColumn("_code", code).withColumn("_found", found).select("*", F.explode_outer(items).alias("_r"))
    carried = [c for c in msgs.columns if c != body]
    return rows.select(
        *carried,
        "offset",
        "retry_count",
        "_r.record_idx",
        "_r.bucket",
        "_r.object_key",
        F.when(F.col("_r.error_code") == "invalid_metadata", RECOVERABLE)
        .when(F.col("_r.error_code").isNotNull(), NON_RECOVERABLE)
        .alias("error_class"),
        "_r.error_code",
    )


def manual_messages(bodies: DataFrame) -> DataFrame:
    """Hand-fed message bodies (column ``body``), all as message ``manual-input``."""
    named = bodies.select(F.lit("manual-input").alias("message_id"), "body", F.lit("manual").alias("receipt_handle"))
    return parse_notifications(named)


def process_bodies(spark: SparkSession, bodies: Sequence[str]) -> DataFrame:
    return manual_messages(spark.createDataFrame([(b,) for b in bodies], "body string"))
