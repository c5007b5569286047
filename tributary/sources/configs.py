"""Delivery-config tables in plain and in tagged-attribute form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.schemas import CONFIG_KEY, DELIVERY_CONFIG, TAGGED_VALUE

TEXT_FIELDS = (
    "tenant_id",
    "type",
    "target_region",
    "log_distribution_role_arn",
    "log_group_name",
    "bucket_name",
    "bucket_prefix",
)
LIST_FIELDS = ("desired_logs", "groups")
TAGGED_ITEM = T.StructType(
    [T.StructField(f, TAGGED_VALUE) for f in (*TEXT_FIELDS, *LIST_FIELDS, "enabled", "ttl")]
)


def read_tenant_configs(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(DELIVERY_CONFIG).format(fmt).load(path)


def _list(value: Column) -> Column:
    return F.coalesce(F.transform(value["L"], lambda item: item["S"]), value["SS"])


def decode_items(items: DataFrame, item: str = "item") -> DataFrame:
    """Tagged attribute values -> plain config columns; lists may be L or SS."""
    it = F.col(item)
    return items.select(
        *[it[f]["S"].alias(f) for f in CONFIG_KEY],
        it["enabled"]["BOOL"].alias("enabled"),
        *[_list(it[f]).alias(f) for f in LIST_FIELDS],
        *[it[f]["S"].alias(f) for f in TEXT_FIELDS if f not in CONFIG_KEY],
        it["ttl"]["N"].try_cast("bigint").alias("ttl"),
    )
