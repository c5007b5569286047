"""Explicit schemas of the tables that cross the library's border."""

from pyspark.sql import types as T

STRINGS = T.ArrayType(T.StringType())

DELIVERY_CONFIG = T.StructType(
    [
        T.StructField("tenant_id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("enabled", T.BooleanType()),
        T.StructField("desired_logs", STRINGS),
        T.StructField("groups", STRINGS),
        T.StructField("target_region", T.StringType()),
        T.StructField("log_distribution_role_arn", T.StringType()),
        T.StructField("log_group_name", T.StringType()),
        T.StructField("bucket_name", T.StringType()),
        T.StructField("bucket_prefix", T.StringType()),
        T.StructField("ttl", T.LongType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

CONFIG_KEY = ("tenant_id", "type")
CONFIG_FIELDS = tuple(f.name for f in DELIVERY_CONFIG if f.name not in CONFIG_KEY)
# What a change request may set; the stamps are written by the operators.
CHANGEABLE_FIELDS = tuple(f for f in CONFIG_FIELDS if f not in ("created_at", "updated_at"))
PATCH_FIELDS = ("enabled", "desired_logs")

TAGGED_VALUE = T.StructType(
    [
        T.StructField("S", T.StringType()),
        T.StructField("BOOL", T.BooleanType()),
        T.StructField("N", T.StringType()),
        T.StructField("L", T.ArrayType(T.StructType([T.StructField("S", T.StringType())]))),
        T.StructField("SS", STRINGS),
    ]
)

NOTIFICATION = T.StructType(
    [
        T.StructField(
            "Records",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField(
                            "s3",
                            T.StructType(
                                [
                                    T.StructField("bucket", T.StructType([T.StructField("name", T.StringType())])),
                                    T.StructField("object", T.StructType([T.StructField("key", T.StringType())])),
                                ]
                            ),
                        )
                    ]
                )
            ),
        )
    ]
)

POD_LOG = T.StructType(
    [
        T.StructField("message", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField(
            "kubernetes",
            T.StructType(
                [
                    T.StructField("pod_namespace", T.StringType()),
                    T.StructField("pod_name", T.StringType()),
                    T.StructField("pod_labels", T.MapType(T.StringType(), T.StringType())),
                    T.StructField("ns_labels", T.MapType(T.StringType(), T.StringType())),
                ]
            ),
        ),
    ]
)
