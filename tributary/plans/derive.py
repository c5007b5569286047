"""Log tables as pure projections of the given tables, so every query grows with them.

events -> pod log lines, stored records, listings, messages; customer -> tenant configs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.sources.objects import spread

AS_OF_MS = 1_706_659_200_000  # 2024-01-31T00:00:00Z
BUCKET = "central-logs"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cases(key: Column, choices: dict, default=None) -> Column:
    """CASE key WHEN .. THEN .. with plain values or columns."""
    items = list(choices.items())
    first = F.when(key == items[0][0], items[0][1])
    return reduce(lambda acc, kv: acc.when(key == kv[0], kv[1]), items[1:], first).otherwise(default)


def text(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


# Milliseconds and seconds since 1970 of a zone-less time, whatever the session zone is.
EPOCH_MS = "timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', ts)"
EPOCH_S = "timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', ts)"

MESSAGE = """CASE
    WHEN event_id % 53 = 0 THEN concat('plain message ', event_id)
    WHEN event_id % 59 = 0 THEN concat('{"ts": "oops ', event_id)
    WHEN event_id % 8 = 0 THEN concat('{"ts":"', iso, 'Z","level":"info","msg":"m', event_id, '"}')
    WHEN event_id % 8 = 1 THEN concat('{"ts":', ts_s, ',"level":"info"}')
    WHEN event_id % 8 = 2 THEN concat('{"ts":', ts_ms, ',"level":"warn"}')
    WHEN event_id % 8 = 3 THEN concat('{"time":"', iso, 'Z","message":"m', event_id, '"}')
    WHEN event_id % 8 = 4 THEN concat(iso, 'Z direct ', event_id)
    WHEN event_id % 8 = 5 THEN concat('time="', iso, 'Z" level=info msg="m', event_id, '"')
    WHEN event_id % 8 = 6 THEN concat('I', date_format(ts, 'MMdd HH:mm:ss.SSSSSS'), ' 1 controller.go:231] m', event_id)
    ELSE concat(date_format(ts, 'yyyy/MM/dd HH:mm:ss'), ' m', event_id) END"""
CLUSTER = "concat(elt(user_id % 4 + 1, 'prod', 'stg', 'dev', 'lab'), '-mc-', user_id % 3)"
APPLICATION = """CASE event_type WHEN 'signup' THEN 'oauth-server' WHEN 'purchase' THEN 'kube-apiserver'
    WHEN 'error' THEN 'kube-scheduler' WHEN 'click' THEN 'openshift-apiserver' ELSE 'kube-controller-manager' END"""
FILE_NAME = "concat(date_format(ts, 'yyyyMM'), '-', event_id % 2, if(event_id % 103 = 0, '.json', '.json.gz'))"


def raw_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pod log line per event, in nine message formats, with the object it is stored in."""
    ev = spread(table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value"))
    timed = ev.selectExpr(
        "*",
        f"{EPOCH_MS} AS ts_ms",
        f"{EPOCH_S} AS ts_s",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS\") AS iso",
        f"{CLUSTER} AS cluster_id",
        "if(event_id % 101 = 0, '', concat('tenant-', user_id)) AS namespace",
        f"{APPLICATION} AS application",
    )
    named = timed.selectExpr(
        "event_id",
        "user_id",
        "value",
        "ts_ms",
        "ts_s",
        "iso",
        "cluster_id",
        "namespace",
        "application",
        "concat(application, '-', user_id % 5) AS pod_name",
        f"{FILE_NAME} AS file_name",
        "ts_ms + 45000 AS ingest_ms",
        "event_id AS line_no",
        f"{MESSAGE} AS message",
    )
    return named.selectExpr("*", "concat_ws('/', cluster_id, namespace, application, pod_name, file_name) AS object_key")


def pod_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collector input: nested pod metadata with some of it missing."""
    raw = raw_logs(spark, sf_dir)
    eid = F.col("event_id")
    labels = F.create_map(
        F.lit("hosted"), F.when(F.col("user_id") % 3 == 0, "false").otherwise("true")
    )
    pod_labels = F.when(eid % 37 == 0, F.create_map(F.lit("tier"), F.lit("x"))).otherwise(
        F.create_map(F.lit("app"), F.col("application"))
    )
    return raw.select(
        "event_id",
        "message",
        F.when(eid % 41 != 0, F.timestamp_millis("ingest_ms")).alias("timestamp"),
        F.struct(
            F.when(eid % 43 != 0, F.col("namespace")).alias("pod_namespace"),
            F.when(eid % 47 != 0, F.col("pod_name")).alias("pod_name"),
            pod_labels.alias("pod_labels"),
            labels.alias("ns_labels"),
        ).alias("kubernetes"),
        F.when(eid % 31 != 0, F.col("cluster_id")).alias("cluster"),
    )


# Numbers in forms the published encoder rewrites, and separators it escapes.
NUMBERS = '{"a":[1e3,-1e-7,1e21,2.50,0.000001,123456789.125,12345678901234567890],"b 1.50":"1.50\u2028\u2029"}'


def stored_lines(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """(object_key, line_no, line): stored NDJSON, with arrays, scalars, blanks and broken lines."""
    raw = raw_logs(spark, sf_dir)
    eid = F.col("event_id")
    ident, iso = eid.cast("string"), F.col("iso")
    sec, ms = F.col("ts_s").cast("string"), F.col("ts_ms").cast("string")
    usual = text('{"cluster_id":"', F.col("cluster_id"), '","message":"m', ident, ' é<>","timestamp":"', iso, 'Z"}')
    line = cases(
        eid % 20,
        {
            0: text('{"timestamp":"', iso, 'Z","level":"a<b","k":', ident, ',"cluster_id":"c","kubernetes":{"a":1}}'),
            1: text('[{"message":"a', ident, '","timestamp":', sec, '},{"message":{"id":', ident, '},"timestamp":', ms, "},5]"),
            2: text('"just text ', ident, '"'),
            3: text('{"message": "x', ident),
            4: text("   "),
            5: text('{"message":"z', ident, '","timestamp":0}'),
            6: text('{"message":"n', ident, '"}'),
            7: text('{"message":"b', ident, '","timestamp":"', F.when(eid % 40 == 7, "bad").otherwise(F.concat(iso, F.lit("Z\\n"))), '"}'),
            8: text('{"message":null,"timestamp":"', iso, 'Z"}'),
            9: text('{"message":', F.when(eid % 40 == 9, '[1,"two"]').otherwise(NUMBERS), ',"timestamp":', sec, ".5}"),
        },
        usual,
    )
    return raw.select("object_key", "line_no", line.alias("line"), *[F.expr(m) for m in more])


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored objects: bucket, object_key, size_bytes, modified_ms and the lowest event id (eid)."""
    return (
        raw_logs(spark, sf_dir)
        .groupBy("object_key")
        .agg(
            F.sum(F.octet_length("message")).alias("size_bytes"),
            F.max("ingest_ms").alias("modified_ms"),
            F.min("event_id").alias("eid"),
        )
        .withColumn("bucket", F.lit(BUCKET))
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One queue message per object: good ones, broken ones, some with retry metadata."""
    objects = listing(spark, sf_dir)
    eid, key = F.col("eid"), F.col("object_key")

    def record(k) -> Column:
        return text('{\\"s3\\":{\\"bucket\\":{\\"name\\":\\"', BUCKET, '\\"},\\"object\\":{\\"key\\":\\"', k, '\\"}}}')

    first = record(F.when(eid % 17 == 0, text("bad%zz/", key)).otherwise(F.replace(key, F.lit("-"), F.lit("%2D"))))
    second = F.when(eid % 10 == 0, text(",", record("invalid-key+format.json.gz"))).when(
        eid % 10 == 5, text(",", record("bad%zz/second.json.gz"), ",", record("never-reached.json.gz"))
    ).otherwise("")
    inner = F.when(eid % 13 == 0, "not json").when(eid % 19 == 0, '{\\"Event\\":\\"test\\"}').otherwise(
        text('{\\"Records\\":[', first, second, "]}")
    )
    meta = (
        F.when(
            eid % 11 == 0,
            text(',"processing_metadata":{"offset":', (eid % 4).cast("string"), ',"retry_count":', (eid % 5).cast("string"), "}"),
        )
        .when(eid % 23 == 0, ',"processing_metadata":"broken"')
        .otherwise("")
    )
    body = F.when(eid % 7 == 0, "invalid json content").otherwise(text('{"Message":"', inner, '"', meta, "}"))
    return objects.select(
        text("msg-", eid.cast("string"), "-", F.md5("object_key")).alias("message_id"),
        body.alias("body"),
        F.when(eid % 29 == 0, "").otherwise(text("rh-", eid.cast("string"))).alias("receipt_handle"),
        (eid % 5).cast("int").alias("receive_count"),
        (F.col("modified_ms") - F.when(eid % 31 == 0, 1_300_000_000).otherwise(0)).alias("sent_ms"),
        (F.col("modified_ms") + (eid % 4) * 900_000_000).alias("visible_ms"),
        "object_key",
        "eid",
    )


def configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tenant configs: up to two rows per customer, covering the good and the bad cases."""
    base = table(spark, sf_dir, "customer").selectExpr("c_custkey AS k", "explode(array('cloudwatch', 's3')) AS type")
    kept = base.filter(
        "k % 12 <> 11 AND NOT (k % 12 = 3 AND type = 's3') AND NOT (k % 12 = 4 AND type = 'cloudwatch')"
    )
    return kept.selectExpr(
        "concat('tenant-', k) AS tenant_id",
        "type",
        "CASE k % 10 WHEN 1 THEN NULL WHEN 2 THEN false ELSE true END AS enabled",
        """CASE k % 7 WHEN 1 THEN cast(array() AS array<string>) WHEN 2 THEN array('') WHEN 3 THEN array('kube-apiserver')
            WHEN 4 THEN array('Kube-APIServer') WHEN 5 THEN array('oauth-server', 'kube-scheduler', 'custom-app-1') END AS desired_logs""",
        "CASE k % 9 WHEN 0 THEN array('api', 'Authentication') WHEN 1 THEN array('nosuch', 'SCHEDULER') END AS groups",
        "CASE WHEN k % 13 = 0 THEN 'bad region!' WHEN k % 5 = 0 THEN NULL WHEN k % 5 = 1 THEN '' ELSE 'us-east-1' END AS target_region",
        """CASE WHEN type <> 'cloudwatch' THEN NULL WHEN k % 17 = 3 THEN 'arn:bad:role' WHEN k % 19 = 4 THEN ''
            ELSE concat('arn:aws:iam::', lpad(k, 12, '0'), ':role/LogDistributionRole') END AS log_distribution_role_arn""",
        "CASE WHEN type <> 'cloudwatch' THEN NULL WHEN k % 23 = 5 THEN '  ' ELSE concat('/aws/logs/tenant-', k) END AS log_group_name",
        """CASE WHEN type <> 's3' OR k % 29 = 6 THEN NULL WHEN k % 31 = 7 THEN 'bad_bucket$' ELSE concat('tenant-', k, '-logs') END AS bucket_name""",
        "CASE WHEN type = 's3' THEN CASE k % 4 WHEN 1 THEN '' WHEN 2 THEN 'custom/path' WHEN 3 THEN 'logs/' END END AS bucket_prefix",
        "CASE k % 11 WHEN 5 THEN 1706000000L WHEN 6 THEN 1800000000L END AS ttl",
        "timestamp_seconds(k + 1700000000) AS created_at",
        "timestamp_seconds(k + 1700000000) AS updated_at",
    )
