"""Queries of the projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.functions import keys as K
from tributary.functions import records as JR
from tributary.functions import rules as U
from tributary.functions import timestamps as TS
from tributary.operators import configs as C
from tributary.operators import delivery as D
from tributary.operators import enrich as E
from tributary.operators import health as H
from tributary.operators import records as R
from tributary.operators import routing as RT
from tributary.plans.derive import AS_OF_MS, text
from tributary.plans.oracle import oracle
from tributary.plans.registry import query
from tributary.sources import objects as O


# -- event time -----------------------------------------------------------------------------------

JSON_TIME = """CASE WHEN message LIKE '{%' AND json_valid(message) AND json_type(message) = 'OBJECT' THEN
    CASE WHEN json_exists(message, '$.ts') THEN CASE json_type(message, '$.ts')
            WHEN 'VARCHAR' THEN epoch_us(TRY_CAST(message->>'$.ts' AS TIMESTAMPTZ))//1000
            ELSE CASE WHEN (message->>'$.ts')::DOUBLE < 1e12 THEN (message->>'$.ts')::BIGINT ELSE (message->>'$.ts')::BIGINT//1000 END * 1000 END
         WHEN json_exists(message, '$.time') THEN epoch_us(TRY_CAST(message->>'$.time' AS TIMESTAMPTZ))//1000 END END"""
KLOG = r"'^[IWEF](\d{2})(\d{2})\s+(\d{2}:\d{2}:\d{2})\.(\d{3})\d{3}'"
GO = r"'^(\d{4})/(\d{2})/(\d{2})\s+(\d{2}:\d{2}:\d{2})'"
ISO = r"'^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d{3,6})?Z?)'"


def _ms(expr: str) -> str:
    return f"epoch_us(TRY_CAST({expr} AS TIMESTAMP))//1000"


TEXT_TIME = f"""CASE WHEN regexp_matches(message, {ISO}) THEN {_ms(f"rtrim(regexp_extract(message, {ISO}, 1), 'Z')")}
    ELSE COALESCE(
      CASE WHEN regexp_matches(message, {KLOG}) THEN {_ms(f"'2024-' || regexp_extract(message, {KLOG}, 1) || '-' || regexp_extract(message, {KLOG}, 2) || ' ' || regexp_extract(message, {KLOG}, 3) || '.' || regexp_extract(message, {KLOG}, 4)")}
           WHEN regexp_matches(message, {GO}) THEN {_ms(f"regexp_extract(message, {GO}, 1) || '-' || regexp_extract(message, {GO}, 2) || '-' || regexp_extract(message, {GO}, 3) || ' ' || regexp_extract(message, {GO}, 4)")} END,
      epoch_us(TRY_CAST(nullif(regexp_extract(message, 'time="([^"]+)"', 1), '') AS TIMESTAMPTZ))//1000) END"""


@query("s2_json_event_time", oracle(f"SELECT event_id, COALESCE({JSON_TIME}, ingest_ms) AS event_ms FROM raw", "raw"))
def _(t):
    df = t.raw.withColumn("timestamp", F.timestamp_millis("ingest_ms")).transform(E.with_json_event_time)
    return df.select("event_id", F.unix_millis("timestamp").alias("event_ms"))


@query("s3_text_event_time", oracle(f"SELECT event_id, COALESCE({TEXT_TIME}, ingest_ms) AS event_ms FROM raw", "raw"))
def _(t):
    df = t.raw.withColumn("timestamp", F.timestamp_millis("ingest_ms")).transform(E.with_text_event_time, AS_OF_MS)
    return df.select("event_id", F.unix_millis("timestamp").alias("event_ms"))


@query(
    "s4_event_time",
    oracle(f"SELECT event_id, COALESCE({TEXT_TIME}, {JSON_TIME}, ingest_ms) AS event_ms FROM raw", "raw"),
)
def _(t):
    df = t.raw.withColumn("timestamp", F.timestamp_millis("ingest_ms")).transform(E.with_event_time, AS_OF_MS)
    return df.select("event_id", F.unix_millis("timestamp").alias("event_ms"))


@query(
    "s1_delivery_timestamp",
    oracle("SELECT object_key, line_no, item_no, event_ts_ms FROM ev", "ev"),
)
def _(t):
    return t.events.select("object_key", "line_no", "item_no", "event_ts_ms")


# -- records --------------------------------------------------------------------------------------

@query(
    "s5_parse_lines",
    oracle(
        """SELECT object_key, line_no, item_no::INTEGER AS item_no, false AS parse_error, json_type(rec) = 'OBJECT' AS is_object FROM records
        UNION ALL SELECT object_key, line_no, 0, true, false FROM parsed WHERE NOT ok""",
        "records",
    ),
)
def _(t):
    return t.records.select("object_key", "line_no", "item_no", "parse_error", "is_object")


@query("c9_log_events", oracle("SELECT object_key, line_no, item_no, event_ts_ms, message FROM ev", "ev"))
def _(t):
    return t.events


@query(
    "c10_message_text",
    oracle(
        """SELECT line_no, item_no::INTEGER AS item_no, CASE WHEN json_type(m) = 'VARCHAR' THEN m->>'$' WHEN json_exists(m, '$.a')
            THEN '{"a":[1000,-1e-7,1e+21,2.5,0.000001,123456789.125,12345678901234567000],"b 1.50":"1.50\\u2028\\u2029"}' ELSE CAST(m AS VARCHAR) END AS message
        FROM (SELECT line_no, item_no, json_extract(rec, '$.message') AS m FROM records WHERE json_type(rec) = 'OBJECT')
        WHERE m IS NOT NULL""",
        "records",
    ),
)
def _(t):
    message = F.try_variant_get("record", "$.message", "variant")
    found = t.records.withColumn("m", message).filter("m is not null")
    return found.select("line_no", "item_no", JR.message_text(F.col("m")).alias("message"))


@query("d6_blank_lines", oracle(r"SELECT object_key, line_no, line FROM stored WHERE regexp_matches(line, '\S')", "stored"))
def _(t):
    return R.drop_blank(t.stored)


@query(
    "c11_fallback_time",
    oracle(
        """SELECT line_no, item_no, CASE WHEN u > 1000000000000 THEN u ELSE u * 1000 END AS event_ts_ms
        FROM (SELECT line_no, item_no, COALESCE(nullif(event_ts_ms, 0), modified_ms) AS u FROM ev JOIN listing USING (object_key))""",
        "ev",
        "listing",
    ),
)
def _(t):
    sized = t.events.join(t.listing.select("object_key", F.col("modified_ms").alias("upload_ms")), "object_key")
    return R.fallback_ts(sized).select("line_no", "item_no", "event_ts_ms")


@query(
    "s8_event_size",
    oracle("SELECT doc_id, strlen(text) + 26 AS event_bytes FROM documents"),
)
def _(t):
    return t.given("documents").select("doc_id", U.event_size(F.col("text")).alias("event_bytes"))


# -- collector projections ------------------------------------------------------------------------

@query(
    "c1_enrich_metadata",
    oracle(
        """SELECT event_id, COALESCE(cluster, 'unknown') AS cluster_id, COALESCE(pod_namespace, 'unknown') AS namespace,
        COALESCE(app_label, 'unknown') AS application, COALESCE(pod, 'unknown') AS pod_name,
        COALESCE(ts_in_ms, 1706659200000) AS ts_ms, COALESCE(ts_in_ms, 1706659200000) AS ingest_ms FROM pods""",
        "pods",
    ),
)
def _(t):
    df = E.enrich_metadata(t.pods, F.col("cluster"), AS_OF_MS)
    return df.select(
        "event_id", "cluster_id", "namespace", "application", "pod_name",
        F.unix_millis("timestamp").alias("ts_ms"), F.unix_millis("ingest_timestamp").alias("ingest_ms"),
    )


@query(
    "c4_object_key",
    oracle(
        """SELECT event_id, cluster_id || '/' || namespace || '/' || application || '/' || pod_name || '/' ||
        strftime(make_timestamp(ingest_ms * 1000), '%Y%m%d-%H%M%S') || '-' || md5(message) || '.json.gz' AS object_key FROM raw""",
        "raw",
    ),
)
def _(t):
    return E.render_object_key(t.raw, "ingest_ms").select("event_id", "object_key")


@query(
    "c13_merge_json",
    oracle(
        """SELECT event_id, key AS field, CAST(value AS VARCHAR) AS value FROM (
          SELECT event_id, unnest(json_keys(d)) AS key, d->(unnest(json_keys(d))) AS value FROM (
            SELECT event_id, CASE WHEN json_valid(message) AND json_type(message) = 'OBJECT'
               THEN json_merge_patch(base, message::JSON) ELSE base END AS d
            FROM (SELECT event_id, message, json_object('level', 'none', 'application', application) AS base FROM raw)))""",
        "raw",
    ),
)
def _(t):
    def variant(value):
        return F.try_variant_get(F.to_variant_object(F.array(value)), "$[0]", "variant")

    record = F.create_map(
        F.lit("level"), variant(F.lit("none")), F.lit("application"), variant(F.col("application"))
    )
    merged = E.merge_json_message(t.raw.withColumn("record", record))
    fields = merged.select("event_id", F.explode("record").alias("field", "v"))
    return fields.select("event_id", "field", F.to_json("v").alias("value"))


@query(
    "c14_log_level",
    oracle(
        r"""SELECT doc_id, COALESCE(nullif(regexp_extract(line, '(TRACE|DEBUG|INFO|WARN|ERROR|FATAL)', 1), ''), 'INFO') AS log_level
        FROM (SELECT doc_id, upper(text) AS line FROM documents)"""
    ),
)
def _(t):
    docs = t.given("documents").select("doc_id", F.upper("text").alias("message"))
    return E.extract_log_level(docs).select("doc_id", "log_level")


@query(
    "c15_structure_record",
    oracle(
        """SELECT ingest_ms AS timestamp, namespace AS customer_id, cluster_id,
        CASE split_part(cluster_id, '-', 1) WHEN 'stg' THEN 'staging' WHEN 'dev' THEN 'development' ELSE 'production' END AS environment,
        application, pod_name, 'INFO' AS log_level, message, 'collector' AS source FROM raw""",
        "raw",
    ),
)
def _(t):
    df = E.extract_log_level(t.raw).withColumns(
        {
            "timestamp": F.col("ingest_ms"),
            "customer_id": F.col("namespace"),
            "environment": K.environment(F.col("cluster_id")),
        }
    )
    return E.structure_record(df, "collector")


@query(
    "c16_preview",
    oracle("SELECT page_id, CASE WHEN strlen(url) <= 30 THEN url ELSE url[1:30] || '...' END AS preview FROM pages"),
)
def _(t):
    return t.given("pages").select("page_id", U.preview(F.col("url"), 30).alias("preview"))


# -- keys -----------------------------------------------------------------------------------------

@query(
    "c2_tenant_info",
    oracle("SELECT object_key, cluster_id, namespace, tenant_id, application, pod_name, environment FROM info", "info"),
)
def _(t):
    return t.objects.select(
        "object_key", "cluster_id", "namespace", "tenant_id", "application", "pod_name", "environment"
    )


@query(
    "c3_environment",
    oracle(
        """SELECT cluster, CASE WHEN contains(cluster, '-') THEN CASE split_part(cluster, '-', 1) WHEN 'stg' THEN 'staging'
            WHEN 'dev' THEN 'development' ELSE 'production' END ELSE 'production' END AS environment, count(*) AS n
        FROM (SELECT CASE WHEN event_id % 7 = 0 THEN split_part(cluster_id, '-', 1) ELSE cluster_id END AS cluster FROM raw) GROUP BY ALL""",
        "raw",
    ),
)
def _(t):
    cluster = F.when(F.col("event_id") % 7 == 0, F.substring_index("cluster_id", "-", 1)).otherwise(F.col("cluster_id"))
    df = t.raw.select(cluster.alias("cluster"))
    return df.groupBy("cluster", K.environment(F.col("cluster")).alias("environment")).agg(F.count("*").alias("n"))


@query(
    "c5_filename",
    oracle(
        """SELECT object_key, regexp_extract(object_key, '[^/]*$') AS file_name,
        regexp_extract(replace(object_key, '/', '_'), '[^/]*$') AS flat_name FROM listing""",
        "listing",
    ),
)
def _(t):
    flat = F.replace("object_key", F.lit("/"), F.lit("_"))
    return t.listing.select(
        "object_key", K.filename(F.col("object_key")).alias("file_name"), K.filename(flat).alias("flat_name")
    )


@query(
    "c6_prefix",
    oracle(
        """SELECT tenant_id, type, CASE WHEN bucket_prefix <> '' AND bucket_prefix NOT LIKE '%/' THEN bucket_prefix || '/' ELSE bucket_prefix END AS prefix,
        COALESCE(CASE WHEN bucket_prefix <> '' AND bucket_prefix NOT LIKE '%/' THEN bucket_prefix || '/' ELSE bucket_prefix END, '') AS api_prefix
        FROM cfg""",
        "cfg",
    ),
)
def _(t):
    p = F.col("bucket_prefix")
    return t.configs.select("tenant_id", "type", K.slashed(p).alias("prefix"), K.slashed_or_empty(p).alias("api_prefix"))


DST_KEY = """CASE WHEN COALESCE(bucket_prefix, '') = '' THEN 'ROSA/cluster-logs/' WHEN bucket_prefix LIKE '%/' THEN bucket_prefix
    ELSE bucket_prefix || '/' END || tenant_id || '/' || application || '/' || pod_name || '/' || regexp_extract(object_key, '[^/]*$')"""


@query(
    "c7_destination_key",
    oracle(f"SELECT object_key, bucket_name, {DST_KEY} AS dst_key FROM routed WHERE type = 's3'", "routed"),
)
def _(t):
    return D.with_destination_key(t.routed.filter("type = 's3'")).select("object_key", "bucket_name", "dst_key")


@query(
    "c8_delivery_metadata",
    oracle(
        """SELECT object_key, unnest(['source-bucket', 'source-key', 'tenant-id', 'application', 'pod-name', 'delivery-timestamp']) AS name,
        unnest(['central-logs', object_key, tenant_id, application, pod_name, '1706659200']) AS value FROM info""",
        "info",
    ),
)
def _(t):
    return t.objects.select("object_key", F.explode(D.delivery_metadata(AS_OF_MS)).alias("name", "value"))


@query(
    "c12_defaults",
    oracle(
        """SELECT tenant_id, type, COALESCE(nullif(target_region, ''), 'us-east-1') AS target_region,
        CASE WHEN COALESCE(bucket_prefix, '') = '' THEN 'ROSA/cluster-logs/' WHEN bucket_prefix LIKE '%/' THEN bucket_prefix ELSE bucket_prefix || '/' END AS bucket_prefix
        FROM cfg""",
        "cfg",
    ),
)
def _(t):
    return C.apply_delivery_defaults(t.configs).select("tenant_id", "type", "target_region", "bucket_prefix")


@query(
    "c17_event_destination",
    oracle("SELECT object_key, log_group_name AS log_group, pod_name AS log_stream FROM routed WHERE type = 'cloudwatch'", "routed"),
)
def _(t):
    return RT.event_destination(t.routed.filter("type = 'cloudwatch'")).select("object_key", "log_group", "log_stream")


# -- filters --------------------------------------------------------------------------------------

@query(
    "d1_rejected_keys",
    oracle(
        r"""SELECT k AS object_key, CASE WHEN len(p) < 5 THEN 'too_few_segments' WHEN trim(p[1]) = '' THEN 'blank_cluster_id' WHEN trim(p[2]) = '' THEN 'blank_namespace'
            WHEN trim(p[3]) = '' THEN 'blank_application' WHEN trim(p[4]) = '' THEN 'blank_pod_name' END AS reason
        FROM (SELECT k, string_split(k, '/') AS p FROM (SELECT CASE WHEN eid % 9 = 0 THEN regexp_replace(object_key, '/[^/]*$', '') ELSE object_key END AS k FROM listing))
        WHERE len(p) < 5 OR trim(p[1]) = '' OR trim(p[2]) = '' OR trim(p[3]) = '' OR trim(p[4]) = ''""",
        "listing",
    ),
)
def _(t):
    short = F.regexp_replace("object_key", "/[^/]*$", "")
    keys = t.listing.select(F.when(F.col("eid") % 9 == 0, short).otherwise(F.col("object_key")).alias("object_key"))
    _, rejects = RT.split_valid_keys(keys)
    return rejects


@query(
    "d2_application_filter",
    oracle(
        """SELECT tenant_id, type, a AS application, desired_logs IS NULL OR len(desired_logs) = 0 OR desired_logs = ['']
            OR list_contains(desired_logs, a) AS selected
        FROM (SELECT *, unnest(['kube-apiserver', 'oauth-server']) AS a FROM cfg)""",
        "cfg",
    ),
)
def _(t):
    apps = F.explode(F.array(F.lit("kube-apiserver"), F.lit("oauth-server")))
    df = t.configs.withColumn("application", apps)
    return df.select(
        "tenant_id", "type", "application",
        U.application_enabled(F.col("desired_logs"), F.col("application")).alias("selected"),
    )


@query("d3_enabled_for_delivery", oracle("SELECT tenant_id, type FROM cfg WHERE COALESCE(enabled, false)", "cfg"))
def _(t):
    return C.enabled_configs(t.configs, missing=False).select("tenant_id", "type")


@query("d4_enabled_for_api", oracle("SELECT tenant_id, type FROM cfg WHERE COALESCE(enabled, true)", "cfg"))
def _(t):
    return C.enabled_configs(t.configs, missing=True).select("tenant_id", "type")


@query(
    "d5_suffix_filters",
    oracle(
        "SELECT object_key, object_key LIKE '%.json.gz' AS scanned FROM listing WHERE object_key LIKE '%.gz' OR object_key LIKE '%.json'",
        "listing",
    ),
)
def _(t):
    zipped = O.with_suffix(t.listing, O.NOTIFY_SUFFIX).unionByName(O.with_suffix(t.listing, ".json"))
    return zipped.select("object_key", F.col("object_key").endswith(O.SCAN_SUFFIX).alias("scanned"))


@query(
    "d7_skip_processed",
    oracle(
        """SELECT object_key, line_no, item_no, message FROM (
          SELECT e.*, o."offset" AS off, row_number() OVER (PARTITION BY object_key ORDER BY line_no, item_no) AS rn
          FROM ev e JOIN (SELECT object_key, eid % 9 - 2 AS "offset" FROM listing) o USING (object_key))
        WHERE off <= 0 OR rn > off""",
        "ev",
        "listing",
    ),
)
def _(t):
    offsets = t.listing.select("object_key", (F.col("eid") % 9 - 2).alias("offset"))
    return R.skip_processed(t.events, offsets).select("object_key", "line_no", "item_no", "message")


@query(
    "d8_known_types",
    oracle("SELECT tenant_id, type FROM (SELECT tenant_id, CASE WHEN k % 8 = 0 THEN 'ftp' ELSE type END AS type FROM cfg) WHERE type IN ('cloudwatch', 's3')", "cfg"),
)
def _(t):
    k = F.substring_index("tenant_id", "-", -1).cast("int")
    mixed = t.configs.select("tenant_id", F.when(k % 8 == 0, "ftp").otherwise(F.col("type")).alias("type"))
    return R.known_types(mixed)


@query("d9_unexpired", oracle("SELECT tenant_id, type, ttl FROM cfg WHERE ttl IS NULL OR ttl > 1706659200", "cfg"))
def _(t):
    return C.unexpired_configs(t.configs, AS_OF_MS).select("tenant_id", "type", "ttl")


@query(
    "d10_expired_objects",
    oracle("SELECT object_key, modified_ms FROM listing WHERE modified_ms < 1706659200000 - 7 * 86400000", "listing"),
)
def _(t):
    return H.expired_objects(t.listing, AS_OF_MS).select("object_key", "modified_ms")


@query(
    "d11_search_text",
    oracle("SELECT line_no, event_ts_ms, message FROM ev WHERE message LIKE '%m1%' AND event_ts_ms >= 1704100000000", "ev"),
)
def _(t):
    return H.search_events(t.events, pattern="m1", start_ms=1_704_100_000_000).select("line_no", "event_ts_ms", "message")


@query(
    "d11_search_field",
    oracle(
        """SELECT event_id, message FROM raw WHERE ingest_ms >= 1705000000000 AND json_valid(message) AND message->>'$.level' = 'warn'
        ORDER BY ingest_ms, event_id, message LIMIT 200""",
        "raw",
    ),
)
def _(t):
    df = t.raw.select("event_id", "message", F.col("ingest_ms").alias("event_ts_ms"))
    found = H.search_events(df, json_path="$.level", equals="warn", start_ms=1_705_000_000_000, limit=200)
    return found.select("event_id", "message")


@query("d12_malformed_paths", oracle("SELECT object_key FROM listing WHERE contains(object_key, '//')", "listing"))
def _(t):
    return H.audit_keys(t.listing).select("object_key")


@query("d13_config_overview", oracle("SELECT tenant_id, type, enabled FROM cfg", "cfg"))
def _(t):
    return C.config_overview(t.configs)


@query("d13_config_count", oracle("SELECT count(*) AS configs FROM cfg", "cfg"))
def _(t):
    return t.configs.agg(F.count("*").alias("configs"))


@query(
    "d14_storage_tier",
    oracle(
        """SELECT object_key, age AS age_days, CASE WHEN age >= 90 THEN 'deep_archive' WHEN age >= 1 THEN 'archive' ELSE 'standard' END AS tier
        FROM (SELECT object_key, (1706659200000 - (modified_ms - (eid % 4) * 3000000000)) // 86400000 AS age FROM listing)""",
        "listing",
    ),
)
def _(t):
    aged = t.listing.withColumn("modified_ms", F.col("modified_ms") - (F.col("eid") % 4) * 3_000_000_000)
    return H.storage_tier(aged, AS_OF_MS).select("object_key", "age_days", "tier")


# -- scalar rules ---------------------------------------------------------------------------------

@query(
    "s7_retry_delay",
    oracle("SELECT event_id, least(pow(2, event_id % 14 + 1), 900)::INTEGER AS delay_s FROM events"),
)
def _(t):
    n = F.col("event_id") % 14
    return t.given("events").select("event_id", U.retry_delay_s(n).alias("delay_s"))


@query(
    "s9_tenant_id",
    oracle(
        r"""SELECT page_id, id, length(id) BETWEEN 1 AND 128 AND regexp_matches(id, '^[\p{L}\p{N}_-]+$') AND regexp_matches(id, '[\p{L}\p{N}]') AS valid
        FROM (SELECT page_id, CASE page_id % 6 WHEN 0 THEN url WHEN 1 THEN '' WHEN 2 THEN '-_-' WHEN 3 THEN regexp_replace(url, '[^a-z0-9]', '_', 'g')
          WHEN 4 THEN repeat('é', 120 + (page_id % 20)::INTEGER) ELSE 'tenant-' || page_id || CASE WHEN page_id % 12 = 5 THEN chr(10) ELSE '' END END AS id FROM pages)"""
    ),
)
def _(t):
    n = F.col("page_id")
    ident = (
        F.when(n % 6 == 0, F.col("url")).when(n % 6 == 1, "").when(n % 6 == 2, "-_-")
        .when(n % 6 == 3, F.regexp_replace("url", "[^a-z0-9]", "_"))
        .when(n % 6 == 4, F.repeat(F.lit("é"), (120 + n % 20).cast("int")))
        .otherwise(text("tenant-", n.cast("string"), F.when(n % 12 == 5, "\n").otherwise("")))
    )
    df = t.given("pages").select("page_id", ident.alias("id"))
    return df.withColumn("valid", U.valid_tenant_id(F.col("id")))


@query(
    "s10_s11_s12_formats",
    oracle(
        r"""SELECT tenant_id, type, starts_with(log_distribution_role_arn, 'arn:aws:iam::') AS arn_ok,
        regexp_matches(bucket_name, '^[\p{L}\p{N}.-]+$') AND regexp_matches(bucket_name, '[\p{L}\p{N}]') AS bucket_ok,
        regexp_matches(target_region, '^[\p{L}\p{N}-]+$') AND regexp_matches(target_region, '[\p{L}\p{N}]') AS region_ok,
        regexp_matches(replace(target_region, 'east', '_'), '^[\p{L}\p{N}_-]+$') AND regexp_matches(target_region, '[\p{L}\p{N}]') AS region_report_ok
        FROM (SELECT * REPLACE (bucket_name || tail AS bucket_name, target_region || tail AS target_region) FROM (SELECT *, CASE WHEN tenant_id LIKE '%7' THEN chr(10) ELSE '' END AS tail FROM cfg))""",
        "cfg",
    ),
)
def _(t):
    tail = F.when(F.col("tenant_id").like("%7"), "\n").otherwise("")  # a trailing line feed is refused
    region, bucket = F.concat("target_region", tail), F.concat("bucket_name", tail)
    return t.configs.select(
        "tenant_id", "type",
        U.valid_role_arn(F.col("log_distribution_role_arn")).alias("arn_ok"),
        U.valid_bucket(bucket).alias("bucket_ok"),
        U.valid_region(region).alias("region_ok"),
        U.valid_region(F.replace(region, F.lit("east"), F.lit("_")), allow_underscore=True).alias("region_report_ok"),
    )


@query(
    "s13_desired_logs",
    oracle(
        "SELECT tenant_id, type, desired_logs IS NULL OR len(list_filter(desired_logs, lambda x: trim(x) = '')) = 0 AS valid FROM cfg",
        "cfg",
    ),
)
def _(t):
    return t.configs.select("tenant_id", "type", U.valid_desired_logs(F.col("desired_logs")).alias("valid"))


@query(
    "s14_required_fields",
    oracle(
        """SELECT tenant_id, type,
        CASE WHEN type = 'cloudwatch' THEN concat_ws(',', CASE WHEN trim(COALESCE(log_distribution_role_arn, '')) = '' THEN 'log_distribution_role_arn' END,
            CASE WHEN trim(COALESCE(log_group_name, '')) = '' THEN 'log_group_name' END) ELSE CASE WHEN trim(COALESCE(bucket_name, '')) = '' THEN 'bucket_name' ELSE '' END END AS missing_for_delivery,
        CASE WHEN type = 'cloudwatch' THEN concat_ws(',', CASE WHEN COALESCE(log_distribution_role_arn, '') = '' THEN 'log_distribution_role_arn' END,
            CASE WHEN COALESCE(log_group_name, '') = '' THEN 'log_group_name' END) ELSE CASE WHEN COALESCE(bucket_name, '') = '' THEN 'bucket_name' ELSE '' END END AS missing_for_api
        FROM cfg""",
        "cfg",
    ),
)
def _(t):
    fields = {name: F.col(name) for names in U.REQUIRED_FIELDS.values() for name in names}
    return t.configs.select(
        "tenant_id", "type",
        F.array_join(U.missing_required(F.col("type"), fields), ",").alias("missing_for_delivery"),
        F.array_join(U.missing_required(F.col("type"), fields, blank_counts=False), ",").alias("missing_for_api"),
    )


@query(
    "s15_metric_name",
    oracle("SELECT DISTINCT 'LogCount/' || type || '/' || m AS metric FROM (SELECT type, unnest(['successful_delivery', 'failed_delivery']) AS m FROM cfg)", "cfg"),
)
def _(t):
    m = F.explode(F.array(F.lit("successful_delivery"), F.lit("failed_delivery")))
    df = t.configs.select("type", m.alias("m"))
    return df.select(U.metric_name(F.col("type"), F.col("m")).alias("metric")).distinct()


@query(
    "s16_page_key",
    oracle("SELECT tenant_id || '#' || type AS page_key, tenant_id, type || '#x' AS type FROM cfg", "cfg"),
)
def _(t):
    key = K.page_key(F.col("tenant_id"), F.col("type"))
    df = t.configs.select(key.alias("page_key"), K.parse_page_key(text(key, "#x")).alias("p"))
    return df.select("page_key", "p.tenant_id", "p.type")


@query(
    "s18_unescape_key",
    oracle(
        r"""SELECT page_id, CASE WHEN regexp_matches(k, '%([^0-9A-Fa-f]|.[^0-9A-Fa-f]|.?$)') THEN NULL ELSE url_decode(replace(k, '+', '%20')) END AS key
        FROM (SELECT page_id, CASE page_id % 3 WHEN 0 THEN replace(replace(url, '/', '%2F'), '-', '+') WHEN 1 THEN url || '%zz' ELSE url END AS k FROM pages)"""
    ),
)
def _(t):
    url, n = F.col("url"), F.col("page_id")
    escaped = F.replace(F.replace(url, F.lit("/"), F.lit("%2F")), F.lit("-"), F.lit("+"))
    key = F.when(n % 3 == 0, escaped).when(n % 3 == 1, text(url, "%zz")).otherwise(url)
    return t.given("pages").select("page_id", K.unescape_key(key).alias("key"))


@query(
    "s19_error_class",
    oracle(
        """SELECT message_id, error, CASE WHEN contains(error, 'NoSuchBucket') OR contains(error, 'AccessDenied') OR contains(error, 'NoSuchKey') THEN 'non_recoverable' ELSE 'recoverable' END AS error_class
        FROM (SELECT message_id, 'copy of ' || object_key || ' failed: ' || CASE eid % 6 WHEN 0 THEN 'NoSuchBucket' WHEN 1 THEN 'AccessDenied' WHEN 2 THEN 'NoSuchKey'
            WHEN 3 THEN 'SlowDown' WHEN 4 THEN 'ServiceUnavailable' ELSE 'RequestTimeout' END AS error FROM msgs)""",
        "msgs",
    ),
)
def _(t):
    n = F.col("eid") % 6
    word = (
        F.when(n == 0, "NoSuchBucket").when(n == 1, "AccessDenied").when(n == 2, "NoSuchKey")
        .when(n == 3, "SlowDown").when(n == 4, "ServiceUnavailable").otherwise("RequestTimeout")
    )
    df = t.messages.select("message_id", text("copy of ", F.col("object_key"), " failed: ", word).alias("error"))
    return df.withColumn("error_class", U.copy_error_class(F.col("error")))


@query(
    "s20_collections",
    oracle(
        """SELECT tenant_id, type, list_contains(desired_logs, 'kube-apiserver') AS has_api, len(list_distinct(list_concat(desired_logs, desired_logs))) AS distinct_names
        FROM cfg WHERE desired_logs IS NOT NULL""",
        "cfg",
    ),
)
def _(t):
    names = F.col("desired_logs")
    df = t.configs.filter(names.isNotNull())
    return df.select(
        "tenant_id", "type",
        F.array_contains(names, "kube-apiserver").alias("has_api"),
        F.size(F.array_distinct(F.concat(names, names))).cast("bigint").alias("distinct_names"),
    )
