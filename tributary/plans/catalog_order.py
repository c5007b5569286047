"""Queries of ordered operators, packing, heartbeats, pages, groups and config maintenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.constants import APPLICATION_GROUPS
from tributary.functions.rules import event_size
from tributary.operators import configs as C
from tributary.operators import delivery as D
from tributary.operators import health as H
from tributary.operators import packing as PK
from tributary.operators import records as R
from tributary.plans.derive import AS_OF_MS, text
from tributary.plans.oracle import oracle
from tributary.plans.registry import query
from tributary.session import scratch_path
from tributary.sinks.config_store import ConfigStore

# -- order and packing ----------------------------------------------------------------------------

DELIVERIES = """SELECT tenant_id, type, log_group_name AS log_group, pod_name AS log_stream, object_key, line_no, item_no, message,
    CASE WHEN u > 1000000000000 THEN u ELSE u * 1000 END AS event_ts_ms
    FROM (SELECT r.*, e.line_no, e.item_no, e.message, COALESCE(nullif(e.event_ts_ms, 0), r.modified_ms) AS u
          FROM ev e JOIN routed r USING (object_key) WHERE r.type = 'cloudwatch')"""
KEYS = "tenant_id, type, log_group, log_stream, object_key"


def _packed_sql(source: str, keys: str, order: str, max_events: int, max_bytes: int, select: str) -> str:
    """Greedy packing as a recursion from event to event."""
    on = " AND ".join(f"n.{k.strip()} = s.{k.strip()}" for k in keys.split(","))
    fits = f"s.events < {max_events} AND s.bytes + n.size <= {max_bytes}"
    return f"""{select} FROM (WITH RECURSIVE numbered AS MATERIALIZED (SELECT *, strlen(message) + 26 AS size, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS seq FROM {source}),
      walk AS (SELECT {keys}, seq, 0 AS batch_id, 1 AS events, size AS bytes FROM numbered WHERE seq = 1
        UNION ALL SELECT {", ".join("n." + k.strip() for k in keys.split(","))}, n.seq, CASE WHEN {fits} THEN s.batch_id ELSE s.batch_id + 1 END,
          CASE WHEN {fits} THEN s.events + 1 ELSE 1 END, CASE WHEN {fits} THEN s.bytes + n.size ELSE n.size END
        FROM walk s JOIN numbered n ON {on} AND n.seq = s.seq + 1)
      SELECT n.*, s.batch_id::BIGINT AS batch_id FROM numbered n JOIN walk s ON {on} AND n.seq = s.seq)"""


@query(
    "g1_order_events",
    oracle(
        f"SELECT tenant_id, log_stream, object_key, line_no, item_no, row_number() OVER (PARTITION BY tenant_id, log_group, log_stream ORDER BY event_ts_ms, object_key, line_no, item_no) AS seq FROM dl",
        "ev", "routed", dl=DELIVERIES,
    ),
)
def _(t):
    ordered = R.order_events(D.routed_events(D.lines_of_routed(t.stored, t.routed), AS_OF_MS), ["tenant_id", "log_group", "log_stream"])
    return ordered.select("tenant_id", "log_stream", "object_key", "line_no", "item_no", "seq")


@query(
    "g2_pack_deliveries",
    oracle(
        _packed_sql("dl", KEYS, "event_ts_ms, line_no, item_no", 4, 130, "SELECT tenant_id, object_key, line_no, item_no, seq, batch_id"),
        "ev", "routed", dl=DELIVERIES,
    ),
)
def _(t):
    packed = D.pack_deliveries(D.routed_events(D.lines_of_routed(t.stored, t.routed), AS_OF_MS), max_events=4, max_bytes=130)
    return packed.select("tenant_id", "object_key", "line_no", "item_no", "seq", "batch_id")


# The same from raw lines: routed by key, then parsed, with the upload time each line carries.
@query(
    "g2_pack_routed_lines",
    oracle(
        _packed_sql("dl", KEYS, "event_ts_ms, line_no, item_no", 4, 130, "SELECT tenant_id, object_key, line_no, item_no, seq, batch_id"),
        "ev", "routed",
        dl=DELIVERIES.replace("r.modified_ms)", "x.ingest_ms)").replace("USING (object_key) WHERE", "USING (object_key) JOIN raw x USING (line_no) WHERE"),
    ),
)
def _(t):
    lines = t.stored_with_upload
    packed = D.pack_deliveries(D.routed_events(D.lines_to_deliver(lines, t.routable), AS_OF_MS), max_events=4, max_bytes=130)
    return packed.select("tenant_id", "object_key", "line_no", "item_no", "seq", "batch_id")


# One hot stream: every document of the table in one key.
@query(
    "g2_pack_hot_stream",
    oracle(
        _packed_sql("docs", "stream", "doc_id", 60, 200_000, "SELECT doc_id, seq, batch_id"),
        docs="SELECT 'all' AS stream, doc_id, text AS message FROM documents",
    ),
)
def _(t):
    docs = t.given("documents").select(F.lit("all").alias("stream"), "doc_id", event_size(F.col("text")).alias("size"))
    packed = PK.pack_batches(docs, ["stream"], ["doc_id"], size=F.col("size"), max_events=60, max_bytes=200_000)
    return packed.select("doc_id", "seq", "batch_id")


@query(
    "g2_pack_sources",
    oracle(
        _packed_sql("docs", "source", "doc_id", 1000, 30_000, "SELECT source, doc_id, seq, batch_id"),
        docs="SELECT source, doc_id, text AS message FROM documents",
    ),
)
def _(t):
    docs = t.given("documents").select("source", "doc_id", F.col("text").alias("message"))
    return PK.pack_batches(docs, ["source"], ["doc_id"], max_bytes=30_000).select("source", "doc_id", "seq", "batch_id")


@query(
    "g3_pack_by_count",
    oracle(
        f"""SELECT tenant_id, object_key, line_no, item_no, (row_number() OVER (PARTITION BY {KEYS} ORDER BY event_ts_ms, line_no, item_no) - 1) // 3 AS batch_id FROM dl""",
        "ev", "routed", dl=DELIVERIES,
    ),
)
def _(t):
    deliveries = D.routed_events(D.lines_of_routed(t.stored, t.routed), AS_OF_MS)
    packed = PK.pack_by_count(deliveries, D.DELIVERY, ["event_ts_ms", "line_no", "item_no"], 3, costly=True)
    return packed.select("tenant_id", "object_key", "line_no", "item_no", "batch_id")


@query(
    "f6_batch_size_stats",
    oracle(
        _packed_sql(
            "docs", "source", "doc_id", 1000, 30_000,
            """SELECT source, batch_id, count(*) AS events, sum(size)::BIGINT AS total_bytes, sum(size - 26)::BIGINT AS message_bytes,
            count(*) * 26 AS overhead_bytes, round(count(*) * 26 * 100 / sum(size), 1) AS overhead_pct""",
        )
        + " GROUP BY source, batch_id",
        docs="SELECT source, doc_id, text AS message FROM documents",
    ),
)
def _(t):
    docs = t.given("documents").select("source", "doc_id", F.col("text").alias("message"))
    packed = PK.pack_batches(docs, ["source"], ["doc_id"], max_bytes=30_000)
    return PK.batch_size_stats(packed, ["source"])


@query(
    "b3_delivery_batches",
    oracle(
        _packed_sql(
            "dl", KEYS, "event_ts_ms, line_no, item_no", 4, 130,
            "SELECT tenant_id, object_key, batch_id, count(*) AS events, string_agg(message, '|' ORDER BY seq) AS messages, min(event_ts_ms) AS first_ms",
        )
        + " GROUP BY ALL",
        "ev", "routed", dl=DELIVERIES,
    ),
)
def _(t):
    from tributary.session import scratch_path
    from tributary.sinks.tables import write_delivery_batches

    packed = D.pack_deliveries(D.routed_events(D.lines_of_routed(t.stored, t.routed), AS_OF_MS), max_events=4, max_bytes=130)
    path = scratch_path(t.spark, "batches")
    write_delivery_batches(D.delivery_batches(packed), path)
    return t.spark.read.parquet(path).select(
        "tenant_id", "object_key", "batch_id", "events",
        F.array_join(F.transform("log_events", lambda e: e["message"]), "|").alias("messages"),
        F.array_min(F.transform("log_events", lambda e: e["event_ts_ms"])).alias("first_ms"),
    )


# -- health ---------------------------------------------------------------------------------------

def beat_records(t):
    """(cluster_id, ts_ms) of the heartbeat records among the messages of all events."""
    beat = F.col("application") == "kube-controller-manager"
    record = text('{"level":"info","message":"beat","interval_seconds":30,"heartbeat":', F.when(beat, "true").otherwise("false"), "}")
    message = F.when(beat | (F.col("event_id") % 2 == 0), record).otherwise(F.col("message"))
    return H.heartbeat_records(t.raw.select("cluster_id", "ts_ms", message.alias("message"))).select("cluster_id", "ts_ms")


@query(
    "g4_heartbeat_gaps",
    oracle(
        """SELECT cluster_id, ts_ms AS from_ms, COALESCE(nxt, 1706659200000) AS to_ms, COALESCE(nxt, 1706659200000) - ts_ms AS gap_ms, nxt IS NULL AS ongoing
        FROM (SELECT cluster_id, ts_ms, lead(ts_ms) OVER (PARTITION BY cluster_id ORDER BY ts_ms) AS nxt FROM raw0 WHERE event_type = 'view')
        WHERE COALESCE(nxt, 1706659200000) - ts_ms > 30000000""",
        "raw0",
    ),
)
def _(t):
    return H.heartbeat_gaps(beat_records(t), AS_OF_MS, max_gap_s=30_000)


@query(
    "g5_streams_by_recency",
    oracle(
        "SELECT cluster_id, pod_name, max(ingest_ms) AS last_event_ms FROM raw GROUP BY ALL ORDER BY last_event_ms DESC, cluster_id, pod_name LIMIT 25", "raw"
    ),
)
def _(t):
    events = t.raw.withColumn("event_ts_ms", F.col("ingest_ms"))
    return H.streams_by_recency(events, 25, ["cluster_id", "pod_name"])


@query(
    "h2_latest_objects",
    oracle("SELECT object_key, modified_ms FROM listing ORDER BY modified_ms DESC, object_key DESC LIMIT 40", "listing"),
)
def _(t):
    return H.latest_objects(t.listing, 40).select("object_key", "modified_ms")


# -- config table ---------------------------------------------------------------------------------

@query(
    "a6_config_scan",
    oracle(
        """SELECT tenant_id, type, enabled, array_to_string(desired_logs, '|') AS desired_logs, target_region, log_distribution_role_arn, log_group_name,
        bucket_name, bucket_prefix, ttl, created_ms FROM cfg""",
        "cfg",
    ),
)
def _(t):
    from tributary.session import scratch_path
    from tributary.sources.configs import read_tenant_configs

    path = scratch_path(t.spark, "configs")
    t.configs.write.json(path)
    return read_tenant_configs(t.spark, path, "json").select(
        "tenant_id", "type", "enabled", F.array_join("desired_logs", "|").alias("desired_logs"), "target_region",
        "log_distribution_role_arn", "log_group_name", "bucket_name", "bucket_prefix", "ttl",
        F.unix_millis("created_at").alias("created_ms"),
    )


def _page_sql(limit: int, after: str) -> str:
    return oracle(
        f"""SELECT tenant_id, type, (SELECT CASE WHEN count(*) > {limit} THEN (SELECT tenant_id || '#' || type FROM p ORDER BY tenant_id, type LIMIT 1 OFFSET {limit - 1}) END FROM p) AS last_key
        FROM p ORDER BY tenant_id, type LIMIT {limit}""",
        "cfg", p=f"SELECT tenant_id, type FROM cfg WHERE (tenant_id, type) > ({after}) ORDER BY tenant_id, type LIMIT {limit + 1}",
    )


@query("h1_first_page", _page_sql(50, "'', ''"))
def _(t):
    return C.list_configs(t.configs).select("tenant_id", "type", "last_key")


@query("h1_next_page", _page_sql(20, "'tenant-110', 'cloudwatch'"))
def _(t):
    return C.list_configs(t.configs, 20, "tenant-110#cloudwatch").select("tenant_id", "type", "last_key")


@query("h1_last_page", _page_sql(500, "'tenant-99', 'cloudwatch'"))
def _(t):
    return C.list_configs(t.configs, 500, "tenant-99#cloudwatch").select("tenant_id", "type", "last_key")


GROUP_SQL = " UNION ALL ".join(
    f"SELECT '{g}' AS group_name, unnest([{', '.join(repr(a) for a in apps)}]) AS application" for g, apps in APPLICATION_GROUPS.items()
)


def _groups(t):
    """The published groups, as a table built by Spark."""
    rows = [(g, a) for g, apps in APPLICATION_GROUPS.items() for a in apps]
    return t.spark.createDataFrame(rows, "group_name string, application string")


@query(
    "h4_expand_groups",
    oracle(
        """SELECT tenant_id, type, CASE WHEN len(extra) > 0 THEN array_to_string(list_sort(list_distinct(list_concat(COALESCE(desired_logs, []), extra))), '|')
            ELSE array_to_string(desired_logs, '|') END AS desired_logs
        FROM (SELECT tenant_id, type, any_value(desired_logs) AS desired_logs, list(application) FILTER (WHERE application IS NOT NULL) AS extra
          FROM (SELECT tenant_id, type, desired_logs, g.application FROM (SELECT tenant_id, type, desired_logs, unnest(CASE WHEN groups IS NULL THEN [NULL] ELSE groups END) AS gn FROM cfg) c
            LEFT JOIN app_groups g ON lower(g.group_name) = lower(c.gn)) GROUP BY tenant_id, type)""",
        "cfg", app_groups=GROUP_SQL,
    ),
)
def _(t):
    expanded, _warnings = C.expand_groups(t.configs, _groups(t))
    return expanded.select("tenant_id", "type", F.array_join("desired_logs", "|").alias("desired_logs"))


@query("h4_unknown_groups", oracle("SELECT tenant_id, type, 'nosuch' AS group_name FROM cfg WHERE k % 9 = 1", "cfg"))
def _(t):
    return C.expand_groups(t.configs, _groups(t))[1]


NEW = """SELECT 'tenant-' || (c_custkey // 3 * 5) AS tenant_id, CASE WHEN c_custkey % 2 = 0 THEN 's3' ELSE 'cloudwatch' END AS type, c_custkey AS request_no,
    CASE WHEN c_custkey % 4 = 0 THEN false END AS enabled, 'b-' || c_custkey AS bucket_name FROM customer"""


def _requests(t):
    """Change requests from the customer table; several hit the same key."""
    k = F.col("c_custkey")
    tenant = text("tenant-", (F.floor(k / 3) * 5).cast("string"))
    base = t.given("customer").select(
        tenant.alias("tenant_id"),
        F.when(k % 2 == 0, "s3").otherwise("cloudwatch").alias("type"),
        k.alias("request_no"),
        F.when(k % 4 == 0, False).alias("enabled"),
        text("b-", k.cast("string")).alias("bucket_name"),
    )
    blank = {"desired_logs": "array<string>", "groups": "array<string>", "target_region": "string",
             "log_distribution_role_arn": "string", "log_group_name": "string", "bucket_prefix": "string", "ttl": "bigint"}
    return base.select("*", *[F.lit(None).cast(kind).alias(name) for name, kind in blank.items()])


@query(
    "m1_create_table",
    oracle(
        """SELECT tenant_id, type, enabled, bucket_name, created_ms, created_ms AS updated_ms FROM cfg
        UNION ALL SELECT tenant_id, type, COALESCE(enabled, true), bucket_name, 1706659200000, 1706659200000
        FROM (SELECT *, row_number() OVER (PARTITION BY tenant_id, type ORDER BY request_no) AS rn FROM new)
        WHERE rn = 1 AND (tenant_id, type) NOT IN (SELECT (tenant_id, type) FROM cfg)""",
        "cfg", new=NEW,
    ),
)
def _(t):
    table, _outcome = C.create_configs(t.configs, _requests(t), AS_OF_MS)
    return table.select("tenant_id", "type", "enabled", "bucket_name", F.unix_millis("created_at").alias("created_ms"),
                        F.unix_millis("updated_at").alias("updated_ms"))


@query(
    "m1_create_outcome",
    oracle(
        """SELECT tenant_id, type, request_no, CASE WHEN rn = 1 AND NOT taken THEN 'created' ELSE 'already_exists' END AS outcome
        FROM (SELECT n.*, c.k IS NOT NULL AS taken, row_number() OVER (PARTITION BY n.tenant_id, n.type ORDER BY request_no) AS rn
              FROM new n LEFT JOIN cfg c USING (tenant_id, type))""",
        "cfg", new=NEW,
    ),
)
def _(t):
    return C.create_configs(t.configs, _requests(t), AS_OF_MS)[1]


@query(
    "m2_update_table",
    oracle(
        """SELECT c.tenant_id, c.type, COALESCE(f.enabled, c.enabled) AS enabled, COALESCE(f.bucket_name, c.bucket_name) AS bucket_name,
        CASE WHEN f.tenant_id IS NOT NULL THEN 1706659200000 ELSE c.created_ms END AS updated_ms
        FROM cfg c LEFT JOIN (SELECT tenant_id, type, arg_max(enabled, request_no) FILTER (WHERE enabled IS NOT NULL) AS enabled,
            arg_max(bucket_name, request_no) AS bucket_name FROM new GROUP BY tenant_id, type) f USING (tenant_id, type)""",
        "cfg", new=NEW,
    ),
)
def _(t):
    table, _outcome = C.update_configs(t.configs, _requests(t), AS_OF_MS)
    return table.select("tenant_id", "type", "enabled", "bucket_name", F.unix_millis("updated_at").alias("updated_ms"))


@query(
    "m2_patch_table",
    oracle(
        """SELECT c.tenant_id, c.type, COALESCE(f.enabled, c.enabled) AS enabled, c.bucket_name
        FROM cfg c LEFT JOIN (SELECT tenant_id, type, arg_max(enabled, request_no) FILTER (WHERE enabled IS NOT NULL) AS enabled FROM new GROUP BY tenant_id, type) f USING (tenant_id, type)""",
        "cfg", new=NEW,
    ),
)
def _(t):
    return C.patch_configs(t.configs, _requests(t), AS_OF_MS)[0].select("tenant_id", "type", "enabled", "bucket_name")


@query(
    "m2_update_outcome",
    oracle(
        "SELECT n.tenant_id, n.type, n.request_no, CASE WHEN c.k IS NULL THEN 'not_found' ELSE 'updated' END AS outcome FROM new n LEFT JOIN cfg c USING (tenant_id, type)",
        "cfg", new=NEW,
    ),
)
def _(t):
    return C.update_configs(t.configs, _requests(t), AS_OF_MS)[1]


@query(
    "m3_delete_table",
    oracle("SELECT tenant_id, type FROM cfg WHERE (tenant_id, type) NOT IN (SELECT (tenant_id, type) FROM new)", "cfg", new=NEW),
)
def _(t):
    return C.delete_configs(t.configs, _requests(t))[0].select("tenant_id", "type")


STORE_STEPS = {
    "c1": """SELECT tenant_id, type, enabled, bucket_name FROM cfg
        UNION ALL SELECT tenant_id, type, COALESCE(enabled, true), bucket_name FROM (SELECT *, row_number() OVER (PARTITION BY tenant_id, type ORDER BY request_no) AS rn FROM new WHERE request_no % 3 = 0)
        WHERE rn = 1 AND (tenant_id, type) NOT IN (SELECT (tenant_id, type) FROM cfg)""",
    "c2": """SELECT c.tenant_id, c.type, COALESCE(f.enabled, c.enabled) AS enabled, COALESCE(f.bucket_name, c.bucket_name) AS bucket_name
        FROM c1 c LEFT JOIN (SELECT tenant_id, type, arg_max(enabled, request_no) FILTER (WHERE enabled IS NOT NULL) AS enabled,
            arg_max(bucket_name, request_no) AS bucket_name FROM new WHERE request_no % 3 = 1 GROUP BY tenant_id, type) f USING (tenant_id, type)""",
    "c3": "SELECT * FROM c2 WHERE (tenant_id, type) NOT IN (SELECT (tenant_id, type) FROM new WHERE request_no % 3 = 2 AND request_no % 5 = 0)",
}


@query(
    "m1_m3_config_store",
    oracle(
        "SELECT unnest(['logged', 'compacted']) AS state, * FROM c3 UNION ALL SELECT 'before deletes', * FROM c2 UNION ALL SELECT 'loaded', tenant_id, type, enabled, bucket_name FROM cfg",
        "cfg", new=NEW, **STORE_STEPS,
    ),
)
def _(t):
    store, requests = ConfigStore(t.spark, scratch_path(t.spark, "configs"), slots=16), _requests(t)
    store.load(t.configs, AS_OF_MS)
    store.create(requests.where("request_no % 3 = 0"), AS_OF_MS)
    store.update(requests.where("request_no % 3 = 1"), AS_OF_MS)
    store.delete(requests.where("request_no % 3 = 2 AND request_no % 5 = 0"), AS_OF_MS)
    shown = lambda df, state: df.select(F.lit(state).alias("state"), "tenant_id", "type", "enabled", "bucket_name")
    logged = shown(store.current(), "logged")
    store.compact(AS_OF_MS)
    return logged.union(shown(store.current(), "compacted")).union(shown(store.current(2), "before deletes")).union(shown(store.current(0), "loaded"))


@query(
    "m3_delete_outcome",
    oracle(
        "SELECT n.tenant_id, n.type, CASE WHEN c.k IS NULL THEN 'not_found' ELSE 'deleted' END AS outcome FROM (SELECT DISTINCT tenant_id, type FROM new) n LEFT JOIN cfg c USING (tenant_id, type)",
        "cfg", new=NEW,
    ),
)
def _(t):
    return C.delete_configs(t.configs, _requests(t))[1]


@query(
    "m4_lookup",
    oracle("SELECT tenant_id, type, bucket_name, log_group_name FROM cfg WHERE tenant_id = 'tenant-42' OR (tenant_id = 'tenant-43' AND type = 's3')", "cfg"),
)
def _(t):
    found = C.get_configs(t.configs, "tenant-42").unionByName(C.get_configs(t.configs, "tenant-43", "s3"))
    return found.select("tenant_id", "type", "bucket_name", "log_group_name")


@query(
    "m5_validation_report",
    oracle(
        r"""SELECT tenant_id, type, bool_and(status = 'ok') OVER (PARTITION BY tenant_id, type) AS valid, field, status, message FROM (
          SELECT tenant_id, type, unnest(['tenant_id', 'type']) AS field, 'ok' AS status, unnest(['Field tenant_id is present', 'Field type is present']) AS message FROM cfg
          UNION ALL SELECT tenant_id, type, field, CASE WHEN v = '' THEN 'missing' ELSE 'ok' END,
            CASE WHEN v = '' THEN 'Required ' || label || ' field ' || field || ' is missing or empty' ELSE label || ' field ' || field || ' is present' END
          FROM (SELECT tenant_id, type, 'CloudWatch' AS label, unnest(['log_distribution_role_arn', 'log_group_name']) AS field,
                  unnest([COALESCE(log_distribution_role_arn, ''), COALESCE(log_group_name, '')]) AS v FROM cfg WHERE type = 'cloudwatch'
                UNION ALL SELECT tenant_id, type, 'S3', 'bucket_name', COALESCE(bucket_name, '') FROM cfg WHERE type = 's3')
          UNION ALL SELECT tenant_id, type, 'log_distribution_role_arn', 'invalid', 'Role ARN format is invalid' FROM cfg
            WHERE type = 'cloudwatch' AND log_distribution_role_arn <> '' AND NOT starts_with(log_distribution_role_arn, 'arn:aws:iam::')
          UNION ALL SELECT tenant_id, type, 'bucket_name', 'invalid', 'S3 bucket name format appears invalid' FROM cfg WHERE type = 's3' AND contains(bucket_name, '$')
          UNION ALL SELECT tenant_id, type, 'target_region', 'invalid', 'Target region format appears invalid' FROM cfg WHERE contains(target_region, '!'))""",
        "cfg",
    ),
)
def _(t):
    return C.validate_configs(t.configs).drop("check_no")


@query(
    "m6_refused_requests",
    oracle(
        r"""SELECT tenant_id, type, problem FROM (SELECT *, CASE WHEN NOT regexp_matches(tenant_id, '^[\p{L}\p{N}_-]+$') THEN 'tenant_id' WHEN type NOT IN ('cloudwatch', 's3') THEN 'type'
            WHEN log_distribution_role_arn IS NOT NULL AND NOT starts_with(log_distribution_role_arn, 'arn:aws:iam::') THEN 'log_distribution_role_arn'
            WHEN contains(bucket_name, '$') THEN 'bucket_name' WHEN list_contains(desired_logs, '') THEN 'desired_logs'
            WHEN type = 's3' AND COALESCE(bucket_name, '') = '' THEN 'missing bucket_name' END AS problem
          FROM (SELECT * EXCLUDE (tenant_id, type), CASE WHEN k % 37 = 0 THEN tenant_id || ' x' ELSE tenant_id END AS tenant_id, CASE WHEN k % 41 = 0 THEN 'ftp' ELSE type END AS type FROM cfg))
        WHERE problem IS NOT NULL""",
        "cfg",
    ),
)
def _(t):
    return C.validate_requests(_spoiled(t)).select("tenant_id", "type", "problem")


@query(
    "m6_refused_updates",
    oracle(
        """SELECT tenant_id, type, problem FROM (SELECT tenant_id, type, CASE WHEN log_distribution_role_arn IS NOT NULL AND NOT starts_with(log_distribution_role_arn, 'arn:aws:iam::') THEN 'log_distribution_role_arn'
            WHEN contains(target_region, '!') OR target_region = '' THEN 'target_region' WHEN list_contains(desired_logs, '') THEN 'desired_logs' END AS problem FROM cfg)
        WHERE problem IS NOT NULL""",
        "cfg",
    ),
)
def _(t):
    return C.validate_requests(t.configs, "update").select("tenant_id", "type", "problem")


def _spoiled(t):
    k = F.substring_index("tenant_id", "-", -1).cast("int")
    return t.configs.withColumn("_k", k).withColumns(
        {
            "tenant_id": F.when(F.col("_k") % 37 == 0, text(F.col("tenant_id"), " x")).otherwise(F.col("tenant_id")),
            "type": F.when(F.col("_k") % 41 == 0, "ftp").otherwise(F.col("type")),
        }
    )
