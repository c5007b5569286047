"""Queries of sources, routing joins, aggregations and the queue."""

from __future__ import annotations

from pyspark.sql import functions as F


from tributary.operators import accounting as A
from tributary.operators import configs as C
from tributary.operators import delivery as D
from tributary.operators import queue as Q
from tributary.operators import routing as RT
from tributary.operators.health import object_counts, storage_stats
from tributary.operators.records import parse_stats
from tributary.plans.catalog_fields import DST_KEY, JSON_TIME, TEXT_TIME
from tributary.plans.derive import AS_OF_MS, text
from tributary.plans.oracle import oracle
from tributary.plans.pipeline import attempts_of, message_results, route_summary
from tributary.plans.registry import query
from tributary.sources import configs as SC
from tributary.sources import notifications as N
from tributary.sources import objects as O
from tributary.sources import pods as P

# -- the flagship: event time + key check + routing + count ---------------------------------------

@query(
    "route_summary",
    oracle(
        f"""SELECT r.tenant_id, r.type, r.application, count(*) AS events, min(e.ms) AS first_event_ms, max(e.ms) AS last_event_ms
        FROM (SELECT object_key, COALESCE({TEXT_TIME}, {JSON_TIME}, ingest_ms) AS ms FROM raw) e JOIN routed r USING (object_key)
        GROUP BY ALL""",
        "routed",
    ),
)
def _(t):
    return route_summary(t.raw, t.routable, AS_OF_MS)


# -- sources --------------------------------------------------------------------------------------

NOTE_COLUMNS = """message_id, record_idx, bucket, object_key, "offset", retry_count, error_code,
    CASE WHEN error_code = 'invalid_metadata' THEN 'recoverable' WHEN error_code IS NOT NULL THEN 'non_recoverable' END AS error_class"""


@query("a2_notifications", oracle(f"SELECT {NOTE_COLUMNS} FROM notes", "notes"))
def _(t):
    parsed = N.parse_notifications(t.messages.select("message_id", "body"))
    return parsed.select(
        "message_id", "record_idx", "bucket", "object_key", "offset", "retry_count", "error_code", "error_class"
    )


@query(
    "a3_new_objects",
    oracle("SELECT object_key FROM listing WHERE object_key LIKE '%.json.gz' AND eid % 3 <> 0", "listing"),
)
def _(t):
    ledger = t.listing.filter("eid % 3 = 0").select("object_key")
    return O.scan_new_objects(t.listing, ledger).select("object_key")


@query(
    "a4_message_actions",
    oracle(
        "SELECT message_id, CASE WHEN bool_or(COALESCE(error_code = 'invalid_metadata', false)) THEN 'retry' ELSE 'delete' END AS action FROM notes GROUP BY message_id",
        "notes",
    ),
)
def _(t):
    return A.message_actions(N.parse_notifications(t.messages.select("message_id", "body")))


@query(
    "a5_manual_input",
    oracle(
        "SELECT 'manual-input' AS message_id, COALESCE(error_code, 'none') AS outcome, count(*) AS records, count(object_key) AS keys FROM notes GROUP BY ALL",
        "notes",
    ),
)
def _(t):
    parsed = N.manual_messages(t.messages.select("body"))
    return parsed.groupBy("message_id", F.coalesce("error_code", F.lit("none")).alias("outcome")).agg(
        F.count("*").alias("records"), F.count("object_key").alias("keys")
    )


@query(
    "a7_decode_items",
    oracle(
        """SELECT tenant_id, type, enabled, array_to_string(desired_logs, '|') AS desired_logs, bucket_name, ttl FROM cfg""",
        "cfg",
    ),
)
def _(t):
    def s(col):
        return F.struct(F.col(col).alias("S"), F.lit(None).cast("boolean").alias("BOOL"), F.lit(None).cast("string").alias("N"),
                        F.lit(None).cast("array<struct<S:string>>").alias("L"), F.lit(None).cast("array<string>").alias("SS")).alias(col)

    def tagged(col, tag):
        empty = {"S": "string", "BOOL": "boolean", "N": "string", "L": "array<struct<S:string>>", "SS": "array<string>"}
        return F.struct(*[(tag[n] if n in tag else F.lit(None).cast(ty)).alias(n) for n, ty in empty.items()]).alias(col)

    odd = F.substring_index("tenant_id", "-", -1).cast("int") % 2 == 1
    listed = F.transform("desired_logs", lambda x: F.struct(x.alias("S")))
    logs = tagged("desired_logs", {"L": F.when(odd, listed), "SS": F.when(~odd, F.col("desired_logs"))})
    items = t.configs.select(
        F.struct(
            *[s(c) for c in SC.TEXT_FIELDS], logs, tagged("groups", {"SS": F.col("groups")}),
            tagged("enabled", {"BOOL": F.col("enabled")}), tagged("ttl", {"N": F.col("ttl").cast("string")}),
        ).alias("item")
    )
    plain = SC.decode_items(items)
    return plain.select("tenant_id", "type", "enabled", F.array_join("desired_logs", "|").alias("desired_logs"), "bucket_name", "ttl")


@query("a8_labelled_namespaces", oracle("SELECT event_id, pod FROM pods WHERE hosted = 'true'", "pods"))
def _(t):
    return P.select_labelled(t.pods, "hosted", "true").select("event_id", F.col("kubernetes.pod_name").alias("pod"))


@query(
    "a9_partial_lines",
    oracle(
        """SELECT conv_id, run, string_agg(text, '' ORDER BY turn) AS line, count(*) AS pieces FROM (
          SELECT *, COALESCE(sum(CASE WHEN partial THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS run
          FROM (SELECT *, (turn + conv_id) % 3 <> 2 AS partial FROM conversations)) GROUP BY conv_id, run"""
    ),
)
def _(t):
    pieces = t.given("conversations").withColumn("partial", (F.col("turn") + F.col("conv_id")) % 3 != 2)
    return P.merge_partial_lines(pieces, ["conv_id"], ["turn"], "partial", "text").withColumnRenamed("text", "line")


@query(
    "s17_processing_metadata",
    oracle(
        """SELECT message_id, "offset", retry_count, error_code = 'invalid_metadata' AND error_code IS NOT NULL AS metadata_error FROM (
        SELECT message_id, "offset", retry_count, CASE WHEN env IS NOT NULL AND mt IS NOT NULL AND mt <> 'OBJECT' THEN 'invalid_metadata' ELSE '' END AS error_code FROM judged)""",
        "judged",
    ),
)
def _(t):
    return N.with_processing_metadata(t.messages).select("message_id", "offset", "retry_count", "metadata_error")


# -- sinks as tables ------------------------------------------------------------------------------

@query(
    "b2_copy_plan",
    oracle(
        f"""SELECT 'central-logs/' || object_key AS copy_source, bucket_name AS dst_bucket, {DST_KEY} AS dst_key,
        'bucket-owner-full-control' AS acl, 6 AS metadata_entries FROM routed WHERE type = 's3'""",
        "routed",
    ),
)
def _(t):
    plan = D.plan_object_copies(t.routed, AS_OF_MS)
    return plan.select("copy_source", "dst_bucket", "dst_key", "acl", F.size("metadata").alias("metadata_entries"))


# -- joins ----------------------------------------------------------------------------------------

@query("e1_route", oracle("SELECT object_key, tenant_id, type, application FROM routed", "routed"))
def _(t):
    return t.routed.select("object_key", "tenant_id", "type", "application")


@query("e1_route_salted", oracle("SELECT object_key, tenant_id, type, application FROM routed", "routed"))
def _(t):
    return RT.route(t.objects, t.routable, salt=8).select("object_key", "tenant_id", "type", "application")


@query(
    "e2_unroutable",
    oracle(
        """SELECT object_key, tenant_id, CASE WHEN s.any_enabled IS NULL THEN 'no_config' WHEN NOT s.any_enabled THEN 'none_enabled' ELSE 'invalid_config' END AS reason
        FROM info LEFT JOIN (SELECT tenant_id, bool_or(COALESCE(enabled, false)) AS any_enabled FROM cfg WHERE ttl IS NULL OR ttl > 1706659200 GROUP BY tenant_id) s USING (tenant_id)
        WHERE tenant_id NOT IN (SELECT tenant_id FROM routable)""",
        "info",
        "routable",
    ),
)
def _(t):
    found = RT.unroutable(t.objects, C.unexpired_configs(t.configs, AS_OF_MS), t.routable)
    return found.select("object_key", "tenant_id", "reason")


@query(
    "e3_empty_tenant",
    oracle("SELECT object_key, '' AS tenant_id, 'empty_tenant' AS reason FROM listing WHERE contains(object_key, '//')", "listing"),
)
def _(t):
    named = RT.extract_tenant_info(t.listing)
    return RT.unroutable(named, t.configs, t.routable).filter("reason = 'empty_tenant'").select("object_key", "tenant_id", "reason")


@query("e4_valid_tenants", oracle("SELECT tenant_id, type FROM routable", "routable"))
def _(t):
    return t.routable.select("tenant_id", "type")


@query("e5_route_exploded", oracle("SELECT object_key, tenant_id, type, application FROM routed", "routed"))
def _(t):
    return RT.route_exploded(t.objects, t.routable).select("object_key", "tenant_id", "type", "application")


@query(
    "e6_missing_destinations",
    oracle(
        """SELECT DISTINCT log_group_name AS log_group, pod_name AS log_stream FROM routed WHERE type = 'cloudwatch'
        AND NOT (pod_name LIKE 'oauth-server-%' AND length(tenant_id) % 2 = 1)""",
        "routed",
    ),
)
def _(t):
    streams = RT.event_destination(t.routed.filter("type = 'cloudwatch'"))
    inventory = streams.filter(F.col("pod_name").startswith("oauth-server-") & (F.length("tenant_id") % 2 == 1))
    return RT.missing_destinations(t.routed, inventory)


@query(
    "e7_ledger",
    oracle("SELECT object_key FROM listing WHERE eid % 3 = 0 OR eid % 5 <> 1", "listing"),
)
def _(t):
    ledger = t.listing.filter("eid % 3 = 0").select("object_key")
    results = t.listing.select("object_key", (F.col("eid") % 5 != 1).alias("succeeded"))
    return O.update_ledger(ledger, results)


@query(
    "e8_reconcile",
    oracle(
        """SELECT COALESCE(p.dst_key, d.dst_key) AS dst_key, COALESCE(p.n, 0) AS planned, COALESCE(d.n, 0) AS delivered,
        CASE WHEN d.n IS NULL THEN 'missing' WHEN p.n IS NULL THEN 'unexpected' ELSE 'delivered' END AS status
        FROM (SELECT dst_key, count(*) AS n FROM plan GROUP BY dst_key) p
        FULL JOIN (SELECT CASE WHEN eid % 11 = 0 THEN dst_key || '.extra' ELSE dst_key END AS dst_key, count(*) AS n FROM plan WHERE eid % 7 <> 0 GROUP BY 1) d USING (dst_key)""",
        "routed",
        plan=f"SELECT eid, {DST_KEY} AS dst_key FROM routed WHERE type = 's3'",
    ),
)
def _(t):
    plan = D.with_destination_key(t.routed.filter("type = 's3'"))
    key = F.when(F.col("eid") % 11 == 0, text(F.col("dst_key"), ".extra")).otherwise(F.col("dst_key"))
    delivered = plan.filter("eid % 7 <> 0").select(key.alias("dst_key"))
    return RT.reconcile(plan, delivered, ["dst_key"])


@query(
    "e8_reconcile_by_digest",
    oracle(
        """SELECT COALESCE(p.dst_key, d.dst_key) AS dst_key, COALESCE(p.n, 0) AS planned, COALESCE(d.n, 0) AS delivered,
        CASE WHEN d.n IS NULL THEN 'missing' WHEN p.n IS NULL THEN 'unexpected' ELSE 'delivered' END AS status, true AS ranges_bounded
        FROM (SELECT dst_key, count(*) AS n FROM plan GROUP BY dst_key) p
        FULL JOIN (SELECT CASE WHEN eid % 211 = 0 THEN dst_key || '.extra' ELSE dst_key END AS dst_key, count(*) AS n FROM plan WHERE eid % 97 <> 0 GROUP BY 1) d USING (dst_key)
        WHERE COALESCE(p.n, 0) <> COALESCE(d.n, 0)""",
        "routed",
        plan=f"SELECT eid, {DST_KEY} AS dst_key FROM routed WHERE type = 's3'",
    ),
)
def _(t):
    # Few deliveries are missing or unexpected: no more ranges are compared than keys differ.
    plan = D.with_destination_key(t.routed.filter("type = 's3'"))
    key = F.when(F.col("eid") % 211 == 0, text(F.col("dst_key"), ".extra")).otherwise(F.col("dst_key"))
    delivered = plan.filter("eid % 97 <> 0").select(key.alias("dst_key"))
    found, ranges = RT.reconcile_by_digest(plan.select("dst_key"), delivered, ["dst_key"])
    bound = ranges.agg(F.count("*").alias("open")).crossJoin(found.agg(F.count("*").alias("differing")))  # one row each
    return found.crossJoin(bound.select((F.col("open") <= F.col("differing")).alias("ranges_bounded")))


# -- aggregations ---------------------------------------------------------------------------------

# Outcome rule of the demo: what would have failed at the destination.
ATTEMPTS = """SELECT object_key, tenant_id, type, eid % 6 <> 0 AS succeeded, modified_ms AS upload_ms, modified_ms + 1000 + eid % 977 AS delivered_ms, eid
    FROM routed"""
RESULTS = """SELECT n.message_id, min(CASE WHEN n.error_code = 'invalid_metadata' THEN 'recoverable' WHEN n.error_code IS NOT NULL THEN 'non_recoverable' END) AS error_class,
    count(a.object_key) FILTER (WHERE a.succeeded) AS successful_deliveries, count(a.object_key) FILTER (WHERE NOT a.succeeded) AS failed_deliveries
    FROM notes n LEFT JOIN attempts a ON n.object_key = a.object_key GROUP BY n.message_id"""


@query(
    "f1_batch_summary",
    oracle(
        """SELECT count(*) FILTER (WHERE error_class IS NULL) AS successful_records, count(*) FILTER (WHERE error_class = 'recoverable') AS failed_records,
        count(*) FILTER (WHERE error_class = 'non_recoverable') AS undeliverable_records,
        sum(successful_deliveries) FILTER (WHERE error_class IS NULL)::BIGINT AS successful_deliveries,
        sum(failed_deliveries) FILTER (WHERE error_class IS NULL)::BIGINT AS failed_deliveries FROM results""",
        "notes",
        "routed",
        attempts=ATTEMPTS,
        results=RESULTS,
    ),
)
def _(t):
    return A.batch_summary(message_results(t))


@query(
    "f2_batch_item_failures",
    oracle("SELECT message_id AS item_identifier FROM notes WHERE error_code = 'invalid_metadata'", "notes"),
)
def _(t):
    return A.batch_item_failures(message_results(t))


@query(
    "t5_partial_batch_failure",
    oracle(
        """SELECT m.message_id, m.receive_count + 1 AS receive_count, 1706659200000 + 900000 AS visible_ms FROM msgs m JOIN notes n USING (message_id)
        WHERE n.error_code = 'invalid_metadata' AND m.visible_ms <= 1706659200000""",
        "notes",
    ),
)
def _(t):
    received = Q.receive(t.messages, AS_OF_MS)
    failed = A.batch_item_failures(message_results(t))
    kept = received.join(failed, received.message_id == failed.item_identifier, "left_semi")
    return kept.select("message_id", "receive_count", "visible_ms")


@query(
    "f3_delivery_stats",
    oracle("SELECT message_id, successful_deliveries, failed_deliveries FROM results WHERE successful_deliveries + failed_deliveries > 0", "notes", "routed",
           attempts=ATTEMPTS, results=RESULTS),
)
def _(t):
    notes = N.parse_notifications(t.messages.select("message_id", "body")).filter("object_key is not null")
    return A.delivery_stats(notes.select("message_id", "object_key").join(attempts_of(t.routed), "object_key"))


# Three batches per object with made-up rejection indexes and call failures.
BATCHES = """SELECT object_key, b::BIGINT AS batch_id, 10 + eid % 5 AS events, CASE WHEN (eid + b) % 5 = 0 THEN 7 END AS too_new_start,
    CASE WHEN (eid + b) % 4 = 0 THEN 1 END AS too_old_end, CASE WHEN (eid + b) % 9 = 0 THEN 3 END AS expired_end, (eid + b) % 13 = 0 AS failed
    FROM listing, (SELECT unnest([0, 1, 2]) AS b)"""
REJECTED = """SELECT *, COALESCE(events - too_new_start, 0) + COALESCE(too_old_end + 1, 0) + COALESCE(expired_end + 1, 0) AS rejected FROM batches"""


def _batches(t):
    b, eid = F.col("batch_id"), F.col("eid")
    rows = t.listing.select("object_key", "eid", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(2).cast("bigint"))).alias("batch_id"))
    return rows.select(
        "object_key", "batch_id", (eid % 5 + 10).alias("events"),
        F.when((eid + b) % 5 == 0, 7).cast("bigint").alias("too_new_start"),
        F.when((eid + b) % 4 == 0, 1).cast("bigint").alias("too_old_end"),
        F.when((eid + b) % 9 == 0, 3).cast("bigint").alias("expired_end"),
        ((eid + b) % 13 == 0).alias("failed"),
    )


@query(
    "f5_rejections",
    oracle(
        "SELECT object_key, batch_id, rejected, greatest(0, events - rejected) AS successful_events, greatest(0, rejected) AS failed_events FROM rej",
        "listing", batches=BATCHES, rej=REJECTED,
    ),
)
def _(t):
    return A.rejection_stats(_batches(t)).select("object_key", "batch_id", "rejected", "successful_events", "failed_events")


EVENT_STATS = """SELECT object_key,
    COALESCE(sum(CASE WHEN stop IS NULL OR batch_id < stop THEN greatest(0, events - rejected) END), 0)::BIGINT AS successful_events,
    COALESCE(sum(CASE WHEN stop IS NULL OR batch_id < stop THEN rejected WHEN batch_id = stop THEN events END), 0)::BIGINT AS failed_events,
    COALESCE(sum(CASE WHEN stop IS NULL OR batch_id <= stop THEN events END), 0)::BIGINT AS total_processed
    FROM (SELECT *, min(CASE WHEN failed THEN batch_id END) OVER (PARTITION BY object_key) AS stop FROM rej) GROUP BY object_key"""


@query("f4_event_stats", oracle("SELECT * FROM stats", "listing", batches=BATCHES, rej=REJECTED, stats=EVENT_STATS))
def _(t):
    return A.event_stats(A.rejection_stats(_batches(t)), ["object_key"])


@query(
    "t7_late_events",
    oracle(
        """SELECT object_key, count(*) AS events, count(*) FILTER (WHERE age > 1209600000) AS too_old, count(*) FILTER (WHERE age < -7200000) AS too_new,
        count(*) FILTER (WHERE age > 1209600000 OR age < -7200000) = 0 AS delivered
        FROM (SELECT object_key, 1705600000000 - event_ts_ms AS age FROM ev) GROUP BY object_key""",
        "ev",
    ),
)
def _(t):
    return A.late_events(t.events, 1_705_600_000_000, ["object_key"])


@query(
    "f7_parse_stats",
    oracle(
        """SELECT object_key, count(*) FILTER (WHERE ok) AS lines_ok, count(*) FILTER (WHERE NOT ok) AS lines_error, COALESCE(any_value(n), 0) AS events
        FROM parsed LEFT JOIN (SELECT object_key, count(*) AS n FROM records WHERE json_type(rec) = 'OBJECT' GROUP BY object_key) USING (object_key) GROUP BY object_key""",
        "records",
    ),
)
def _(t):
    return parse_stats(t.records)


METRIC = "SELECT tenant_id AS tenant, 'LogCount/' || method || '/' || name AS metric, value::DOUBLE AS value, 'Count' AS unit, ts_ms FROM m WHERE value IS NOT NULL"


@query(
    "f8_event_metrics",
    oracle(
        METRIC, "listing", "info", batches=BATCHES, rej=REJECTED, stats=EVENT_STATS,
        m="""SELECT tenant_id, 'cloudwatch' AS method, modified_ms AS ts_ms, unnest(['successful_events', 'failed_events', 'successful_delivery', 'failed_delivery']) AS name,
          unnest([successful_events, failed_events, CASE WHEN failed_events = 0 AND successful_events > 0 THEN 1 END, CASE WHEN failed_events > 0 THEN 1 END]) AS value
          FROM stats JOIN info USING (object_key)""",
    ),
)
def _(t):
    stats = A.event_stats(A.rejection_stats(_batches(t)), ["object_key"])
    timed = stats.join(t.objects.select("object_key", "tenant_id", F.timestamp_millis("upload_ms").alias("ts")), "object_key")
    return A.event_delivery_metrics(timed).select("tenant", "metric", "value", "unit", F.unix_millis("ts").alias("ts_ms"))


@query(
    "f8_reported_stats",
    oracle(
        """SELECT object_key, CASE WHEN failed_events = 0 THEN successful_events ELSE 0 END::BIGINT AS successful_events,
        CASE WHEN failed_events = 0 THEN 0 ELSE n END::BIGINT AS failed_events FROM stats JOIN (SELECT object_key, sum(events) AS n FROM batches GROUP BY object_key) USING (object_key)""",
        "listing", batches=BATCHES, rej=REJECTED, stats=EVENT_STATS,
    ),
)
def _(t):
    batches = _batches(t)
    planned = batches.groupBy("object_key").agg(F.sum("events").alias("events"))
    stats = A.event_stats(A.rejection_stats(batches), ["object_key"]).join(planned, "object_key")
    return A.reported_stats(stats).select("object_key", "successful_events", "failed_events")


@query(
    "t3_event_failures",
    oracle(
        "SELECT object_key, tenant_id FROM attempts WHERE type = 'cloudwatch' AND NOT succeeded", "routed", attempts=ATTEMPTS
    ),
)
def _(t):
    return Q.event_failures(attempts_of(t.routed)).select("object_key", "tenant_id")


@query(
    "f9_object_metrics",
    oracle(
        METRIC, "routed", attempts=ATTEMPTS,
        m="SELECT tenant_id, 's3' AS method, CASE WHEN succeeded THEN 'successful_delivery' ELSE 'failed_delivery' END AS name, 1 AS value, delivered_ms AS ts_ms FROM attempts WHERE type = 's3'",
    ),
)
def _(t):
    tries = attempts_of(t.routed).filter("type = 's3'")
    return A.object_delivery_metrics(tries).select("tenant", "metric", "value", "unit", F.unix_millis("ts").alias("ts_ms"))


@query(
    "f10_latency_metrics",
    oracle(
        METRIC, "routed", attempts=ATTEMPTS,
        m="SELECT tenant_id, type AS method, 'delivery_latency' AS name, delivered_ms - upload_ms AS value, delivered_ms AS ts_ms FROM attempts WHERE succeeded",
    ),
)
def _(t):
    return A.latency_metrics(attempts_of(t.routed)).select("tenant", "metric", "value", "unit", F.unix_millis("ts").alias("ts_ms"))


@query(
    "b4_metrics_table",
    oracle(
        """SELECT 'HCPLF/LogForwarding' AS namespace, metric, tenant, sum(value)::DOUBLE AS value, count(*) AS samples FROM (
          SELECT tenant_id AS tenant, 'LogCount/' || type || '/' || CASE WHEN succeeded THEN 'successful_delivery' ELSE 'failed_delivery' END AS metric, 1 AS value FROM attempts WHERE type = 's3'
          UNION ALL SELECT tenant_id, 'LogCount/' || type || '/delivery_latency', delivered_ms - upload_ms FROM attempts WHERE succeeded) GROUP BY ALL""",
        "routed", attempts=ATTEMPTS,
    ),
)
def _(t):
    from tributary.session import scratch_path
    from tributary.sinks.tables import write_metrics

    tries = attempts_of(t.routed)
    path = scratch_path(t.spark, "metrics")
    write_metrics(A.object_delivery_metrics(tries.filter("type = 's3'")), path)
    write_metrics(A.latency_metrics(tries), path)
    return t.spark.read.parquet(path).groupBy("namespace", "metric", "tenant").agg(
        F.sum("value").alias("value"), F.count("*").alias("samples")
    )


def _period_sql(seconds: int) -> str:
    return oracle(
        f"""SELECT ts_s // {seconds} * {seconds} AS period_s, event_type AS metric, 'tenant-' || user_id AS tenant,
        sum(CAST(value * 100 AS BIGINT))::BIGINT AS sum_cents, max(value) AS maximum, count(*) AS samples, round(avg(value), 6) AS average FROM raw0 GROUP BY ALL""",
        "raw0",
    )


def _period_job(seconds: int):
    def job(t):
        ev = t.given("events")
        metrics = ev.select(
            F.timestamp_micros(F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")).alias("ts"),
            F.col("event_type").alias("metric"), text("tenant-", F.col("user_id").cast("string")).alias("tenant"), "value",
        )
        # Two-digit values as exact decimals, so that sums do not depend on the order of the rows.
        exact = metrics.withColumn("value", F.col("value").cast("decimal(18,2)"))
        found = A.metric_statistics(exact, seconds, ("sum", "maximum", "samples", "average"))
        return found.select(
            F.unix_seconds("period_start").alias("period_s"), "metric", "tenant", (F.col("sum") * 100).cast("bigint").alias("sum_cents"),
            F.col("maximum").cast("double").alias("maximum"), "samples", F.round(F.col("sum").cast("double") / F.col("samples"), 6).alias("average"),
        )

    return job


for _seconds in (300, 3600, 86400):
    query(f"f11_statistics_{_seconds}", _period_sql(_seconds))(_period_job(_seconds))


@query(
    "f12_object_counts",
    oracle("SELECT tenant_id, application, environment, count(*) AS objects FROM info GROUP BY ALL", "info"),
)
def _(t):
    return object_counts(t.objects, ["tenant_id", "application", "environment"])


@query(
    "f13_storage_stats",
    oracle(
        "SELECT modified_ms // 86400000 AS epoch_day, count(*) AS objects, sum(size_bytes)::BIGINT AS total_bytes, sum(size_bytes) / count(*) AS avg_bytes FROM listing GROUP BY 1",
        "listing",
    ),
)
def _(t):
    return storage_stats(t.listing)


@query(
    "f14_config_types",
    oracle("SELECT tenant_id, count(*) AS configs, string_agg(type, ',' ORDER BY type) AS types FROM cfg GROUP BY tenant_id", "cfg"),
)
def _(t):
    return C.config_types(t.configs)


STATE = """CASE WHEN sent_ms <= 1706659200000 - 1209600000 THEN 'expired' WHEN visible_ms <= 1706659200000 AND receive_count >= 3 THEN 'dead_letter'
    WHEN visible_ms <= 1706659200000 THEN 'visible' WHEN receive_count = 0 THEN 'delayed' ELSE 'in_flight' END"""


@query(
    "f15_queue_depth",
    oracle(
        """SELECT count(*) FILTER (WHERE s = 'visible') AS visible, count(*) FILTER (WHERE s = 'delayed') AS delayed,
        count(*) FILTER (WHERE s = 'in_flight') AS in_flight, count(*) FILTER (WHERE s = 'dead_letter') AS dead_letter FROM q""",
        "msgs", q=f"SELECT {STATE} AS s FROM msgs",
    ),
)
def _(t):
    return Q.queue_depth(t.messages, AS_OF_MS)


@query(
    "t4_dead_letters",
    oracle(
        "SELECT message_id, receive_count, s = 'dead_letter' AS dead FROM q WHERE s <> 'expired'",
        "msgs", q=f"SELECT message_id, receive_count, {STATE} AS s FROM msgs",
    ),
)
def _(t):
    live, dead = Q.split_dead_letters(t.messages, AS_OF_MS)
    both = live.withColumn("dead", F.lit(False)).unionByName(dead.withColumn("dead", F.lit(True)))
    return both.select("message_id", "receive_count", "dead")


@query(
    "t3_requeue",
    oracle(
        """SELECT message_id, "offset", retry_count + 1 AS retry_count, least(pow(2, retry_count + 1), 900)::INTEGER AS delay_s,
        1706659200000 + least(pow(2, retry_count + 1), 900)::BIGINT * 1000 AS visible_ms,
        env->>'$.Message' AS message, "offset" AS body_offset, retry_count + 1 AS body_retry_count, receipt_handle AS body_handle, '2024-01-31T00:00:00Z' AS body_requeued_at
        FROM judged WHERE error_code IS NULL AND COALESCE(bad_at, -1) <> 0 AND receipt_handle <> '' AND retry_count + 1 <= 3""",
        "judged",
    ),
)
def _(t):
    failures = N.with_processing_metadata(t.messages).join(
        N.parse_notifications(t.messages.select("message_id", "body")).filter("error_code is null").select("message_id"),
        "message_id", "left_semi",
    )
    again = Q.requeue(failures, AS_OF_MS)
    v = F.parse_json("body")
    get = {
        "message": ("$.Message", "string"), "body_offset": ("$.processing_metadata.offset", "bigint"),
        "body_retry_count": ("$.processing_metadata.retry_count", "bigint"),
        "body_handle": ("$.processing_metadata.original_receipt_handle", "string"),
        "body_requeued_at": ("$.processing_metadata.requeued_at", "string"),
    }
    return again.select(
        "message_id", "offset", "retry_count", "delay_s", "visible_ms",
        *[F.variant_get(v, path, kind).alias(name) for name, (path, kind) in get.items()],
    )


@query(
    "f16_stage_counts",
    oracle(
        """SELECT 'lines' AS stage, count(*) AS events, count(*) FILTER (WHERE NOT ok) AS errors FROM parsed
        UNION ALL SELECT 'records', count(*), 0 FROM records UNION ALL SELECT 'events', count(*), 0 FROM ev""",
        "ev",
    ),
)
def _(t):
    return A.record_stage_counts(t.records)


@query(
    "h3_all_attempts",
    oracle(
        """SELECT object_key, tenant_id, type, succeeded, CASE WHEN type = 'cloudwatch' THEN eid % 50 END AS events FROM attempts""",
        "routed", attempts=ATTEMPTS,
    ),
)
def _(t):
    tries = attempts_of(t.routed)
    sent = tries.filter("type = 'cloudwatch'").withColumn("events", F.col("eid") % 50)
    return A.all_attempts(sent, tries.filter("type = 's3'")).select("object_key", "tenant_id", "type", "succeeded", "events")


@query(
    "t9_dedupe",
    oracle(
        "SELECT object_key, type, tenant_id, delivered_ms FROM attempts",
        "routed", attempts=ATTEMPTS,
    ),
)
def _(t):
    return A.dedupe_deliveries(redelivered(t), ["object_key", "type"]).select("object_key", "type", "tenant_id", "delivered_ms")


def redelivered(t):
    """Every attempt, and for a third of them a redelivery some seconds later."""
    tries = attempts_of(t.routed).select("object_key", "type", "tenant_id", "delivered_ms", "eid")
    again = tries.filter("eid % 3 = 0").withColumn("delivered_ms", F.col("delivered_ms") + 5000)
    return tries.unionByName(again)
