"""Queries of the delivery runs: a message stream in several micro-batches, then runs that only retry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.plans.derive import AS_OF_MS
from tributary.plans.oracle import oracle
from tributary.plans.registry import Tables, query
from tributary.session import scratch_path
from tributary.sinks.commits import RunStore
from tributary.streaming import delivery

#: Runs that the stream makes, all runs, and the time between two of them: longer than the visibility time.
STREAM_RUNS, RUNS, STEP_MS = 3, 5, 1_000_000
FILES = 4
#: Messages are hidden for up to 45 minutes here, not for up to a month.
SOONER_MS = 899_100_000

# The destination refuses calls for some objects until their message has been tried a number of times; some copies fail.
DIGIT = "instr('0123456789abcdef', substr(md5(object_key), 1, 1)) - 1"
REFUSED = f"CASE WHEN {DIGIT} < 10 THEN ({DIGIT}) % 5 ELSE 0 END"
BAD_COPY = "substr(md5(object_key), 2, 1) = 'a'"
NOW = f"({AS_OF_MS} + run * {STEP_MS})"

DELIVERIES = f"""SELECT n.message_id, n.record_idx, object_key, n.eid, r.tenant_id, r.type, n."offset" AS skipped, r.modified_ms AS upload, {BAD_COPY} AS bad_copy,
    r.type = 'cloudwatch' AND l.lost_key IS NOT NULL AS lost, greatest(COALESCE(events, 0) - n."offset", 0) AS sent, {REFUSED} AS refused
    FROM notes n JOIN routed r USING (object_key) LEFT JOIN counted USING (object_key) LEFT JOIN lost_objects l ON l.lost_key = object_key"""
#: A message at the runs that look at it. prev: its retries when its deliveries last failed, -1 before.
STATES = f"""SELECT j.message_id, (eid % {STREAM_RUNS})::BIGINT AS run, retry_count, receive_count, sent_ms, visible_ms - eid % 4 * {SOONER_MS} AS visible_ms, (-1)::BIGINT AS prev, receipt_handle, error_code, COALESCE(need, 0) AS need
    FROM judged j LEFT JOIN needs USING (message_id)
    UNION ALL
    SELECT message_id, next_run, retry_count, receive_count, sent_ms, visible_ms, prev, receipt_handle, error_code, need FROM (
      SELECT *, greatest(run + 1, ceil((visible_ms - {AS_OF_MS}) / {STEP_MS}.0)::BIGINT) AS next_run FROM (
        SELECT message_id, run, CASE WHEN again THEN retry_count + 1 ELSE retry_count END AS retry_count,
          (CASE WHEN again THEN 0 WHEN unclear THEN receive_count + 1 ELSE receive_count END)::INTEGER AS receive_count, CASE WHEN again THEN {NOW} ELSE sent_ms END AS sent_ms,
          CASE WHEN again THEN {NOW} + least(pow(2, retry_count + 1), 900)::BIGINT * 1000 WHEN unclear THEN {NOW} + 900000 ELSE visible_ms END AS visible_ms,
          CASE WHEN again THEN retry_count ELSE prev END AS prev, receipt_handle, error_code, need
        FROM (SELECT *, {{state}} = 'visible' AND error_code IS NULL AND need > retry_count AND receipt_handle <> '' AND retry_count < 3 AS again,
          {{state}} = 'visible' AND error_code = 'invalid_metadata' AS unclear, {{state}} = 'waits' AS waits FROM states)
        WHERE again OR unclear OR waits))
    WHERE next_run < {RUNS}"""
STATE = f"""CASE WHEN sent_ms <= {NOW} - 1209600000 THEN 'expired' WHEN visible_ms > {NOW} THEN 'waits' WHEN receive_count >= 3 THEN 'dead_letter' ELSE 'visible' END"""
ATTEMPTS = f"""SELECT run, d.*, s.retry_count, s.prev, {NOW} AS now, type = 'cloudwatch' AND (lost OR sent > 0 AND refused > s.retry_count) AS failed
    FROM states s JOIN deliveries d USING (message_id)
    WHERE {STATE} = 'visible' AND (prev < 0 OR type = 'cloudwatch' AND (lost OR sent > 0 AND refused > prev))"""


def _runs_sql(body: str) -> str:
    return oracle(
        body, "ev", "routed", "notes",
        recursive=True,
        counted="SELECT object_key, count(*) AS events FROM ev GROUP BY object_key",
        lost_objects="SELECT object_key AS lost_key FROM parsed GROUP BY object_key HAVING bool_or(NOT ok) AND object_key NOT IN (SELECT object_key FROM counted)",
        deliveries=DELIVERIES,
        needs="SELECT message_id, max(CASE WHEN lost THEN 1000 WHEN type = 'cloudwatch' AND sent > 0 THEN refused ELSE 0 END) AS need FROM deliveries GROUP BY message_id",
        states=STATES.format(state=STATE),
        attempts=ATTEMPTS,
    )


def _send(as_of: int):
    accept = delivery.accept_in_time(as_of)

    def send(batches):
        # What the destination would refuse for its age is reported in a table of its own; here calls fail by object.
        refused = F.expr(REFUSED) > F.col("retry_count")
        return accept(batches).withColumns({"failed": refused, "too_new_start": F.lit(None).cast("bigint"), "too_old_end": F.lit(None).cast("bigint")})

    return send


def _stored_once(t: Tables, rows: DataFrame, name: str) -> DataFrame:
    """The rows of a derived table, written once: every run looks at them."""
    path = scratch_path(t.spark, name)
    rows.write.parquet(path)
    return t.spark.read.schema(rows.schema).parquet(path)


def delivered(t: Tables) -> RunStore:
    """All messages in three micro-batches, then two runs of retries."""
    source, output = scratch_path(t.spark, "messages"), scratch_path(t.spark, "deliveries")
    messages = _stored_once(t, t.messages.withColumn("visible_ms", F.col("visible_ms") - F.col("eid") % 4 * SOONER_MS), "queued")
    for k in range(STREAM_RUNS):
        messages.where(F.col("eid") % STREAM_RUNS == k).select(*delivery.MESSAGE).repartition(FILES).write.mode("append").parquet(source)

    listing = _stored_once(t, t.listing.select("object_key", F.col("modified_ms").alias("upload_ms")), "listing")
    objects = _stored_once(t, t.stored, "stored").withColumn("error_code", F.lit(None).cast("string"))
    conf = delivery.DeliveryConf(
        output, lambda keys: listing.join(keys, "object_key", "left_semi"), lambda keys: objects.join(keys, "object_key", "left_semi"), lambda: t.configs, _send, lambda as_of: lambda plan: plan.withColumn("succeeded", ~F.expr(BAD_COPY)), lambda run: AS_OF_MS + run * STEP_MS,
        max_events=5, max_bytes=400,
    )
    schema = messages.select(*delivery.MESSAGE).schema
    stream = t.spark.readStream.schema(schema).option("maxFilesPerTrigger", FILES).parquet(source)
    delivery.start_deliveries(stream, conf, scratch_path(t.spark, "deliveries-ckpt"), once=True).awaitTermination()
    for _ in range(STREAM_RUNS, RUNS):
        delivery.deliver(t.spark, conf)
    return RunStore(t.spark, output)


@query(
    "t2_delivery_runs",
    _runs_sql(
        f"""SELECT 'attempt' AS kind, run, message_id, object_key, type AS name, CASE WHEN type = 's3' THEN NOT bad_copy ELSE NOT failed END::BIGINT AS ok,
            CASE WHEN type = 's3' OR lost THEN 0 ELSE sent END::BIGINT AS n FROM attempts
        UNION ALL SELECT 'queue', run, message_id, NULL, NULL, receive_count, visible_ms FROM states WHERE {STATE} = 'waits'
        UNION ALL SELECT 'queue', run, message_id, NULL, NULL, receive_count + 1, {NOW} + 900000 FROM states WHERE {STATE} = 'visible' AND error_code = 'invalid_metadata'
        UNION ALL SELECT 'queue', run, message_id, NULL, NULL, 0, {NOW} + least(pow(2, retry_count + 1), 900)::BIGINT * 1000 FROM states
            WHERE {STATE} = 'visible' AND error_code IS NULL AND need > retry_count AND receipt_handle <> '' AND retry_count < 3
        UNION ALL SELECT {STATE}, run, message_id, NULL, NULL, receive_count, visible_ms FROM states WHERE {STATE} IN ('dead_letter', 'expired')
        UNION ALL SELECT 'late', run, message_id, object_key, NULL, NULL, count(*) FROM (
            SELECT a.run, a.message_id, a.object_key, a.now, CASE WHEN e.event_ts_ms = 0 THEN a.upload ELSE e.event_ts_ms END AS ts
            FROM attempts a JOIN (SELECT *, row_number() OVER (PARTITION BY object_key ORDER BY line_no, item_no) AS rn FROM ev) e ON a.object_key = e.object_key AND rn > skipped
            WHERE a.type = 'cloudwatch') WHERE ts < now - 1209600000 GROUP BY ALL"""
    ),
)
def _(t):
    store = delivered(t)
    runs, none, text = store.runs(), F.lit(None).cast("bigint"), F.lit(None).cast("string")
    big = lambda c: F.col(c).cast("bigint")
    rows = store.read("attempts", runs).select(F.lit("attempt").alias("kind"), "run", "message_id", "object_key", F.col("type").alias("name"), big("succeeded").alias("ok"), big("events").alias("n"))
    for kind in ("queue", "dead_letters", "expired"):
        table = store.read(kind, runs)
        rows = rows.union(table.select(F.lit(kind.removesuffix("s")), "run", "message_id", text, text, big("receive_count"), "visible_ms"))
    return rows.union(store.read("late", runs).select(F.lit("late"), "run", "message_id", "object_key", text, none, "too_old"))


@query(
    "t2_run_metrics",
    _runs_sql(
        """SELECT run, name, sum(value)::BIGINT AS total, count(*) AS samples FROM (
            SELECT run, unnest(['LogCount/cloudwatch/successful_events', 'LogCount/cloudwatch/failed_events', CASE WHEN failed THEN 'LogCount/cloudwatch/failed_delivery' ELSE 'LogCount/cloudwatch/successful_delivery' END]) AS name,
              unnest([CASE WHEN failed THEN 0 ELSE sent END, CASE WHEN lost THEN 1 WHEN failed THEN sent ELSE 0 END, 1]) AS value FROM attempts WHERE type = 'cloudwatch' AND (lost OR sent > 0)
            UNION ALL SELECT run, CASE WHEN bad_copy THEN 'LogCount/s3/failed_delivery' ELSE 'LogCount/s3/successful_delivery' END, 1 FROM attempts WHERE type = 's3'
            UNION ALL SELECT run, 'LogCount/' || type || '/delivery_latency', now - upload FROM attempts WHERE CASE WHEN type = 's3' THEN NOT bad_copy ELSE NOT failed AND sent > 0 END
            UNION ALL SELECT s.run, 'observed ' || w.stage, w.n FROM (SELECT DISTINCT run FROM attempts WHERE type = 'cloudwatch') s JOIN (
                SELECT run, stage, n FROM (SELECT run, sum(lines) AS lines, sum(broken) AS broken_lines, sum(records) AS records, sum(events) AS events
                  FROM (SELECT DISTINCT run, object_key FROM attempts WHERE type = 'cloudwatch') JOIN (
                    SELECT object_key, count(*) AS lines, count(*) FILTER (WHERE NOT ok) AS broken FROM parsed GROUP BY object_key) USING (object_key)
                  LEFT JOIN (SELECT object_key, count(*) AS records FROM records GROUP BY object_key) USING (object_key) LEFT JOIN counted USING (object_key) GROUP BY run)
                UNPIVOT (n FOR stage IN (lines, broken_lines, records, events))) w ON s.run = w.run)
        GROUP BY ALL"""
    ),
)
def _(t):
    store = delivered(t)
    runs = store.runs()
    published = store.read("metrics", runs).select("run", F.col("metric").alias("name"), F.col("value").cast("bigint").alias("value"))
    # What observe() counted while the runs wrote their tables.
    seen = [(r.run, f"observed {k}", n) for r in runs for k, n in r.counts.items() if k != "last_visible_ms" and r.counts["lines"]]
    observed = t.spark.createDataFrame(seen, "run bigint, name string, value bigint")
    return published.union(observed).groupBy("run", "name").agg(F.sum("value").alias("total"), F.count("*").alias("samples"))
