"""Queries that go through files and streams: derived rows are written, read back and counted."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.operators import records as R
from tributary.operators import search as S
from tributary.operators.enrich import extract_log_level, structure_record
from tributary.plans.catalog_fields import JSON_TIME, TEXT_TIME
from tributary.plans.catalog_flow import ATTEMPTS, redelivered
from tributary.plans.catalog_order import DELIVERIES, KEYS, _packed_sql, beat_records
from tributary.plans.derive import AS_OF_MS, BUCKET
from tributary.plans.oracle import oracle
from tributary.plans.registry import Tables, query
from tributary.session import ensure_checkpoint_dir, scratch_path
from tributary.sinks import central, copies
from tributary.sinks.objects import write_lines
from tributary.sources import objects as O
from tributary.streaming import collector, liveness, router

KEY_PARTS = {f"key_{name}": i for i, name in enumerate(central.DIMENSIONS)}


def _store_lines(t: Tables) -> str:
    """Stored lines as text objects in the central layout."""
    path = scratch_path(t.spark, "store")
    dims = {folder: F.get(F.split("object_key", "/"), F.lit(i)) for folder, i in KEY_PARTS.items()}
    rows = t.stored.withColumns(dims).hint("rebalance", *KEY_PARTS).sortWithinPartitions(*KEY_PARTS, "line_no")
    write_lines(rows, path, [*KEY_PARTS], ".txt.gz")
    return path


POD_PREFIX = "regexp_replace(object_key, '/[^/]*$', '')"


@query(
    "a1_read_log_objects",
    oracle(
        f"""SELECT {POD_PREFIX} AS pod_prefix, line, count(*) AS n FROM stored GROUP BY ALL""", "stored"
    ),
)
def _(t):
    lines = central.read_central(t.spark, _store_lines(t))
    prefix = F.regexp_replace("object_key", "/[^/]*$", "")
    return lines.groupBy(prefix.alias("pod_prefix"), "line").agg(F.count("*").alias("n"))


@query(
    "a1_each_object",
    oracle(
        """SELECT replace(object_key, '//', '/-/') AS object_key, CASE WHEN object_key LIKE '%.gz' THEN CASE eid % 3 WHEN 1 THEN 'truncated' WHEN 2 THEN 'corrupt' END END AS error_code,
        CASE WHEN object_key NOT LIKE '%.gz' OR eid % 3 = 0 THEN 2 ELSE 0 END::BIGINT AS lines FROM listing""",
        "listing",
    ),
)
def _(t):
    # One file per object: whole, cut short, or no gzip at all.
    root = scratch_path(t.spark, "each")
    named = F.replace("object_key", F.lit("//"), F.lit("/-/"))  # a path has no empty part
    t.listing.select(named.alias("object_key"), "eid").mapInPandas(_put_packed(root), "object_key string").write.format("noop").mode("overwrite").save()
    rows = O.read_each_object(t.spark, root)
    return rows.groupBy("object_key").agg(F.min("error_code").alias("error_code"), F.count("line").alias("lines"))


def _put_packed(root: str):
    def run(frames):
        import gzip

        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        for frame in frames:
            for row in frame.itertuples():
                plain = f"{row.object_key}\n{row.eid}\n".encode()
                packed = gzip.compress(plain)
                name = f"{base}/{row.object_key}"
                store.create_dir(name.rsplit("/", 1)[0], recursive=True)
                with store.open_output_stream(name, compression=None) as out:
                    zipped = name.endswith(".gz")
                    out.write(plain if not zipped else (packed, packed[:-6], plain)[row.eid % 3])
            yield frame[["object_key"]]

    return run


@query("a10_plain_lines", oracle("SELECT message, count(*) AS n FROM raw GROUP BY message", "raw"))
def _(t):
    path = scratch_path(t.spark, "lines")
    t.raw.select("message").write.text(path)
    return O.lines(t.spark, path).groupBy("message").agg(F.count("*").alias("n"))


@query(
    "s6_whole_objects",
    oracle(
        """SELECT conv_id, false AS parse_error, (row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1)::INTEGER AS item_no,
          role, text AS message FROM conversations WHERE conv_id % 3 = 0
        UNION ALL SELECT conv_id, false, 0, 'all', string_agg(COALESCE(text, ''), chr(10) ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) FROM conversations WHERE conv_id % 3 = 1 GROUP BY conv_id
        UNION ALL SELECT DISTINCT conv_id, true, 0, NULL, NULL FROM conversations WHERE conv_id % 3 = 2"""
    ),
)
def _(t):
    # One file per conversation with all its texts: a pretty-printed array of turns, one pretty-printed object, or an array without its end.
    turn = F.struct("turn", "role", "text")
    grouped = t.given("conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    pretty = {"pretty": "true"}
    every = F.to_json(F.transform("turns", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("message"))), pretty)
    joined = F.array_join(F.transform("turns", lambda x: F.coalesce(x["text"], F.lit(""))), "\n")
    one = F.to_json(F.struct(F.lit("all").alias("role"), joined.alias("message")), pretty)
    n = F.col("conv_id") % 3
    body = F.when(n == 0, every).when(n == 1, one).otherwise(F.concat(F.lit("[\n"), one))
    path = scratch_path(t.spark, "whole")
    grouped.select("conv_id", body.alias("value")).hint("rebalance", "conv_id").write.partitionBy("conv_id").option("compression", "gzip").text(path)
    lines = O.read_log_objects(t.spark, path)
    keys = R.fallback_keys(R.parse_stats(R.parse_lines(lines)))
    records = R.parse_whole_objects(t.spark, path, keys)
    member = lambda name: F.try_variant_get("record", f"$.{name}", "string")
    conv = F.regexp_extract("object_key", r"conv_id=(\d+)", 1).cast("bigint")
    return records.select(conv.alias("conv_id"), "parse_error", "item_no", member("role").alias("role"), member("message").alias("message"))


@query(
    "a3_list_objects",
    oracle("SELECT 'central-logs' AS bucket, replace(object_key, '//', '/-/') AS object_key, strlen(replace(object_key, '//', '/-/'))::BIGINT AS size_bytes, true AS dated FROM listing", "listing"),
)
def _(t):
    root = scratch_path(t.spark, "listed")
    named = F.replace("object_key", F.lit("//"), F.lit("/-/"))
    put = t.listing.select("bucket", named.alias("object_key"))
    put.mapInPandas(_put_objects(root), "object_key string").write.format("noop").mode("overwrite").save()
    found = O.list_objects(t.spark, f"{root}/{BUCKET}", BUCKET)
    return found.select("bucket", "object_key", "size_bytes", (F.col("modified_ms") > AS_OF_MS).alias("dated"))


SEARCHED = ("m77 é<>", "timestamp", "no such text")


@query(
    "d11_indexed_search",
    oracle(
        f"""SELECT term, replace(object_key, '//', '/-/') AS object_key, line, count(*) AS n, true AS skipped_most
        FROM stored, (SELECT unnest({list(SEARCHED)!r}) AS term) WHERE contains(line, term) GROUP BY ALL""",
        "stored",
    ),
)
def _(t):
    # One plain object for each key, and the index built from the same lines.
    root = scratch_path(t.spark, "searched")
    plain = t.stored.select(F.replace("object_key", F.lit("//"), F.lit("/-/")).alias("object_key"), "line_no", "line")
    put = plain.groupBy("object_key").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("content"))
    put.mapInPandas(_put_contents(root), "object_key string").write.format("noop").mode("overwrite").save()
    path = scratch_path(t.spark, "index")
    S.build_index(plain).write.parquet(path)
    index, rows = t.spark.read.parquet(path), None
    objects = index.select("object_key").distinct().count()
    # The rare term opens few objects; the one that is nowhere as well.
    few = all(S.may_hold(index, term).count() <= 3 + objects // 50 for term in (SEARCHED[0], SEARCHED[2]))
    for term in SEARCHED:
        found = S.search_objects(t.spark, root, index, term).select(F.lit(term).alias("term"), "object_key", "line")
        rows = found if rows is None else rows.union(found)
    return rows.groupBy("term", "object_key", "line").agg(F.count("*").alias("n"), F.lit(few).alias("skipped_most"))


def _put_contents(root: str):
    def run(frames):
        import gzip

        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        for frame in frames:
            for row in frame.itertuples():
                name = f"{base}/{row.object_key}"
                store.create_dir(name.rsplit("/", 1)[0], recursive=True)
                with store.open_output_stream(name, compression=None) as out:
                    out.write(gzip.compress(row.content.encode()) if name.endswith(".gz") else row.content.encode())
            yield frame[["object_key"]]

    return run


@query(
    "b1_central_sink",
    oracle(
        f"""SELECT cluster_id || '/' || namespace || '/' || application || '/' || pod_name AS pod_prefix, message,
        COALESCE({TEXT_TIME}, {JSON_TIME}, ingest_ms) AS ts_ms, count(*) AS n, true AS within_limit FROM raw GROUP BY ALL""",
        "raw",
    ),
)
def _(t):
    from tributary.operators.enrich import with_event_time

    limit = 20_000

    path = scratch_path(t.spark, "central")
    timed = t.raw.withColumn("timestamp", F.timestamp_millis("ingest_ms")).transform(with_event_time, AS_OF_MS)
    central.write_central(timed.select(*central.DIMENSIONS, "timestamp", "message"), path, object_bytes=limit)
    lines = central.read_central(t.spark, path)
    sizes = lines.groupBy("object_key").agg((F.sum(F.octet_length("line") + 1) <= limit).alias("within_limit"))
    prefix, ts, message = F.regexp_replace("object_key", "/[^/]*$", ""), _member("timestamp").cast("timestamp"), _member("message")
    rows = lines.join(sizes, "object_key").select(prefix.alias("pod_prefix"), message.alias("message"), F.unix_millis(ts).alias("ts_ms"), "within_limit")
    return rows.groupBy("pod_prefix", "message", "ts_ms").agg(F.count("*").alias("n"), F.min("within_limit").alias("within_limit"))


def _member(name: str):
    return F.try_variant_get(F.parse_json("line"), f"$.{name}", "string")


@query(
    "b2_executed_copies",
    oracle(
        """SELECT tenant_id, application, count(*) + count_if(eid % 7 = 0) AS copied, count_if(eid % 7 = 0) AS superseded, count(*) AS objects
        FROM routed WHERE type = 's3' GROUP BY ALL""", "routed"
    ),
)
def _(t):
    from tributary.operators.delivery import plan_object_copies

    root, target = scratch_path(t.spark, "source"), scratch_path(t.spark, "target")
    # Some objects exist in a second cluster too; the destination key leaves the cluster out, so these copies collide.
    twins = t.routed.filter("eid % 7 = 0").withColumn("object_key", F.regexp_replace("object_key", "^[^/]+", "twin-mc-9"))
    plan = plan_object_copies(t.routed.unionByName(twins), AS_OF_MS)
    put = plan.select("bucket", "object_key").distinct().repartition("object_key")
    put.mapInPandas(_put_objects(root), "object_key string").write.format("noop").mode("overwrite").save()
    buckets = plan.select("dst_bucket").distinct()
    buckets.mapInPandas(_make_buckets(target), "dst_bucket string").write.format("noop").mode("overwrite").save()
    done = copies.execute_copies(plan, root, target)
    parts = F.split("object_key", "/")
    return done.filter("succeeded").groupBy(F.get(parts, F.lit(1)).alias("tenant_id"), F.get(parts, F.lit(2)).alias("application")).agg(
        F.count("*").alias("copied"), F.count_if("superseded").alias("superseded"), F.count_distinct("dst_bucket", "dst_key").alias("objects")
    )


def _put_objects(root: str):
    def run(frames):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        for frame in frames:
            for row in frame.itertuples():
                name = f"{base}/{row.bucket}/{row.object_key}"
                store.create_dir(name.rsplit("/", 1)[0], recursive=True)
                with store.open_output_stream(name, compression=None) as out:
                    out.write(row.object_key.encode())
            yield frame[["object_key"]]

    return run


def _make_buckets(root: str):
    def run(frames):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        for frame in frames:
            for bucket in frame["dst_bucket"]:
                store.create_dir(f"{base}/{bucket}", recursive=True)
            yield frame

    return run


STORED = """SELECT ingest_ms AS timestamp, namespace AS customer_id, cluster_id,
    CASE split_part(cluster_id, '-', 1) WHEN 'stg' THEN 'staging' WHEN 'dev' THEN 'development' ELSE 'production' END AS environment,
    application, pod_name, 'INFO' AS log_level, message, 'collector' AS source FROM raw"""
TWO_SINKS = f"SELECT sink, w.*, count(*) AS n FROM ({STORED}) w, (SELECT unnest(['main', 'debug']) AS sink) GROUP BY ALL"


def _structured(rows):
    from tributary.functions.keys import environment

    named = {"timestamp": F.col("ingest_ms"), "customer_id": F.col("namespace"), "environment": environment(F.col("cluster_id"))}
    return structure_record(extract_log_level(rows).withColumns(named), "collector")


def _both_sinks(t: Tables, schema, main: str, debug: str):
    read = lambda path, sink: t.spark.read.schema(schema).option("recursiveFileLookup", "true").json(path).withColumn("sink", F.lit(sink))
    both = read(main, "main").unionByName(read(debug, "debug"))
    return both.groupBy(*both.columns).agg(F.count("*").alias("n"))


@query("b5_two_sinks", oracle(TWO_SINKS, "raw"))
def _(t):
    main, debug = scratch_path(t.spark, "main"), scratch_path(t.spark, "debug")
    rows = _structured(t.raw)
    central.fan_out(rows, [lambda d: d.write.option("compression", "gzip").json(main), lambda d: d.write.json(debug)])
    return _both_sinks(t, rows.schema, main, debug)


@query("b5_stream_fan_out", oracle(TWO_SINKS, "raw"))
def _(t):
    # Three micro-batches; the main sink is given the first one twice, as after a lost commit, and writes it in place.
    source, main, debug = (scratch_path(t.spark, n) for n in ("fan-in", "main", "debug"))
    raw = t.raw.select("ingest_ms", "namespace", "cluster_id", "application", "pod_name", "message", "event_id")
    for k in range(3):
        raw.where(F.col("event_id") % 3 == k).drop("event_id").repartition(2).write.mode("append").parquet(source)
    stream = t.spark.readStream.schema(raw.drop("event_id").schema).option("maxFilesPerTrigger", 2).parquet(source)
    rows = _structured(stream)

    def to_main(df, number):
        for _ in range(1 + (number == 0)):
            df.write.mode("overwrite").option("compression", "gzip").json(f"{main}/batch={number}")

    to_debug = lambda df, number: df.write.mode("overwrite").json(f"{debug}/batch={number}")
    central.stream_fan_out(rows, [to_main, to_debug], scratch_path(t.spark, "fan-ckpt"), once=True).awaitTermination()
    return _both_sinks(t, rows.schema, main, debug)


# -- streams --------------------------------------------------------------------------------------

@query(
    "t1_collector_stream",
    oracle(
        f"""SELECT 'c-1/' || COALESCE(pod_namespace, 'unknown') || '/' || COALESCE(app_label, 'unknown') || '/' || COALESCE(pod, 'unknown') AS pod_prefix,
        message, COALESCE({TEXT_TIME}, {JSON_TIME}, ts_in_ms, 1706659200000) AS ts_ms, count(*) AS n FROM pods WHERE hosted = 'true' GROUP BY ALL""",
        "pods",
    ),
)
def _(t):
    source, path, ckpt = (scratch_path(t.spark, n) for n in ("pods", "collected", "collector-ckpt"))
    t.pods.select("message", "timestamp", "kubernetes").write.option("timestampFormat", central.STAMP).json(source)
    logs = collector.read_pod_logs(t.spark, source)
    collector.start_collector(logs, "c-1", path, ckpt, ("hosted", "true"), AS_OF_MS, once=True).awaitTermination()
    lines = central.read_central(t.spark, path)
    prefix, ts = F.regexp_replace("object_key", "/[^/]*$", ""), F.unix_millis(_member("timestamp").cast("timestamp"))
    return lines.groupBy(prefix.alias("pod_prefix"), _member("message").alias("message"), ts.alias("ts_ms")).agg(F.count("*").alias("n"))


UPLOADED = 9_000_000_000_000


@query(
    "t2_router_stream",
    oracle(
        _packed_sql("dl2", "tenant_id, log_group, pod_prefix", "event_ts_ms, line_no, item_no", 5, 400,
                    "SELECT tenant_id, pod_prefix, batch_id, count(*) AS events, min(event_ts_ms) AS first_ms, string_agg(message, '|' ORDER BY seq) AS messages")
        + " GROUP BY ALL",
        "ev", "routed",
        dl2=f"""SELECT DISTINCT r.tenant_id, r.log_group_name AS log_group, {POD_PREFIX.replace('object_key', 'e.object_key')} AS pod_prefix, e.line_no, e.item_no, e.message,
            CASE WHEN e.event_ts_ms = 0 THEN {UPLOADED} ELSE e.event_ts_ms END AS event_ts_ms FROM ev e JOIN routed r ON {POD_PREFIX.replace('object_key', 'e.object_key')} = {POD_PREFIX.replace('object_key', 'r.object_key')}
            WHERE r.type = 'cloudwatch'""",
    ),
)
def _(t):
    ensure_checkpoint_dir(t.spark)
    # Lines with the time 0 get the upload time of the files written here, which is after all others: one file
    # for each pod, and the time itself is shown as UPLOADED.
    path = scratch_path(t.spark, "store")
    dims = {folder: F.get(F.split("object_key", "/"), F.lit(i)) for folder, i in KEY_PARTS.items()}
    laid = t.stored.withColumns(dims).repartition(*KEY_PARTS).sortWithinPartitions(*KEY_PARTS, "line_no")
    write_lines(laid, path, [*KEY_PARTS], ".txt.gz")
    output = scratch_path(t.spark, "routed")
    conf = router.RouterConf(
        path, BUCKET, output, scratch_path(t.spark, "router-ckpt"), lambda: t.configs, AS_OF_MS,
        max_events=5, max_bytes=400, suffix=".gz",
    )
    router.start_router(t.spark, conf, once=True).awaitTermination()
    prefix = F.regexp_replace("object_key", "/[^/]*$", "")
    return t.spark.read.parquet(f"{output}/batches").select(
        "tenant_id", prefix.alias("pod_prefix"), "batch_id", "events",
        F.array_min(F.transform("log_events", lambda e: F.when(e["event_ts_ms"] > AS_OF_MS, F.lit(UPLOADED)).otherwise(e["event_ts_ms"]))).alias("first_ms"),
        F.array_join(F.transform("log_events", lambda e: e["message"]), "|").alias("messages"),
    )


def _stream_of(t: Tables, rows, name: str):
    """The rows as a file stream, written in time order so that nothing is late."""
    path = scratch_path(t.spark, name)
    rows.repartitionByRange("ts").sortWithinPartitions("ts").write.parquet(path)
    return t.spark.readStream.schema(rows.schema).parquet(path)


def _drain(t: Tables, stream, name: str):
    """Runs a stream to its end in append mode and returns what it wrote."""
    out = scratch_path(t.spark, name)
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", out)
    writer.option("checkpointLocation", scratch_path(t.spark, name + "-ckpt")).trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.schema(stream.schema).parquet(out)


@query(
    "t6_heartbeat_alerts",
    oracle(
        """SELECT cluster_id, ts_ms AS last_beat_ms FROM (SELECT cluster_id, ts_ms, lead(ts_ms) OVER (PARTITION BY cluster_id ORDER BY ts_ms) AS nxt,
          max(ts_ms) OVER () AS newest FROM raw0 WHERE event_type = 'view')
        WHERE COALESCE(nxt - ts_ms > 30000000, true) AND ts_ms + 30000001 <= newest - 600000""",
        "raw0",
    ),
)
def _(t):
    beats = beat_records(t).select("cluster_id", F.timestamp_millis("ts_ms").alias("ts"))
    alerts = liveness.heartbeat_alerts(_stream_of(t, beats, "beats"), max_gap_s=30_000)
    return _drain(t, alerts, "alerts").select("cluster_id", F.unix_millis("last_beat").alias("last_beat_ms"))


WATCH_BATCHES, WATCH_SPAN_MS, WATCH_FILES = 4, 650_000_000, 2
WATCH_START_MS = 1_704_067_200_000  # 2024-01-01, where the events begin


@query(
    "t6_silence_watch",
    oracle(
        f"""SELECT cluster_id, CASE WHEN real THEN ts_ms END AS last_beat_ms, ts_ms AS silent_from_ms FROM (
          SELECT *, lead(ts_ms) OVER (PARTITION BY cluster_id ORDER BY ts_ms) AS nxt, max(ts_ms) FILTER (real) OVER () AS newest FROM (
            SELECT cluster_id, ts_ms, bool_or(real) AS real FROM (
              SELECT cluster_id, ts_ms, true AS real FROM raw0 WHERE event_type = 'view' AND NOT (cluster_id = 'lab-mc-2' AND ts_ms > {WATCH_START_MS} + 2 * {WATCH_SPAN_MS})
              UNION ALL SELECT DISTINCT cluster_id || suffix, {WATCH_START_MS}, false FROM raw0, (SELECT unnest(['', '-spare']) AS suffix)) GROUP BY ALL))
        WHERE COALESCE(nxt - ts_ms > 30000000, true) AND ts_ms + 30000001 <= newest - 700000000""",
        "raw0",
    ),
)
def _(t):
    # Beats in four micro-batches; every tenth comes a batch late. One cluster falls silent in the middle, and some known ones never beat.
    cut = (F.col("cluster_id") == "lab-mc-2") & (F.col("ts_ms") > WATCH_START_MS + 2 * WATCH_SPAN_MS)
    beats = beat_records(t).where(~cut).select("cluster_id", "ts_ms", F.timestamp_millis("ts_ms").alias("ts"))
    due = F.floor((F.col("ts_ms") - WATCH_START_MS) / WATCH_SPAN_MS) + F.when(F.col("ts_ms") % 10 == 0, 1).otherwise(0)
    arrival = F.least(due, F.lit(WATCH_BATCHES - 1))
    path = scratch_path(t.spark, "watched")
    for k in range(WATCH_BATCHES):
        beats.where(arrival == k).select("cluster_id", "ts").repartition(WATCH_FILES).write.mode("append").parquet(path)
    suffix = F.explode(F.array(F.lit(""), F.lit("-spare")))
    known = t.raw.select("cluster_id").distinct().select("cluster_id", suffix.alias("s")).select(
        F.concat("cluster_id", "s").alias("cluster_id"), F.timestamp_millis(F.lit(WATCH_START_MS)).alias("ts")
    )
    stream = t.spark.readStream.schema("cluster_id string, ts timestamp").option("maxFilesPerTrigger", WATCH_FILES).parquet(path)
    alerts = liveness.silence_alerts(stream, max_gap_s=30_000, lateness="700000 seconds", known=known)
    return _drain(t, alerts, "silences").select("cluster_id", F.unix_millis("last_beat").alias("last_beat_ms"), F.unix_millis("silent_from").alias("silent_from_ms"))


@query(
    "t4_message_outcomes",
    oracle(
        """SELECT object_key, outcome, at_ms, receive_count FROM (
          SELECT *, CASE WHEN dead_ms IS NOT NULL THEN 'dead_letter' WHEN deleted_ms IS NULL THEN 'expired' END AS outcome,
            COALESCE(dead_ms, sent_ms + 1209600000) AS at_ms, CASE WHEN dead_ms IS NOT NULL THEN 3 ELSE n END AS receive_count
          FROM (SELECT *, CASE WHEN n >= 3 AND (deleted_ms IS NULL OR deleted_ms > sent_ms + 2960000) THEN sent_ms + 2960000 END AS dead_ms FROM (
            SELECT *, CASE WHEN eid % 3 = 0 AND n > 0 THEN sent_ms + 70000 + (n - 1) * 1000000 END AS deleted_ms FROM (
              SELECT object_key, min(ts_ms) AS sent_ms, min(event_id) AS eid, (min(event_id) % 5)::INTEGER AS n FROM raw GROUP BY object_key))))
        WHERE outcome IS NOT NULL AND at_ms <= (SELECT max(greatest(sent_ms, COALESCE(sent_ms + 60000 + (n - 1) * 1000000, 0) * (n > 0)::INTEGER, CASE WHEN eid % 3 = 0 AND n > 0 THEN sent_ms + 70000 + (n - 1) * 1000000 ELSE 0 END)) - 700000000
          FROM (SELECT min(ts_ms) AS sent_ms, min(event_id) AS eid, min(event_id) % 5 AS n FROM raw GROUP BY object_key))""",
        "raw",
    ),
)
def _(t):
    # Each object's message is sent with its first event and received up to four times, 1,000 s apart; some are deleted after the last receive.
    sent = t.raw.groupBy("object_key").agg(F.min("ts_ms").alias("sent_ms"), F.min("event_id").alias("eid"))
    n = F.col("eid") % 5
    event = lambda kind, at: F.struct(F.lit(kind).alias("kind"), at.cast("bigint").alias("at_ms"))
    received = F.when(n > 0, F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda j: event("received", F.col("sent_ms") + 60_000 + j * 1_000_000)))
    deleted = F.when((F.col("eid") % 3 == 0) & (n > 0), F.array(event("deleted", F.col("sent_ms") + 70_000 + (n - 1) * 1_000_000)))
    none = F.array().cast("array<struct<kind: string, at_ms: bigint>>")
    every = F.concat(F.array(event("sent", F.col("sent_ms"))), F.coalesce(received, none), F.coalesce(deleted, none))
    events = sent.select("object_key", F.inline(every)).withColumn("ts", F.timestamp_millis("at_ms"))
    # Four micro-batches; every seventh event comes a batch late.
    late = F.when(F.xxhash64("object_key", "kind", "at_ms") % 7 == 0, 1).otherwise(0)
    arrival = F.least(F.floor((F.col("at_ms") - WATCH_START_MS) / WATCH_SPAN_MS) + late, F.lit(WATCH_BATCHES - 1))
    path = scratch_path(t.spark, "queue-events")
    for k in range(WATCH_BATCHES):
        events.where(arrival == k).select("object_key", "kind", "ts").repartition(WATCH_FILES).write.mode("append").parquet(path)
    stream = t.spark.readStream.schema("object_key string, kind string, ts timestamp").option("maxFilesPerTrigger", WATCH_FILES).parquet(path)
    return _drain(t, liveness.message_outcomes(stream, "object_key", "700000 seconds"), "outcomes")


@query(
    "t9_dedupe_stream",
    oracle("SELECT object_key, type, count(*) AS n FROM attempts GROUP BY ALL", "routed", attempts=ATTEMPTS),
)
def _(t):
    tries = redelivered(t).select("object_key", "type", F.timestamp_millis("delivered_ms").alias("ts"))
    once = liveness.dedupe_stream(_stream_of(t, tries, "attempts"), ["object_key", "type"])
    return _drain(t, once, "deduped").groupBy("object_key", "type").agg(F.count("*").alias("n"))


@query(
    "t8_streaming_statistics",
    oracle(
        """SELECT period_s, metric, samples, cents FROM (SELECT ts_s // 3600 * 3600 AS period_s, event_type AS metric, count(*) AS samples, sum(CAST(value * 100 AS BIGINT))::BIGINT AS cents
          FROM raw0 GROUP BY ALL) WHERE (period_s + 3600) * 1000 <= (SELECT max(ts_ms) - 600000 FROM raw0)""",
        "raw0",
    ),
)
def _(t):
    ev = t.given("events")
    millis = F.expr("timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")
    metrics = ev.select(
        F.timestamp_millis(millis).alias("ts"), F.col("event_type").alias("metric"), F.round(F.col("value") * 100).cast("bigint").alias("value")
    )
    stats = liveness.stream_metric_statistics(_stream_of(t, metrics, "metrics"), 3600, ("samples", "sum"), keys=["metric"])
    return _drain(t, stats, "periods").select(
        F.unix_seconds("period_start").alias("period_s"), "metric", "samples", F.col("sum").alias("cents")
    )
