import gzip
import json
import os
import random
import time
from types import SimpleNamespace

import pandas as pd
from pyspark.sql import functions as F

from tributary.operators import records as R
from tributary.operators.delivery import plan_object_copies
from tributary.schemas import POD_LOG
from tributary.sinks import central, copies
from tributary.sources import objects as O
from tributary.sources.configs import read_tenant_configs
from tributary.streaming import collector, liveness, router
from tests_support import cw, s3, table

AS_OF = 1_704_110_400_000


def put(root, key, text):
    name = os.path.join(root, key)
    os.makedirs(os.path.dirname(name), exist_ok=True)
    data = text.encode()
    with open(name, "wb") as out:
        out.write(gzip.compress(data) if key.endswith(".gz") else data)


FILES = {
    "c/t/app/p/lines.json.gz": '{"message":"1"}\n{"message":"2"}\n\n  \n{"message":"3"}\n',
    "c/t/app/p/array.json.gz": '[{"message":"4"},{"message":"5"}]',
    "c/t/app/p/pretty.json.gz": '[\n {"message":\n"6"},\n {"message":\n"7"}\n]',
    "c/t/app/p/one bad+name.json.gz": '{"message":"8"}\nbroken\n{"message":"9"}',
    "c/t/app/p/plain.json": '{"message":"10"}\r\n{"message":"11"}',
    "c/t/app/p/bad.json.gz": "this is not json at all",
    "c/t/app/p/empty.json.gz": "",
}


def test_object_files(spark, tmp_path):
    root = str(tmp_path)
    for key, text in FILES.items():
        put(root, key, text)
    lines = O.read_log_objects(spark, root)
    assert {r.object_key for r in lines.select("object_key").distinct().collect()} == set(FILES) - {"c/t/app/p/empty.json.gz"}
    events, failed = R.object_events(lines, AS_OF)
    assert sorted(int(r.message) for r in events.collect()) == list(range(1, 12))
    assert [r.object_key for r in failed.collect()] == ["c/t/app/p/bad.json.gz"]

    keys = R.fallback_keys(R.parse_stats(R.parse_lines(lines)))
    assert {r.object_key for r in keys.collect()} == {"c/t/app/p/pretty.json.gz", "c/t/app/p/bad.json.gz"}
    whole = R.parse_whole_objects(spark, root, keys)
    got = {(r.object_key, r.m) for r in whole.select("object_key", F.try_variant_get("record", "$.message", "string").alias("m")).collect()}
    assert got == {("c/t/app/p/pretty.json.gz", "6"), ("c/t/app/p/pretty.json.gz", "7"), ("c/t/app/p/bad.json.gz", None)}
    assert O.read_whole_objects(spark, root).count() == len(FILES)
    listing = O.list_objects(spark, root, "bucket")
    assert {r.object_key for r in listing.collect()} == set(FILES)


def test_file_order_is_kept(spark, tmp_path):
    put(str(tmp_path), "a.json", "\n".join(str(i) for i in range(5000)))
    lines = O.read_log_objects(spark, str(tmp_path)).orderBy("line_no").collect()
    assert [int(r.line) for r in lines] == list(range(5000))


def test_copies(spark, tmp_path):
    source, target = tmp_path / "s", tmp_path / "d"
    put(str(source), "central/c/t/a/p/f.json.gz", "hello")
    os.makedirs(target / "t-logs")
    rows = [("central", "c/t/a/p/f.json.gz", "s3", "t", "a", "p", b, "pre") for b in ("t-logs", "nowhere")]
    rows += [("central", "c/t/a/p/gone.json.gz", "s3", "t", "a", "p", "t-logs", "pre"), rows[0]]
    routed = spark.createDataFrame(
        rows, "bucket string, object_key string, type string, tenant_id string, application string, pod_name string, bucket_name string, bucket_prefix string")
    plan = plan_object_copies(routed, AS_OF)
    meta = plan.first().metadata
    assert meta["delivery-timestamp"] == "1704110400" and "cluster-id" not in meta and len(meta) == 6
    for _ in range(2):  # a repeated run leaves the same object
        every = copies.execute_copies(plan, str(source), str(target), 2).collect()
        assert len(every) == len(rows) and sorted(r.superseded for r in every) == [False, False, False, True]
        done = {(r.dst_bucket, r.dst_key): (r.succeeded, r.error_class) for r in every}
        assert done == {
            ("t-logs", "pre/t/a/p/f.json.gz"): (True, None),
            ("nowhere", "pre/t/a/p/f.json.gz"): (False, "non_recoverable"),
            ("t-logs", "pre/t/a/p/gone.json.gz"): (False, "non_recoverable"),
        }
    put(str(source), "central/c2/t/a/p/f.json.gz", "newer")
    late = plan.withColumn("upload_ms", F.lit(1)).limit(1).unionByName(
        plan.limit(1).withColumns({"object_key": F.lit("c2/t/a/p/f.json.gz"), "upload_ms": F.lit(0)}))
    both = copies.execute_copies(late, str(source), str(target), 2).collect()
    assert {(r.object_key, r.succeeded, r.superseded) for r in both} == {("c/t/a/p/f.json.gz", True, False), ("c2/t/a/p/f.json.gz", True, True)}
    made = [os.path.join(d, f) for d, _, fs in os.walk(target) for f in fs]
    assert [os.path.basename(m) for m in made] == ["f.json.gz"]
    assert gzip.decompress(open(made[0], "rb").read()) == b"hello"


def pod(i, message, app="app", namespace="t1", label="true"):
    return (message, None, (namespace, f"pod-{i % 2}", {"app": app} if app else {}, {"hosted": label}))


def test_collector_and_router_streams_equal_batch(spark, tmp_path):
    logs = str(tmp_path / "logs")
    rows = [pod(i, json.dumps({"ts": 1_704_100_000 + i, "msg": f"m{i}"})) for i in range(30)]
    rows += [pod(1, "2024-01-01T06:11:26.816Z text", None), pod(1, "hidden", label="false"), pod(0, "other tenant", namespace="t2")]
    spark.createDataFrame(rows, POD_LOG).repartition(3).write.json(logs)
    store = str(tmp_path / "store")
    stream = collector.read_pod_logs(spark, logs, files_per_batch=1)
    collector.start_collector(stream, "prod-1", store, str(tmp_path / "c1"), ("hosted", "true"), AS_OF, once=True).awaitTermination()
    lines = central.read_central(spark, store).collect()
    assert len(lines) == 32
    record = next(json.loads(r.line) for r in lines if "text" in r.line)
    assert record["timestamp"] == "2024-01-01T06:11:26.816000Z" and record["application"] == "unknown"
    assert record["ingest_timestamp"] == "2024-01-01T12:00:00.000000Z"
    assert all(r.object_key.startswith("prod-1/t") and r.object_key.endswith(".json.gz") for r in lines)

    out = str(tmp_path / "out")
    cfg = table(spark, cw("t1"), s3("t1", desired_logs=["nothing"]), s3("t2"))
    conf = router.RouterConf(store, "central", out, str(tmp_path / "c2"), lambda: cfg, AS_OF, files_per_batch=2, max_events=4, chunks=3)
    router.start_router(spark, conf, once=True).awaitTermination()
    batches = spark.read.parquet(f"{out}/batches").collect()
    assert sum(r.events for r in batches) == 31 and max(r.events for r in batches) <= 4
    assert {r.log_stream for r in batches} == {"pod-0", "pod-1"}
    copied = spark.read.parquet(f"{out}/copies").collect()
    assert [(r.tenant_id, r.dst_bucket) for r in copied] == [("t2", "t2-logs")]
    assert spark.read.parquet(f"{out}/rejects").count() == 0

    # The same lines in one batch deliver the same messages.
    kept = central.read_central(spark, store).withColumn("upload_ms", F.lit(AS_OF))
    whole = router.route_lines(kept, cfg, "central", AS_OF, 4, 10**6, 3)["batches"].collect()
    def sent(rows):
        return sorted((e.event_ts_ms, e.message) for r in rows for e in r.log_events)
    assert sent(whole) == sent(batches)
    # A second start finds nothing new.
    router.start_router(spark, conf, once=True).awaitTermination()
    assert spark.read.parquet(f"{out}/batches").count() == len(batches)


def run(spark, stream, path):
    query = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", path + "-c").option("path", path)
    query.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def test_heartbeat_alerts(spark, tmp_path):
    beats = [("a", 0), ("a", 120), ("a", 420), ("a", 721), ("b", 700), ("c", 5000)]
    rows = spark.createDataFrame(beats, "cluster_id string, s int").selectExpr("cluster_id", "timestamp_seconds(s) ts")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    got = run(spark, liveness.heartbeat_alerts(stream), str(tmp_path / "out"))
    found = got.select("cluster_id", F.unix_seconds("last_beat").alias("s"), "beats").collect()
    # 300 s between 120 and 420 is no silence yet; 301 s is.
    assert sorted(map(tuple, found)) == [("a", 420, 3), ("a", 721, 1), ("b", 700, 1)]


def test_silence_alert_without_further_beats(spark, tmp_path):
    rows = spark.createDataFrame([("a", 10), ("a", 70), ("b", 40)], "cluster_id string, s int").selectExpr("cluster_id", "timestamp_seconds(s) ts")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = liveness.silence_alerts(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), max_gap_s=2, event_time=False, forget_s=3600)
    seen = []
    query = stream.writeStream.outputMode("append").foreachBatch(lambda df, n: seen.extend(df.select("cluster_id").collect()))
    running = query.option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="500 milliseconds").start()
    for _ in range(120):
        if len(seen) >= 2:
            break
        time.sleep(0.5)
    running.stop()
    assert sorted(map(tuple, seen)) == [("a",), ("b",)]


def test_silence_alerts_in_event_time(spark, tmp_path):
    """Late beats close a gap, a key that never beats and one that falls silent last are found, and each silence once."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    known = spark.createDataFrame([("a", 0), ("never", 5), ("late", 5)], "cluster_id string, s int").selectExpr("cluster_id", "timestamp_seconds(s) ts")
    batches = [[("a", 100), ("a", 900), ("b", 1)], [("a", 500), ("b", 1500), ("late", 300)], [("a", 1300), ("c", 5000)], [("c", 5300)]]
    for beats in batches:  # one micro-batch each, in runs of their own: state and timers come back from the checkpoint
        rows = spark.createDataFrame(beats, "cluster_id string, s int").selectExpr("cluster_id", "timestamp_seconds(s) ts")
        rows.coalesce(1).write.mode("append").parquet(source)
        stream = liveness.silence_alerts(spark.readStream.schema(rows.schema).parquet(source), max_gap_s=400, lateness="1000 seconds", known=known)
        writer = stream.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", str(tmp_path / "c"))
        writer.trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(out).select("cluster_id", F.unix_seconds("last_beat"), F.unix_seconds("silent_from")).collect()
    # 100, 500, 900 and 1300 are 400 s apart, no silence; the beat at 500 came a batch late.
    assert sorted(map(tuple, got), key=str) == sorted([("a", 1300, 1300), ("b", 1, 1), ("b", 1500, 1500), ("late", 300, 300), ("never", None, 5)], key=str)


def test_late_beats_are_kept_and_counted(spark, tmp_path):
    schema = "cluster_id string, ts timestamp"
    source = str(tmp_path / "in")
    for k, beats in enumerate([[("a", 0), ("a", 900)], [("a", 600), ("a", 900)], [("a", -9000), ("a", 9000)], [("a", 9100)]]):  # one micro-batch each
        rows = spark.createDataFrame(beats, "cluster_id string, s int").selectExpr("cluster_id", "timestamp_seconds(s) ts")
        rows.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        out = liveness.heartbeat_alerts(stream, lateness="10 minutes")
        writer = out.writeStream.format("parquet").outputMode("append").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c"))
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        late = liveness.late_rows(query)
        assert late == (1 if k == 2 else 0)
    found = spark.read.parquet(str(tmp_path / "out")).select(F.unix_seconds("first_beat").alias("f"), F.unix_seconds("last_beat").alias("l"), "beats")
    # The beat at 600, ten minutes late at most, bridges no gap but counts as a session of its own with the one at 900.
    assert sorted(map(tuple, found.collect())) == [(0, 0, 1), (600, 900, 3)]


def test_stream_dedupe_and_statistics(spark, tmp_path):
    rows = spark.createDataFrame([("x", 10, 1.0), ("x", 20, 2.0), ("y", 30, 4.0), ("z", 9000, 0.0)], "metric string, s int, value double")
    rows = rows.selectExpr("metric", "timestamp_seconds(s) ts", "value", "'t' tenant")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    once = run(spark, liveness.dedupe_stream(stream, ["metric"]), str(tmp_path / "d"))
    assert sorted(r.metric for r in once.collect()) == ["x", "y", "z"]
    stats = run(spark, liveness.stream_metric_statistics(stream, 300), str(tmp_path / "s"))
    assert sorted((r.metric, r["sum"], r.average) for r in stats.collect()) == [("x", 3.0, 1.5), ("y", 4.0, 4.0)]


def test_config_scan(spark, tmp_path):
    cfg = table(spark, cw("a"), s3("b", desired_logs=["x"]))
    cfg.write.parquet(str(tmp_path / "p"))
    cfg.write.json(str(tmp_path / "j"))
    for fmt, name in (("parquet", "p"), ("json", "j")):
        rows = read_tenant_configs(spark, str(tmp_path / name), fmt).collect()
        assert {(r.tenant_id, r.type, r.enabled) for r in rows} == {("a", "cloudwatch", True), ("b", "s3", True)}


def test_store_is_listed_read_and_written_by_tasks(spark, tmp_path):
    """No file status reaches the driver: Spark's own file index does not appear in the plans."""
    folder = str(tmp_path / "a b")
    odd = [("c:1", "t/1", "a%b", None), ("c:1", "", "é", "p=1"), ("c", "t", "a", "p"), ("c:1", None, "é", "p=1")]
    rows = [(*d, f"line {i} é") for i, d in enumerate(odd * 40)]
    df = spark.createDataFrame(rows, "cluster_id string, namespace string, application string, pod_name string, message string")
    wide = max(len(json.dumps(dict(zip(df.columns, r)), ensure_ascii=False, separators=(",", ":")).encode()) for r in rows) + 1
    for mode in ("overwrite", "overwrite", "append"):
        central.write_central(df.repartition(3), folder, mode, 3 * wide)
    stored = central.read_central(spark, folder)
    got = stored.collect()
    assert sorted(json.loads(r.line)["message"] for r in got) == sorted([r[-1] for r in rows] * 2)
    assert {r.object_key.rsplit("/", 1)[0] for r in got} == {"c:1/t/1/a%b/", "c:1//é/p=1", "c/t/a/p"}
    files = [os.path.join(d, f) for d, _, fs in os.walk(folder) for f in fs]
    assert all(f.endswith(".json.gz") and not os.path.basename(f).startswith(".") for f in files)
    assert len({r.object_key for r in got}) == len(files)
    assert max(len(gzip.open(f).read()) for f in files) <= 3 * wide
    # The layout is that of Spark's partitioned writes.
    assert spark.read.json(folder).select("key_cluster_id", "key_application").distinct().count() == 3
    put(folder, "_hidden/x.json", "no")
    put(folder, "top.json", "plain\r\n\n﻿last")
    assert [r.line for r in O.read_log_objects(spark, folder).where("object_key = 'top.json'").orderBy("line_no").collect()] == ["plain\r", "", "﻿last"]
    listing = O.list_objects(spark, folder, "b")
    assert listing.count() == len(files) + 1
    for df in (listing, stored, O.read_each_object(spark, folder)):
        assert "FileScan" not in df._jdf.queryExecution().sparkPlan().toString()


def test_large_plain_objects_are_read_in_parts(spark, tmp_path):
    rng = random.Random(4)
    text = "\n".join("x" * rng.choice([0, 0, 1, 5, 30, 90]) + str(i) * (i % 3) for i in range(500))
    for name, content in (("a", text), ("b", text + "\n"), ("c", "\n\n"), ("d", "y" * 99)):
        (tmp_path / name).write_bytes(content.encode())
        want = content.removesuffix("\n").split("\n")
        from pyarrow import fs

        store = fs.LocalFileSystem()
        for step in (1, 7, 64):
            parts = [x for a in range(0, len(content) + 1, step) for x in O._lines_of(store, str(tmp_path / name), a, a + step)]
            assert [x.decode() for _, x in parts] == want and [p for p, _ in parts] == sorted({p for p, _ in parts})


def test_one_row_an_object_whatever_its_size(spark):
    """The index of a small object is small; runs across two lines are not in it."""
    from tributary.operators import search as S

    lines = spark.createDataFrame([("a", "abc"), ("a", "def"), ("b", "abcdef"), ("c", None), ("c", "xy")], "object_key string, line string").coalesce(1)
    index = {r.object_key: list(r.bits) for r in S.build_index(lines).collect()}
    assert {k: len(v) for k, v in index.items()} == {"a": 2, "b": 4, "c": 0}
    assert sorted(r.object_key for r in S.may_hold(S.build_index(lines), "xy").collect()) == ["a", "b", "c"]


class _State:
    """One bucket's state store and timers, with a count of the calls."""

    def __init__(self):
        self.value, self.timers, self.calls, self.now = None, set(), 0, 0

    def getValueState(self, name, schema, ttl=None):  # noqa: N802
        return self

    def exists(self):
        self.calls += 1
        return self.value is not None

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def clear(self):
        self.calls += 1
        self.value = None

    def registerTimer(self, at):  # noqa: N802
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):  # noqa: N802
        self.calls += 1
        self.timers.remove(at)

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.now


def _outcome(events, end, max_receive=3, hidden=50, kept=1000):
    """Outcome of one message by the time ``end``, from all of its events in order."""
    sent = min((at for kind, at in events if kind == "sent"), default=None)
    deleted = min((at for kind, at in events if kind == "deleted"), default=None)
    received = sorted(at for kind, at in events if kind == "received")
    over = None if sent is None else sent + kept
    if len(received) >= max_receive:
        last = received[max_receive - 1] + hidden
        if last <= end and not (deleted is not None and deleted <= last) and not (over is not None and last > over):
            return ("dead_letter", last, max_receive)
    if over is not None and over <= end and not (deleted is not None and deleted <= over):
        return ("expired", over, len(received))
    return None


def test_messages_share_state():
    """Two thousand messages of one bucket, plainly judged, in a few state calls a micro-batch."""
    rng, events = random.Random(9), {}
    for i in range(2000):
        start = rng.randrange(0, 600)
        mine = [("sent", start)] * (rng.random() < 0.95) + [("received", start + rng.randrange(0, 700)) for _ in range(rng.randrange(0, 6))]
        events[f"m{i}" if i else None] = mine + [("deleted", start + rng.randrange(0, 900))] * (rng.random() < 0.3)
    rows = sorted(((at, key, kind) for key, mine in events.items() for kind, at in mine), key=lambda r: (r[0] + rng.randrange(0, 100), str(r)))
    state, got = _State(), []
    watch = liveness.MessageWatch("message_id", 3, 50, 1000)
    watch.init(state)
    batches, timer = [rows[a : a + 1500] for a in range(0, len(rows), 1500)], lambda at: SimpleNamespace(getExpiryTimeInMs=lambda: at)
    newest = 0
    for batch in [*batches, []]:
        if batch:
            frame = pd.DataFrame({"message_id": [r[1] for r in batch], "kind": [r[2] for r in batch], "at_ms": [r[0] for r in batch]})
            got += [x for f in watch.handleInputRows((0,), iter([frame[:700], frame[700:]]), state) for x in f.itertuples(index=False)]
            newest = max(newest, *(r[0] for r in batch))
        state.now = newest - 100 if batch else 1500
        while due := [t for t in state.timers if t <= state.now]:
            got += [x for f in watch.handleExpiredTimer((0,), state, timer(min(due))) for x in f.itertuples(index=False)]
            state.timers.discard(min(due))
    plain = {(key, *found) for key, mine in events.items() if (found := _outcome(mine, 1500))}
    assert len(got) == len(plain) > 500 and {tuple(x) for x in got} == plain
    assert state.calls <= 10 * (len(batches) + 1)


def test_message_outcomes_of_numbered_messages(spark, tmp_path):
    """Keys that are no text, and a null one, come back as they were."""
    rows = [(k, "sent", 1) for k in (1, 2, 2**60 + 1, None)] + [(2**60 + 1, "received", 1 + j) for j in range(3)] + [(2, "deleted", 5), (3, "sent", 10_000)]
    df = spark.createDataFrame(rows, "id bigint, kind string, s long").selectExpr("id", "kind", "timestamp_seconds(s) ts")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    got = run(spark, liveness.message_outcomes(stream, "id", "1 second", visibility_s=10, retention_s=1000, buckets=2), str(tmp_path / "out"))
    assert got.schema["id"].dataType.typeName() == "long"
    found = {tuple(r) for r in got.collect()}
    assert found == {(1, "expired", 1_001_000, 0), (None, "expired", 1_001_000, 0), (2**60 + 1, "dead_letter", 13_000, 3)}


def test_router_notes_objects_in_tasks(spark, tmp_path, monkeypatch):
    """Files of notes, not objects, reach the stream's file source; objects that come later are delivered once."""
    monkeypatch.setattr(router, "INTERVAL_S", 1)
    store, out, ckpt = (str(tmp_path / n) for n in ("store", "out", "ckpt"))
    for i in range(12):
        put(store, f"c/t1/app/p{i}/x.json.gz", f'{{"message":"m{i}"}}\n')
    conf = router.RouterConf(store, "central", out, ckpt, lambda: table(spark, cw("t1")), AS_OF, files_per_batch=5, chunks=2)
    router.start_router(spark, conf, once=True).awaitTermination()
    known = "".join(open(os.path.join(d, f), errors="replace").read() for d, _, fs in os.walk(f"{ckpt}/sources") for f in fs if not f.startswith("."))
    assert "x.json.gz" not in known and 3 <= known.count('"path"') <= 6
    sent = lambda: sorted(e.message for r in spark.read.parquet(f"{out}/batches").collect() for e in r.log_events)
    assert sent() == sorted(f"m{i}" for i in range(12))
    query = router.start_router(spark, conf)
    try:
        put(store, "c/t1/app/later/x.json.gz", '{"message":"later"}\n')
        until = time.time() + 60
        while time.time() < until and "later" not in sent():
            time.sleep(1)
    finally:
        query.stop()
    assert sent() == sorted([*(f"m{i}" for i in range(12)), "later"])


def test_router_goes_on_from_a_checkpoint_without_notes(spark, tmp_path, monkeypatch):
    store, out, ckpt = (str(tmp_path / n) for n in ("store", "out", "ckpt"))
    conf = router.RouterConf(store, "central", out, ckpt, lambda: table(spark, cw("t1")), AS_OF, chunks=2)
    put(store, "c/t1/app/p/first.json.gz", '{"message":"first"}\n')
    with monkeypatch.context() as m:
        m.setattr(router, "store_root", lambda *a: None)  # as on a file system that tasks cannot open
        router.start_router(spark, conf, once=True).awaitTermination()
    put(store, "c/t1/app/p/second.json.gz", '{"message":"second"}\n')
    router.start_router(spark, conf, once=True).awaitTermination()
    assert sorted(e.message for r in spark.read.parquet(f"{out}/batches").collect() for e in r.log_events) == ["first", "second"]
