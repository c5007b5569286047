import json

import pytest
from pyspark.sql import functions as F

from tributary.sinks.commits import RunStore
from tributary.streaming import delivery
from tests_support import cw, s3, table

NOW = 1_706_659_200_000
SCHEMA = "message_id string, body string, receipt_handle string, receive_count int, sent_ms bigint, visible_ms bigint"
GOOD, BAD, GONE = ("c/t1/app/p/good.json.gz", "c/t1/app/p/bad.json.gz", "c/t1/app/p/gone.json.gz")


def body(*keys, **meta):
    records = [{"s3": {"bucket": {"name": "b"}, "object": {"key": k}}} for k in keys]
    return json.dumps({"Message": json.dumps({"Records": records})} | ({"processing_metadata": meta} if meta else {}))


def message(name, text, handle="rh", received=0, sent=NOW - 1000, visible=NOW - 1000):
    return (name, text, handle, received, sent, visible)


@pytest.fixture
def made(spark, tmp_path):
    """A configuration whose destination refuses the deliveries named in ``refused``."""
    lines = [(GOOD, i, json.dumps({"message": f"m{i}", "timestamp": (NOW - 60_000 * (9 - i))}), None) for i in range(9)]
    lines += [(BAD, 0, None, "corrupt")]
    objects = spark.createDataFrame(lines, "object_key string, line_no bigint, line string, error_code string")
    listing = spark.createDataFrame([(GOOD, NOW - 5000), (BAD, NOW - 5000)], "object_key string, upload_ms bigint")
    configs = table(spark, cw("t1"), s3("t1"))
    refused = {"until": 0}

    def send(as_of):
        accept = delivery.accept_in_time(as_of)
        return lambda batches: accept(batches).withColumn("failed", F.lit(refused["until"]) > as_of)

    conf = delivery.DeliveryConf(
        str(tmp_path / "out"), lambda keys: listing.join(keys, "object_key", "left_semi"), lambda keys: objects.join(keys, "object_key", "left_semi"), lambda: configs, send,
        clock=lambda run: NOW + run * 1_000_000, max_events=4, chunks=2,
    )
    return conf, refused, RunStore(spark, conf.output)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_failed_deliveries_come_back_alone(spark, made):
    conf, refused, store = made
    refused["until"] = NOW + 1
    delivery.deliver(spark, conf, frame(spark, message("m1", body(GOOD, offset=2, retry_count=1)), message("m2", body(GOOD), handle="")), "first")
    first = {(r.message_id, r.type): (r.succeeded, r.events) for r in store.read("attempts").collect()}
    assert first == {("m1", "cloudwatch"): (False, 7), ("m1", "s3"): (True, 0), ("m2", "cloudwatch"): (False, 9), ("m2", "s3"): (True, 0)}
    waiting = store.read("queue").collect()
    assert [(r.message_id, r.only, r.receive_count, r.visible_ms - NOW) for r in waiting] == [("m1", [f"cloudwatch {GOOD}"], 0, 4000)]  # without a handle nothing goes back
    meta = json.loads(waiting[0].body)["processing_metadata"]
    assert (meta["offset"], meta["retry_count"], meta["original_receipt_handle"]) == (2, 2, "rh")

    delivery.deliver(spark, conf)
    second = store.read("attempts").where("run = 1").collect()
    assert [(r.message_id, r.type, r.retry_count, r.succeeded, r.successful_events) for r in second] == [("m1", "cloudwatch", 2, True, 7)]
    assert store.read("batches").where("run = 1").agg(F.sum("events")).first()[0] == 7
    assert store.read("queue").where("run = 1").isEmpty()
    latency = store.read("metrics").where("run = 1 and metric like '%latency'").collect()
    assert [(r.metric, r.value) for r in latency] == [("LogCount/cloudwatch/delivery_latency", 1_005_000.0)]


def test_retry_limit_and_unreadable_objects(spark, made):
    conf, refused, store = made
    refused["until"] = 2**60
    delivery.deliver(spark, conf, frame(spark, message("m", body(GOOD, retry_count=2)), message("lost", body(BAD, GONE, retry_count=3))), "s")
    for _ in range(3):
        delivery.deliver(spark, conf)
    tries = store.read("attempts").where("type = 'cloudwatch'").groupBy("run", "message_id", "object_key").agg(F.sum("failed_events")).collect()
    assert sorted(map(tuple, tries)) == [(0, "lost", BAD, 1), (0, "lost", GONE, 0), (0, "m", GOOD, 9), (1, "m", GOOD, 9)]
    copies = {(r.object_key, r.succeeded) for r in store.read("attempts").where("type = 's3'").collect()}
    assert copies == {(GOOD, True), (BAD, True), (GONE, False)}
    assert store.read("queue").where("run > 0").isEmpty()


def test_unclear_messages_become_dead_letters(spark, made):
    conf, _, store = made
    broken = body(GOOD)[:-1] + ', "processing_metadata": "x"}'
    rows = [message("unclear", broken), message("old", body(GOOD), sent=NOW - 15 * 86_400_000), message("later", body("nonsense"), visible=NOW + 2_500_000), message("no json", "{")]
    delivery.deliver(spark, conf, frame(spark, *rows), "s")
    for _ in range(4):
        delivery.deliver(spark, conf)
    seen = {name: sorted((r.run, r.message_id) for r in store.read(name).collect()) for name in ("item_failures", "dead_letters", "expired", "rejects") if name != "item_failures"}
    assert seen == {"dead_letters": [(3, "unclear")], "expired": [(0, "old")], "rejects": [(0, "no json"), (0, "unclear"), (1, "unclear"), (2, "unclear"), (3, "later")]}
    assert [r.item_identifier for r in store.read("item_failures").collect()] == ["unclear"] * 3
    assert delivery.untaken_messages(store).isEmpty()


def test_half_written_runs_stay_invisible(spark, made):
    conf, _, store = made
    messages = frame(spark, message("m", body(GOOD)))
    run = delivery.deliver(spark, conf, messages, "s")
    store.write(1, {"attempts": store.read("attempts").drop("run"), "queue": store.read("queue").drop("run")})  # as if the job died before its manifest
    assert store.read("attempts").count() == 2 and [r.run for r in store.runs()] == [0]
    assert delivery.deliver(spark, conf, messages, "s") == run  # replayed after its commit: nothing happens
    assert not store.commit(0, "s", NOW, "other", run.schemas)
    assert delivery.deliver(spark, conf, frame(spark, message("n", body(GOOD))), "t").run == 1
    assert {(r.run, r.message_id) for r in store.read("attempts").collect()} == {(0, "m"), (1, "n")}
    assert store.sweep() >= 2 and store.sweep() == 0
    assert store.read("attempts").count() == 4
    assert run.counts["lines"] == 9 and run.counts["events"] == 9


def test_time_does_not_go_back(spark, made):
    conf, _, _ = made
    delivery.deliver(spark, conf, frame(spark, message("m", body(GOOD))), "s")
    from dataclasses import replace

    with pytest.raises(ValueError):
        delivery.deliver(spark, replace(conf, clock=lambda run: NOW - 1))


def test_stream_of_messages(spark, made, tmp_path):
    conf, refused, store = made
    refused["until"] = NOW + 1_500_000  # the first two runs fail
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "ckpt")
    for k in range(3):
        frame(spark, message(f"m{k}", body(GOOD))).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        delivery.start_deliveries(stream, conf, checkpoint, once=True).awaitTermination()
    done = store.read("attempts").where("type = 'cloudwatch'").select("run", "message_id", "succeeded").collect()
    assert sorted(map(tuple, done)) == [(0, "m0", False), (1, "m0", False), (1, "m1", False), (2, "m0", True), (2, "m1", True), (2, "m2", True)]


def test_runs_read_inputs_written_once(spark, monkeypatch):
    """No run derives the stored lines, the listing or the messages from the events again."""
    from tributary.plans import catalog_delivery
    from tributary.plans.registry import Tables

    seen = []
    monkeypatch.setattr(delivery, "start_deliveries", lambda messages, conf, *a, **k: seen.append(conf) or type("Q", (), {"awaitTermination": lambda self: None})())
    monkeypatch.setattr(delivery, "deliver", lambda spark, conf: None)
    t = Tables(spark, "/root/testdata/sf0.001")
    catalog_delivery.delivered(t)
    keys = spark.createDataFrame(t.stored.select("object_key").distinct().collect())
    for made, rows in ((seen[0].objects(keys).drop("error_code"), t.stored), (seen[0].listing(keys), t.listing.selectExpr("object_key", "modified_ms"))):
        assert made.inputFiles() and not any("events.parquet" in f for f in made.inputFiles())
        assert sorted(map(tuple, made.collect())) == sorted(map(tuple, rows.collect()))
