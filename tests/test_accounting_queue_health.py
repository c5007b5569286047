import json

import pytest

from tributary.operators import accounting as A
from tributary.operators import health as H
from tributary.operators import queue as Q
from tributary.sources.objects import scan_new_objects, update_ledger

NOW = 1_700_000_000_000


def test_rejections(spark):
    rows = [(1, 10, 8, 1, None), (2, 10, None, 2, None), (3, 10, 7, None, None), (4, 10, None, None, 4), (5, 10, None, None, None), (6, 3, 0, 2, 2)]
    df = spark.createDataFrame(rows, "id int, events bigint, too_new_start bigint, too_old_end bigint, expired_end bigint")
    got = {r.id: (r.failed_events, r.successful_events) for r in A.rejection_stats(df).collect()}
    assert got == {1: (4, 6), 2: (3, 7), 3: (3, 7), 4: (5, 5), 5: (0, 10), 6: (9, 0)}


def test_failed_batch_ends_the_delivery(spark):
    rows = [("a", 0, 10, False), ("a", 1, 10, True), ("a", 2, 10, False), ("b", 0, 5, False), ("c", 0, 4, True)]
    df = spark.createDataFrame(rows, "k string, batch_id bigint, events bigint, failed boolean")
    df = df.selectExpr("*", "events as successful_events", "0L as failed_events")
    got = {r.k: (r.successful_events, r.failed_events, r.total_processed) for r in A.event_stats(df, ["k"]).collect()}
    assert got == {"a": (10, 10, 20), "b": (5, 0, 5), "c": (0, 4, 4)}


@pytest.mark.parametrize("ok, bad, verdict", [(100, 0, "successful_delivery"), (50, 10, "failed_delivery"), (0, 0, None)])
def test_event_metrics(spark, ok, bad, verdict):
    df = spark.createDataFrame([("t", ok, bad)], "tenant_id string, successful_events bigint, failed_events bigint")
    rows = A.event_delivery_metrics(df.selectExpr("*", "timestamp_seconds(0) as ts")).collect()
    want = {"LogCount/cloudwatch/successful_events": ok, "LogCount/cloudwatch/failed_events": bad}
    if verdict:
        want[f"LogCount/cloudwatch/{verdict}"] = 1
    assert {r.metric: r.value for r in rows} == want
    assert {(r.tenant, r.unit) for r in rows} == {("t", "Count")}


def test_object_and_latency_metrics(spark):
    df = spark.createDataFrame([("t", "s3", True, 100, 350), ("u", "s3", False, 1, 2)],
                               "tenant_id string, type string, succeeded boolean, upload_ms bigint, delivered_ms bigint")
    df = df.selectExpr("*", "timestamp_seconds(0) as ts")
    assert {(r.tenant, r.metric) for r in A.object_delivery_metrics(df).collect()} == {
        ("t", "LogCount/s3/successful_delivery"), ("u", "LogCount/s3/failed_delivery")}
    assert [(r.metric, r.value) for r in A.latency_metrics(df).collect()] == [("LogCount/s3/delivery_latency", 250.0)]


def test_summaries(spark):
    rows = [("a", None, 2, 1), ("b", "recoverable", 5, 5), ("c", "non_recoverable", 0, 0), ("d", None, 0, 0)]
    df = spark.createDataFrame(rows, "message_id string, error_class string, successful_deliveries bigint, failed_deliveries bigint")
    assert tuple(A.batch_summary(df).first()) == (2, 1, 1, 2, 1)
    assert [r.item_identifier for r in A.batch_item_failures(df).collect()] == ["b"]
    assert {r.message_id: r.action for r in A.message_actions(df).collect()} == {"a": "delete", "b": "retry", "c": "delete", "d": "delete"}


def test_statistics(spark):
    rows = [(0, 1.0), (299, 3.0), (300, 10.0), (900, 7.0)]
    df = spark.createDataFrame(rows, "s int, value double").selectExpr("timestamp_seconds(s) ts", "value", "'m' metric", "'t' tenant")
    got = A.metric_statistics(df, 300, start="1970-01-01 00:00:00", end="1970-01-01 00:15:00").collect()
    assert sorted((r["sum"], r.average, r.maximum) for r in got) == [(4.0, 2.0, 3.0), (10.0, 10.0, 10.0)]


def test_requeue(spark):
    body = json.dumps({"Message": "m", "other": 1, "processing_metadata": {"retry_count": 1, "kept": "yes"}})
    rows = [("a", body, "rh", 7, 1), ("b", '{"Message":"m"}', "rh", 0, 0), ("c", body, "rh", 0, 3), ("d", body, "", 0, 0), ("e", "bad", "rh", 0, 0)]
    df = spark.createDataFrame(rows, "message_id string, body string, receipt_handle string, offset bigint, retry_count bigint")
    got = {r.message_id: r for r in Q.requeue(df, NOW).collect()}
    assert set(got) == {"a", "b"}
    again = json.loads(got["a"].body)
    assert again == {"Message": "m", "other": 1, "processing_metadata": {
        "offset": 7, "retry_count": 2, "kept": "yes", "original_receipt_handle": "rh", "requeued_at": "2023-11-14T22:13:20Z"}}
    assert (got["a"].delay_s, got["a"].visible_ms) == (4, NOW + 4000)
    assert (got["b"].delay_s, got["b"].retry_count) == (2, 1)


def test_retry_five_is_dropped(spark):
    df = spark.createDataFrame([("a", "{}", "rh", 0, 5)], "message_id string, body string, receipt_handle string, offset bigint, retry_count bigint")
    assert Q.requeue(df, NOW).count() == 0


def test_queue_states(spark):
    rows = [("v", 0, NOW - 1, NOW), ("dl", 3, NOW - 1, NOW), ("in", 1, NOW - 1, NOW + 1), ("de", 0, NOW - 1, NOW + 1),
            ("busy", 3, NOW - 1, NOW + 1), ("ex", 3, NOW - 1_209_600_000, NOW)]
    df = spark.createDataFrame(rows, "message_id string, receive_count int, sent_ms bigint, visible_ms bigint")
    live, dead = Q.split_dead_letters(df, NOW)
    assert {r.message_id for r in live.collect()} == {"v", "in", "de", "busy"}
    assert {r.message_id for r in dead.collect()} == {"dl"}
    assert tuple(Q.queue_depth(df, NOW).first()) == (1, 1, 2, 1)
    taken = {r.message_id: (r.receive_count, r.visible_ms) for r in Q.receive(df, NOW).collect()}
    assert taken["v"] == (1, NOW + 900_000) and "in" not in taken


def test_heartbeat_gaps(spark):
    beats = [("a", 0), ("a", 120_000), ("a", 420_000), ("a", 720_001), ("b", 600_000)]
    df = spark.createDataFrame(beats, "cluster_id string, ts_ms bigint")
    got = sorted((r.cluster_id, r.from_ms, r.to_ms, r.ongoing) for r in H.heartbeat_gaps(df, 1_000_000).collect())
    assert got == [("a", 420_000, 720_001, False), ("b", 600_000, 1_000_000, True)]


def test_heartbeat_records(spark):
    rows = [('{"heartbeat":true,"level":"INFO"}',), ('{"heartbeat":false}',), ("heartbeat",), ('{"heartbeat":"x"}',)]
    assert H.heartbeat_records(spark.createDataFrame(rows, "message string")).count() == 1


def test_search_listing_tiers(spark):
    df = spark.createDataFrame([(1, "a ERROR"), (5, '{"level":"ERROR"}'), (9, "ERROR")], "event_ts_ms bigint, message string")
    assert [r.event_ts_ms for r in H.search_events(df, pattern="ERROR", start_ms=2, limit=1).collect()] == [5]
    assert [r.event_ts_ms for r in H.search_events(df, json_path="$.level", equals="ERROR").collect()] == [5]
    day = 86_400_000
    files = spark.createDataFrame([("a//b", NOW), ("c/d", NOW - day), ("e", NOW - 7 * day - 1), ("f", NOW - 90 * day)], "object_key string, modified_ms bigint")
    assert [r.object_key for r in H.audit_keys(files).collect()] == ["a//b"]
    assert {r.object_key: r.tier for r in H.storage_tier(files, NOW).collect()} == {"a//b": "standard", "c/d": "archive", "e": "archive", "f": "deep_archive"}
    assert {r.object_key for r in H.expired_objects(files, NOW).collect()} == {"e", "f"}
    with pytest.raises(ValueError):
        H.expired_objects(files, NOW, 0)


def test_ledger(spark):
    listing = spark.createDataFrame([("a.json.gz",), ("b.json.gz",), ("c.json",)], "object_key string")
    ledger = spark.createDataFrame([("a.json.gz",)], "object_key string")
    assert [r.object_key for r in scan_new_objects(listing, ledger).collect()] == ["b.json.gz"]
    results = spark.createDataFrame([("b.json.gz", False), ("d", True), ("a.json.gz", True)], "object_key string, succeeded boolean")
    assert sorted(r.object_key for r in update_ledger(ledger, results).collect()) == ["a.json.gz", "d"]


def test_dedupe_keeps_the_earliest(spark):
    df = spark.createDataFrame([("k", 5, "late"), ("k", 3, "first"), ("m", 9, "only")], "k string, delivered_ms bigint, note string")
    assert {r.k: r.note for r in A.dedupe_deliveries(df, ["k"]).collect()} == {"k": "first", "m": "only"}
