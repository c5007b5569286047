import json

from tributary.operators import records as R
from tributary.sources import notifications as N

AS_OF = 42


def events(spark, lines, key="k.json"):
    df = spark.createDataFrame([(key, i, x) for i, x in enumerate(lines)], "object_key string, line_no bigint, line string")
    return df


def messages(spark, lines):
    rows = R.to_log_events(R.parse_lines(events(spark, lines)), AS_OF).collect()
    return [(r.event_ts_ms, r.message) for r in sorted(rows, key=lambda r: (r.line_no, r.item_no))]


def test_conversion(spark):
    all_metadata = {
        "cluster_id": "c", "namespace": "n", "application": "a", "pod_name": "p", "ingest_timestamp": 1,
        "timestamp": 1704110400, "kubernetes": {"x": 1}, "custom_field": "v",
    }
    lines = [
        '{"timestamp":"2024-01-01T12:00:00Z","message":"hello"}',
        '{"timestamp":1704110400,"level":"info","data":{"b":1,"a":[1,2.5,null]}}',
        json.dumps(all_metadata),
        '"just a string"',
        '{"message":{"z":1,"a":"<b>&"}}',
        '{"message":null}',
        '{"message":12}',
        '{"message":""}',
        "{}",
    ]
    assert messages(spark, lines) == [
        (1704110400000, "hello"),
        (1704110400000, '{"data":{"a":[1,2.5,null],"b":1},"level":"info"}'),
        (1704110400000, '{"custom_field":"v"}'),
        (42, '{"a":"\\u003cb\\u003e\\u0026","z":1}'),
        (42, "null"),
        (42, "12"),
        (42, ""),
        (42, "{}"),
    ]


def test_line_shapes(spark):
    lines = ['{"message":"1"}', '[{"message":"2"},{"message":"3"}]', "", "  \t", "not json", '{"message":"4"}\r', "[]",
             '{"message":"5"} x', '{"message":"6"}{"message":"7"}', "{'message':'8'}", '{"message":"9","message":"10"}']
    assert [m for _, m in messages(spark, lines)] == ["1", "2", "3", "4", "10"]
    stats = R.parse_stats(R.parse_lines(events(spark, lines))).first()
    assert (stats.lines_ok, stats.lines_error, stats.events) == (5, 4, 5)


def test_fallback_only_without_events(spark):
    pretty = ["{", '"message":', '"x"', "}"]
    mixed = events(spark, ['{"message":"ok"}', "{", "}"], "mixed.json").unionByName(events(spark, pretty, "pretty.json"))
    mixed = mixed.unionByName(events(spark, ["this is not json at all"], "bad.json"))
    mixed = mixed.unionByName(events(spark, ["12"], "scalar.json")).unionByName(events(spark, [""], "empty.json"))
    found, failed = R.object_events(mixed, AS_OF)
    assert {(r.object_key, r.message) for r in found.collect()} == {("mixed.json", "ok"), ("pretty.json", "x")}
    assert [(r.object_key, r.error_class) for r in failed.collect()] == [("bad.json", "recoverable")]


def test_skip_processed(spark):
    df = R.to_log_events(R.parse_lines(
        events(spark, [f'{{"message":"{i}"}}' for i in range(5)], "a").unionByName(
            events(spark, ['[{"message":"x"},{"message":"y"},{"message":"z"}]'], "b"))), AS_OF)
    for offset, left in {0: 5, 2: 3, 5: 0, 6: 0, -1: 5, 10**9: 0}.items():
        offsets = spark.createDataFrame([("a", offset)], "object_key string, offset bigint")
        kept = R.skip_processed(df, offsets).collect()
        assert sum(r.object_key == "a" for r in kept) == left
        assert sum(r.object_key == "b" for r in kept) == 3
    offsets = spark.createDataFrame([("b", 2)], "object_key string, offset bigint")
    assert {r.message for r in R.skip_processed(df, offsets).collect() if r.object_key == "b"} == {"z"}


def body(key, bucket="b", **extra):
    note = {"Records": [{"s3": {"bucket": {"name": bucket}, "object": {"key": key}}}]}
    return json.dumps({"Message": json.dumps(note), **extra})


def test_notifications(spark):
    cases = {
        "good": body("c/t/app/pod/f.json.gz"),
        "plus": body("a+b%2Fc"),
        "not-json": "invalid",
        "bad-inner": json.dumps({"Message": "invalid json content here"}),
        "object-inner": json.dumps({"Message": {"Records": []}}),
        "no-message": "{}",
        "lower": json.dumps({"message": json.dumps({"Records": []})}),
        "no-records": json.dumps({"Message": "{}"}),
        "no-key": json.dumps({"Message": json.dumps({"Records": [{"s3": {"bucket": {"name": "b"}, "object": {}}}]})}),
        "bad-escape": body("a%zz"),
        "meta": body("k", processing_metadata={"offset": 3, "retry_count": 1}),
        "bad-meta": body("k", processing_metadata={"offset": "3"}),
        "bad-stamp": body("k", processing_metadata={"requeued_at": "yesterday"}),
    }
    df = spark.createDataFrame(list(cases.items()), "message_id string, body string")
    got = {r.message_id: r for r in N.parse_notifications(df).collect()}
    assert len(got) == len(cases)
    two = json.dumps({"Message": json.dumps({"Records": [{"s3": {"bucket": {"name": "b"}, "object": {"key": k}}} for k in ("good.gz", "bad%zz", "behind.gz")]})})
    rows = N.parse_notifications(spark.createDataFrame([("m", two)], "message_id string, body string")).orderBy("record_idx").collect()
    assert [(r.record_idx, r.object_key, r.error_code) for r in rows] == [(0, "good.gz", None), (1, None, "invalid_escape")]
    keys = {"good": "c/t/app/pod/f.json.gz", "plus": "a b/c", "no-key": "", "meta": "k"}
    assert {k: r.object_key for k, r in got.items() if r.object_key is not None} == keys
    errors = {k: (r.error_class, r.error_code) for k, r in got.items() if r.error_code}
    assert errors == {
        "not-json": ("non_recoverable", "invalid_envelope"),
        "bad-inner": ("non_recoverable", "invalid_notification"),
        "object-inner": ("non_recoverable", "invalid_notification"),
        "no-message": ("non_recoverable", "invalid_notification"),
        "bad-escape": ("non_recoverable", "invalid_escape"),
        "bad-meta": ("recoverable", "invalid_metadata"),
        "bad-stamp": ("recoverable", "invalid_metadata"),
    }
    assert (got["meta"].offset, got["meta"].retry_count) == (3, 1)
    assert (got["good"].offset, got["good"].retry_count) == (0, 0)


def test_manual_input(spark):
    row = N.process_bodies(spark, [body("c/t/app/pod/f.json.gz")]).first()
    assert (row.message_id, row.bucket, row.object_key) == ("manual-input", "b", "c/t/app/pod/f.json.gz")
