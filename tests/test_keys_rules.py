from pyspark.sql import functions as F

from tributary.functions import keys as K
from tributary.functions import rules as U
from tributary.operators.routing import extract_tenant_info, split_valid_keys


def column(spark, rows, schema, make):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r.x for r in df.select("i", make.alias("x")).orderBy("i").collect()]


def test_key_validity(spark):
    cases = {
        "prod-1/ns/app/pod/file.json.gz": None,
        "c/ns/app/pod/sub/file.json.gz": None,
        "c/ns/app/pod/": None,
        " c /n s/app/pod/f": None,
        "c/ns/app": "too_few_segments",
        "": "too_few_segments",
        "c//app/pod/f": "blank_namespace",
        "/ns/app/pod/f": "blank_cluster_id",
        "c/ns/ /pod/f": "blank_application",
        "c/ns/app/\t/f": "blank_pod_name",
        "//app/pod/f": "blank_cluster_id",
    }
    df = spark.createDataFrame([(k,) for k in cases], "object_key string")
    valid, rejects = split_valid_keys(df)
    assert {r.object_key for r in valid.collect()} == {k for k, v in cases.items() if v is None}
    assert {r.object_key: r.reason for r in rejects.collect()} == {k: v for k, v in cases.items() if v}


def test_tenant_info(spark):
    key = "prod-cluster-1/openshift-logging/fluentd/fluentd-abc123/20240101-uuid.json.gz"
    row = extract_tenant_info(spark.createDataFrame([(key,)], "object_key string")).first()
    assert (row.cluster_id, row.tenant_id, row.namespace) == ("prod-cluster-1", "openshift-logging", "openshift-logging")
    assert (row.application, row.pod_name, row.environment) == ("fluentd", "fluentd-abc123", "production")


def test_environment(spark):
    got = column(spark, [("prod-1",), ("stg-1",), ("dev-1",), ("other-1",), ("stg",), ("x-dev",)], "c string", K.environment(F.col("c")))
    assert got == ["production", "staging", "development", "production", "production", "production"]


def test_destination_key(spark):
    make = K.destination_key(F.col("p"), F.lit("t"), F.lit("app"), F.lit("pod"), F.col("k"))
    rows = [("", "c/t/app/pod/f.json.gz"), (None, "f"), ("custom/path/", "a/f"), ("custom/path", "a/f")]
    assert column(spark, rows, "p string, k string", make) == [
        "ROSA/cluster-logs/t/app/pod/f.json.gz",
        "ROSA/cluster-logs/t/app/pod/f",
        "custom/path/t/app/pod/f",
        "custom/path/t/app/pod/f",
    ]


def test_prefix_and_page_keys(spark):
    assert column(spark, [("",), (None,), ("a",), ("a/",)], "p string", K.slashed_or_empty(F.col("p"))) == ["", "", "a/", "a/"]
    got = column(spark, [("t#s3",), ("t#a#b",), ("t",)], "k string", K.parse_page_key(F.col("k")))
    assert [tuple(r) for r in got] == [("t", "s3"), ("t", "a#b"), ("t", None)]


def test_application_filter(spark):
    listed = ["payment-service", "user-service"]
    rows = [(listed, a) for a in ("payment-service", "user-service", "Payment-Service", "payment", "other")]
    rows += [(None, "x"), ([], "x"), ([""], "x"), (["", "y"], "x"), ([None], "x")]
    got = column(spark, rows, "d array<string>, a string", U.application_enabled(F.col("d"), F.col("a")))
    assert got == [True, True, False, False, False, True, True, True, False, False]


def test_retry_delay(spark):
    got = column(spark, [(n,) for n in (0, 1, 2, 3, 4, 8, 9, 10, 2000)], "n int", U.retry_delay_s(F.col("n")))
    assert got == [2, 4, 8, 16, 32, 512, 900, 900, 900]


def test_copy_errors(spark):
    rows = [("x NoSuchBucket y",), ("AccessDenied",), ("NoSuchKey",), ("SlowDown",), ("RequestTimeout",), (None,)]
    got = column(spark, rows, "m string", U.copy_error_class(F.col("m")))
    assert got == ["non_recoverable"] * 3 + ["recoverable"] * 2 + [None]


def test_validity_rules(spark):
    ids = [("tenant-1",), ("a_b",), ("--",), ("",), ("a b",), ("é1",), ("x" * 128,), ("x" * 129,), (None,)]
    assert column(spark, ids, "t string", U.valid_tenant_id(F.col("t"))) == [
        True, True, False, False, False, True, True, False, False,
    ]
    assert column(spark, [("a.b-c",), ("a_b",), ("..",)], "t string", U.valid_bucket(F.col("t"))) == [True, False, False]
    assert column(spark, [("us-east-1",), ("us_east",), ("x!",)], "t string", U.valid_region(F.col("t"))) == [True, False, False]
    assert column(spark, [("us_east",)], "t string", U.valid_region(F.col("t"), True)) == [True]
    logs = [(None,), ([],), (["a"],), (["a", " "],), ([""],), ([None],)]
    assert column(spark, logs, "t array<string>", U.valid_desired_logs(F.col("t"))) == [True, True, True, False, False, False]


def test_sizes_levels_previews(spark):
    assert column(spark, [("abc",), ("é",), ("",)], "m string", U.event_size(F.col("m"))) == [29, 28, 26]
    levels = [("an ERROR",), ("DEBUG then INFO",), ("none",), ("warn",)]
    assert column(spark, levels, "m string", U.log_level(F.col("m"))) == ["ERROR", "DEBUG", "INFO", "INFO"]
    assert column(spark, [("abcdef",), ("abc",)], "m string", U.preview(F.col("m"), 3)) == ["abc...", "abc"]


def test_unescape(spark):
    rows = [("a%2Fb+c",), ("a%zz",), ("plain",), ("100%",)]
    assert column(spark, rows, "k string", K.unescape_key(F.col("k"))) == ["a/b c", None, "plain", None]
