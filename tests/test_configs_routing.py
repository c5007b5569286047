from pyspark.sql import functions as F

from tributary.constants import APPLICATION_GROUPS
from tributary.operators import configs as C
from tributary.operators import routing as RT
from tributary.schemas import DELIVERY_CONFIG
from tributary.sources.configs import TAGGED_ITEM, decode_items
from tests_support import cw, s3, table

AS_OF = 1_700_000_000_000


def keys(df):
    return sorted((r.tenant_id, r.type) for r in df.collect())


def objects(spark, *paths):
    df = spark.createDataFrame([(p, 1) for p in paths], "object_key string, upload_ms bigint")
    return RT.extract_tenant_info(df)


def test_enabled_rules(spark):
    cfg = table(spark, cw("a"), cw("b", enabled=None), cw("c", enabled=False))
    assert keys(C.enabled_configs(cfg, missing=False)) == [("a", "cloudwatch")]
    assert keys(C.enabled_configs(cfg, missing=True)) == [("a", "cloudwatch"), ("b", "cloudwatch")]


def test_one_bad_config_removes_the_tenant(spark):
    cfg = table(
        spark, cw("good"), s3("good"), cw("bad", log_group_name=" "), s3("bad"),
        cw("off", log_group_name=None, enabled=False), s3("off"), s3("odd", type="ftp"), s3("nobucket", bucket_name=""),
        s3("old", ttl=1_600_000_000), s3("later", ttl=1_800_000_000),
    )
    assert keys(C.routable_configs(cfg, AS_OF)) == [
        ("good", "cloudwatch"), ("good", "s3"), ("later", "s3"), ("off", "s3"),
    ]


def test_routing_and_reasons(spark):
    cfg = table(
        spark, cw("t1"), s3("t1", desired_logs=["app2"]), s3("t2", desired_logs=[""]), s3("t3", enabled=None), cw("t4", log_group_name="")
    )
    objs = objects(spark, "c/t1/app1/p/f", "c/t1/app2/p/f", "c/t2/x/p/f", "c/t3/x/p/f", "c/t4/x/p/f", "c/t5/x/p/f")
    valid = C.routable_configs(cfg)
    want = [("c/t1/app1/p/f", "cloudwatch"), ("c/t1/app2/p/f", "cloudwatch"), ("c/t1/app2/p/f", "s3"), ("c/t2/x/p/f", "s3")]
    for routed in (RT.route(objs, valid), RT.route(objs, valid, salt=4), RT.route_exploded(objs, valid)):
        assert sorted((r.object_key, r.type) for r in routed.collect()) == want
    reasons = {r.tenant_id: r.reason for r in RT.unroutable(objs, cfg, valid).collect()}
    assert reasons == {"t3": "none_enabled", "t4": "invalid_config", "t5": "no_config"}
    empty = objects(spark, "c//x/p/f")
    assert RT.unroutable(empty, cfg, valid).first().reason == "empty_tenant"


def test_salted_copies_are_never_broadcast(spark):
    """Their planned size leaves the salt out, so a broadcast would hold many times what the threshold allows."""
    cfg = C.routable_configs(table(spark, cw("t1"), s3("t2")))
    salted = RT.route(objects(spark, "c/t1/a/p/f", "c/t2/a/p/f"), cfg, salt=4)
    plan = salted._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin [tenant_id" in plan and salted.count() == 2


def test_route_exploded_does_not_repeat_names(spark):
    cfg = C.routable_configs(table(spark, s3("t", desired_logs=["a", "a"])))
    assert RT.route_exploded(objects(spark, "c/t/a/p/f"), cfg).count() == 1


def test_missing_destinations_by_exact_name(spark):
    routed = RT.route(objects(spark, "c/t/a/pod-1/f", "c/t/a/pod-11/f", "c/t/a/pod-1/g"), C.routable_configs(table(spark, cw("t"))))
    inventory = spark.createDataFrame([("/logs/t", "pod-11"), ("/logs/t2", "pod-1")], "log_group string, log_stream string")
    assert [(r.log_group, r.log_stream) for r in RT.missing_destinations(routed, inventory).collect()] == [("/logs/t", "pod-1")]


def test_reconcile_counts_before_joining(spark):
    planned = spark.createDataFrame([("a",)] * 300 + [("b",)], "k string")
    found = spark.createDataFrame([("a",)] * 200 + [("c",)], "k string")
    got = {r.k: (r.planned, r.delivered, r.status) for r in RT.reconcile(planned, found, ["k"]).collect()}
    assert got == {"a": (300, 200, "delivered"), "b": (1, 0, "missing"), "c": (0, 1, "unexpected")}


def test_decode_items(spark):
    def item(**values):
        blank = dict.fromkeys(("S", "BOOL", "N", "L", "SS"))
        return {f.name: ({**blank, **values[f.name]} if f.name in values else None) for f in TAGGED_ITEM}

    rows = [
        (item(tenant_id={"S": "acme-corp"}, type={"S": "s3"}, enabled={"BOOL": True},
              desired_logs={"L": [{"S": "payment-service"}, {"S": "user-database"}]}),),
        (item(tenant_id={"S": "t"}, type={"S": "s3"}, desired_logs={"SS": ["a"]}, ttl={"N": "12"}),),
        (item(tenant_id={"S": "u"}, type={"S": "s3"}),),
    ]
    from pyspark.sql import types as T

    df = decode_items(spark.createDataFrame(rows, T.StructType([T.StructField("item", TAGGED_ITEM)])))
    got = {r.tenant_id: (r.enabled, r.desired_logs, r.ttl) for r in df.collect()}
    assert got == {"acme-corp": (True, ["payment-service", "user-database"], None), "t": (None, ["a"], 12), "u": (None, None, None)}


def test_pages(spark):
    cfg = table(spark, *[cw(f"t{i:02d}") for i in range(24)])
    last, sizes = None, []
    while True:
        page = C.list_configs(cfg, 10, last).collect()
        sizes.append(len(page))
        last = page[0].last_key
        if last is None:
            break
    assert sizes == [10, 10, 4]
    assert C.list_configs(cfg, 24).first().last_key is None


def test_groups(spark):
    groups = spark.createDataFrame(
        [(g, a) for g, apps in APPLICATION_GROUPS.items() for a in apps], "group_name string, application string"
    )
    cfg = table(spark, s3("t", desired_logs=["custom-app-1", "custom-app-2"], groups=["API", "authentication", "nope"]),
                s3("u", desired_logs=["x"]), s3("v", groups=["api", "API"]))
    expanded, warnings = C.expand_groups(cfg, groups)
    got = {r.tenant_id: r.desired_logs for r in expanded.collect()}
    assert set(got["t"]) == {"custom-app-1", "custom-app-2", "kube-apiserver", "openshift-apiserver", "oauth-server", "oauth-apiserver"}
    assert got["u"] == ["x"] and got["v"] == ["kube-apiserver", "openshift-apiserver"]
    assert [(r.tenant_id, r.group_name) for r in warnings.collect()] == [("t", "nope")]


def changes(spark, *rows):
    names = ["request_no", *C.KEY, *C.CHANGEABLE_FIELDS]
    kinds = {f.name: f.dataType.simpleString() for f in DELIVERY_CONFIG} | {"request_no": "int"}
    schema = ", ".join(f"`{n}` {kinds[n]}" for n in names)
    return spark.createDataFrame([tuple({**r, "request_no": i}.get(n) for n in names) for i, r in enumerate(rows)], schema)


def test_create_update_delete(spark):
    cfg = table(spark, s3("a", desired_logs=["x"]))
    made, outcome = C.create_configs(cfg, changes(spark, s3("a"), s3("b", enabled=None), s3("b", bucket_name="second")), AS_OF)
    assert sorted((r.request_no, r.outcome) for r in outcome.collect()) == [(0, "already_exists"), (1, "created"), (2, "already_exists")]
    b = made.filter("tenant_id = 'b'").select("*", F.unix_millis("created_at").alias("ms")).first()
    assert (b.enabled, b.bucket_name, b.ms) == (True, "b-logs", AS_OF)

    blank = {"tenant_id": "a", "type": "s3"}
    new, outcome = C.update_configs(cfg, changes(spark, {**blank, "bucket_name": "n1"}, {**blank, "bucket_name": "n2"}, {"tenant_id": "z", "type": "s3"}), AS_OF)
    a = new.select("*", F.unix_millis("updated_at").alias("ms")).first()
    assert (a.bucket_name, a.desired_logs, a.enabled, a.ms) == ("n2", ["x"], True, AS_OF)
    assert sorted((r.request_no, r.outcome) for r in outcome.collect()) == [(0, "updated"), (1, "updated"), (2, "not_found")]
    stamped, _ = C.update_configs(cfg, changes(spark, blank), AS_OF)
    assert stamped.select(F.unix_millis("updated_at")).first()[0] == AS_OF
    patched, _ = C.patch_configs(cfg, changes(spark, {**blank, "bucket_name": "no", "enabled": False}), AS_OF)
    assert (patched.first().bucket_name, patched.first().enabled) == ("a-logs", False)

    left, outcome = C.delete_configs(made, changes(spark, blank, {"tenant_id": "q", "type": "s3"}).select(*C.KEY))
    assert keys(left) == [("b", "s3")]
    assert {r.tenant_id: r.outcome for r in outcome.collect()} == {"a": "deleted", "q": "not_found"}
    assert C.get_configs(left, "a", "s3").count() == 0


def test_validation_report(spark):
    cfg = table(spark, cw("ok", target_region="us_east-1"), cw("arn", log_distribution_role_arn="bad"), cw("group", log_group_name=None),
                s3("bucket", bucket_name="a b"), s3("region", target_region="x!"))
    report = C.validate_configs(cfg).collect()
    assert {r.tenant_id: r.valid for r in report} == {"ok": True, "arn": False, "group": False, "bucket": False, "region": False}
    bad = {(r.tenant_id, r.field, r.status, r.message) for r in report if r.status != "ok"}
    assert bad == {
        ("arn", "log_distribution_role_arn", "invalid", "Role ARN format is invalid"),
        ("group", "log_group_name", "missing", "Required CloudWatch field log_group_name is missing or empty"),
        ("bucket", "bucket_name", "invalid", "S3 bucket name format appears invalid"),
        ("region", "target_region", "invalid", "Target region format appears invalid"),
    }


def test_request_validation(spark):
    requests = table(spark, s3("ok"), s3("a b"), s3("t", type="ftp"), s3("n", bucket_name=None), cw("r", log_distribution_role_arn="x"),
                     s3("d", desired_logs=[" "]), s3("g", target_region="!"), cw("w", log_group_name=" "))
    got = {r.tenant_id: r.problem for r in C.validate_requests(requests).collect()}
    assert got == {"a b": "tenant_id", "t": "type", "n": "missing bucket_name", "r": "log_distribution_role_arn", "d": "desired_logs"}
    updates = {r.tenant_id: r.problem for r in C.validate_requests(requests, "update").collect()}
    assert updates == {"r": "log_distribution_role_arn", "d": "desired_logs", "g": "target_region"}
    assert [r.tenant_id for r in C.validate_requests(requests, "patch").collect()] == ["d"]
