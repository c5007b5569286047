import random

from pyspark.sql import functions as F

from tributary.operators import configs as C
from tributary.operators import routing as RT
from tributary.operators import search as S
from tributary.schemas import DELIVERY_CONFIG
from tributary.sinks.config_store import ConfigStore
from tests_support import cw, s3, table

NOW = 1_706_659_200_000


def requests(spark, *rows):
    """Change requests: (tenant, type, number, fields)."""
    names = [f for f in DELIVERY_CONFIG.names if f not in ("created_at", "updated_at")]
    schema = ", ".join(f"{n} {DELIVERY_CONFIG[n].dataType.simpleString()}" for n in names) + ", request_no bigint"
    return spark.createDataFrame([tuple({"tenant_id": t, "type": k, **more}.get(n) for n in names) + (no,) for t, k, no, more in rows], schema)


def shown(df):
    return sorted((r.tenant_id, r.type, r.enabled, r.bucket_name) for r in df.collect())


def test_config_store_equals_whole_table_changes(spark, tmp_path):
    start = table(spark, *[s3(f"t{i}", enabled=bool(i % 2)) for i in range(40)], cw("t1"))
    store = ConfigStore(spark, str(tmp_path / "c"), slots=8)
    store.load(start, NOW)
    new = requests(spark, ("t90", "s3", 1, {"bucket_name": "a"}), ("t90", "s3", 2, {"bucket_name": "b"}), ("t5", "s3", 3, {"bucket_name": "c"}))
    made = sorted((r.request_no, r.outcome) for r in store.create(new, NOW + 1).collect())
    assert made == [(1, "created"), (2, "already_exists"), (3, "already_exists")]
    want, _ = C.create_configs(start, new, NOW + 1)
    change = requests(spark, ("t90", "s3", 1, {"enabled": False}), ("t7", "s3", 2, {"bucket_name": "x"}), ("none", "s3", 3, {}))
    assert sorted(r.outcome for r in store.update(change, NOW + 2).collect()) == ["not_found", "updated", "updated"]
    want, _ = C.update_configs(want, change, NOW + 2)
    gone = requests(spark, ("t7", "s3", 1, {}), ("t1", "cloudwatch", 2, {}), ("none", "s3", 3, {}))
    assert sorted(r.outcome for r in store.delete(gone, NOW + 3).collect()) == ["deleted", "deleted", "not_found"]
    before, want = want, C.delete_configs(want, gone)[0]
    assert shown(store.current()) == shown(want)
    assert shown(store.current(2)) == shown(before) and shown(store.current(0)) == shown(start)
    rewritten = store.compact(NOW + 4)
    assert 1 <= rewritten <= 4  # three keys changed, in as many slots at most
    assert shown(store.current()) == shown(want) and store.compact(NOW + 5) == 0
    again = requests(spark, ("t7", "s3", 1, {"bucket_name": "back"}))
    store.create(again, NOW + 6)
    assert shown(store.current()) == shown(C.create_configs(want, again, NOW + 6)[0])


def test_ten_changes_rewrite_at_most_ten_slots(spark, tmp_path):
    big = spark.range(1_000_000).select(F.concat(F.lit("t"), "id").alias("tenant_id"), F.lit("s3").alias("type"))
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in DELIVERY_CONFIG if f.name not in ("tenant_id", "type")]
    store = ConfigStore(spark, str(tmp_path / "c"), slots=64)
    store.load(big.select("tenant_id", "type", *blank).select(*DELIVERY_CONFIG.names), NOW)
    store.patch(requests(spark, *[(f"t{i * 99_991}", "s3", i, {"enabled": True}) for i in range(10)]), NOW + 1)
    assert store.current(1).count() == 1_000_000 and store.current().where("enabled").count() == 10
    assert store.compact(NOW + 2) <= 10
    assert store.current().count() == 1_000_000 and store.current().where("enabled").count() == 10


def test_reconcile_by_digest(spark):
    rng = random.Random(1)
    keys = [f"k{i}" for i in range(3000)]
    planned = keys + rng.choices(keys, k=50)
    delivered = [k for k in planned if k not in ("k7", "k8")] + ["extra", "k9"]
    rng.shuffle(delivered)
    left, right = (spark.createDataFrame([(k,) for k in x], "k string").repartition(4) for x in (planned, delivered))
    found, ranges = RT.reconcile_by_digest(left, right, ["k"], 512)
    whole = RT.reconcile(left, right, ["k"]).where("planned <> delivered")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, whole.collect())) and 1 <= ranges.count() <= 4
    same, none = RT.reconcile_by_digest(left, left.repartition(2), ["k"])
    assert same.isEmpty() and none.isEmpty()
    merged = RT.digests(left.where("k < 'k2'"), ["k"]).union(RT.digests(left.where("k >= 'k2'"), ["k"]))
    merged = merged.groupBy("range").agg(F.sum("rows").alias("rows"), F.sum("sum").alias("sum"), F.bit_xor("mix").alias("mix"))
    assert RT.unequal_ranges(merged, RT.digests(left, ["k"])).isEmpty()


def test_search_index_never_loses_a_line(spark, tmp_path):
    rng = random.Random(2)
    rows = [(f"o{i % 30}", i, "".join(rng.choice("abcé日 01") for _ in range(rng.randint(0, 60)))) for i in range(900)] + [("empty", 1, None), ("short", 2, "ab")]
    lines = spark.createDataFrame(rows, "object_key string, line_no bigint, line string").repartition(5)
    index = S.build_index(lines)
    terms = [line[k : k + n] for _, _, line in rng.sample(rows[:900], 40) for n in (1, 3, 7) for k in [rng.randint(0, 50)] if line and len(line[k : k + n]) == n]
    for term in terms[:25]:
        holds = {k for k, _, line in rows if line and term in line}
        opened = {r.object_key for r in S.may_hold(index, term).collect()}
        assert holds <= opened | {"empty", "short"}
    assert S.may_hold(index, "zzz").isEmpty()
    halves = S.merge_indexes(S.build_index(lines.where("line_no < 450")), S.build_index(lines.where("line_no >= 450")))
    assert sorted(map(tuple, halves.collect())) == sorted(map(tuple, index.collect()))
