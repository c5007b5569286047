"""Objects meet tenant configs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions import keys as K
from tributary.functions.rules import application_enabled


def split_valid_keys(df: DataFrame, key: str = "object_key") -> tuple[DataFrame, DataFrame]:
    """Rows whose key can be routed, and the rest with a reason."""
    good = K.is_routable(F.col(key))
    return df.filter(good), df.filter(~good).withColumn("reason", K.key_problem(F.col(key)))


def extract_tenant_info(df: DataFrame, key: str = "object_key") -> DataFrame:
    """Adds cluster_id, namespace, tenant_id, application, pod_name and environment."""
    parts = K.segments(F.col(key))
    dims = {name: F.get(parts, F.lit(i)) for i, name in enumerate(K.DIMENSIONS)}
    return df.withColumns(
        {**dims, "tenant_id": dims["namespace"], "environment": K.environment(dims["cluster_id"])}
    )


def lookup_join(facts: DataFrame, dimension: DataFrame, on: list[str], salt: int | None = None) -> DataFrame:
    """Inner join of a large table with a keyed dimension.

    No broadcast hint: Spark broadcasts a side only below its size threshold, and AQE splits a hot
    key of a sort-merge join. ``salt`` spreads every key over that many buckets by hand, at the
    price of as many copies of the dimension. These are always shuffled: the size Spark expects of
    them leaves out that each row comes ``salt`` times, so they would be collected and broadcast.
    """
    if not salt:
        return facts.join(dimension, on)
    spread = facts.withColumn("_salt", F.pmod(F.xxhash64(*facts.columns), F.lit(salt)).cast("int"))
    copies = dimension.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    return spread.join(copies.hint("merge"), [*on, "_salt"]).drop("_salt")


def route(objects: DataFrame, configs: DataFrame, salt: int | None = None) -> DataFrame:
    """One row per (object, enabled config) whose own application filter lets the object through.

    ``configs`` is the output of :func:`tributary.operators.configs.routable_configs`.
    """
    joined = lookup_join(objects, configs, ["tenant_id"], salt)
    return joined.filter(application_enabled(F.col("desired_logs"), F.col("application")))


def route_exploded(objects: DataFrame, configs: DataFrame, salt: int | None = None) -> DataFrame:
    """Same rows as :func:`route`, for long application lists: the list becomes a join key."""
    everything = F.col("desired_logs").isNull() | (F.size("desired_logs") == 0) | (
        F.col("desired_logs") == F.array(F.lit(""))
    )
    listed = configs.filter(~everything).withColumn("application", F.explode(F.array_distinct("desired_logs")))
    by_name = lookup_join(objects, listed, ["tenant_id", "application"], salt)
    open_to_all = lookup_join(objects, configs.filter(everything), ["tenant_id"], salt)
    return open_to_all.unionByName(by_name.select(*open_to_all.columns))


def unroutable(objects: DataFrame, configs: DataFrame, valid: DataFrame) -> DataFrame:
    """Objects of tenants without a usable config, with the reason.

    ``configs`` are all configs, ``valid`` the routable ones. One status row per tenant is joined,
    so the object side is never duplicated.
    """
    status = configs.groupBy("tenant_id").agg(F.max(F.coalesce("enabled", F.lit(False))).alias("_any_enabled"))
    usable = valid.select("tenant_id").distinct().withColumn("_usable", F.lit(True))
    judged = objects.join(status, "tenant_id", "left").join(usable, "tenant_id", "left")
    reason = (
        F.when(F.col("tenant_id") == "", F.lit("empty_tenant"))
        .when(F.col("_any_enabled").isNull(), F.lit("no_config"))
        .when(~F.col("_any_enabled"), F.lit("none_enabled"))
        .when(F.col("_usable").isNull(), F.lit("invalid_config"))
    )
    return (
        judged.withColumn("reason", reason).filter("reason is not null").select(*objects.columns, "reason")
    )


def event_destination(routed: DataFrame) -> DataFrame:
    """Stream of an event delivery: the pod's name inside the config's log group."""
    return routed.withColumn("log_group", F.col("log_group_name")).withColumn("log_stream", F.col("pod_name"))


def missing_destinations(routed: DataFrame, inventory: DataFrame) -> DataFrame:
    """Destinations (log_group, log_stream) in use that the inventory lacks, by exact name."""
    wanted = event_destination(routed.filter("type = 'cloudwatch'")).select("log_group", "log_stream").distinct()
    return wanted.join(inventory.select("log_group", "log_stream"), ["log_group", "log_stream"], "left_anti")


def reconcile(planned: DataFrame, delivered: DataFrame, on: list[str]) -> DataFrame:
    """Planned against found deliveries per destination key.

    Both sides are counted first: repeated copies of one key never multiply in the join.
    """
    left = planned.groupBy(*on).agg(F.count("*").alias("planned"))
    right = delivered.groupBy(*on).agg(F.count("*").alias("delivered"))
    both = left.join(right, on, "full_outer")
    status = (
        F.when(F.col("delivered").isNull(), "missing").when(F.col("planned").isNull(), "unexpected").otherwise("delivered")
    )
    return both.select(
        *on,
        F.coalesce("planned", F.lit(0)).alias("planned"),
        F.coalesce("delivered", F.lit(0)).alias("delivered"),
        status.alias("status"),
    )


#: Ranges of hash space that both sides sum up before anything is compared row by row.
DIGEST_RANGES = 4096


def _range_of(on: list[str], ranges: int):
    return F.pmod(F.xxhash64(*on), F.lit(ranges)).cast("int")


def digests(rows: DataFrame, on: list[str], ranges: int = DIGEST_RANGES) -> DataFrame:
    """(range, rows, sum, mix): a digest of the keys of each hash range that does not depend on their order.

    Digests of parts of a side merge: rows and sum by addition, mix by exclusive or; so a side can keep them up to date and send them alone.
    """
    h = F.xxhash64(*on, F.lit(1))
    # Halves keep the sum of hashes within a bigint up to 2**31 rows a range.
    return rows.groupBy(_range_of(on, ranges).alias("range")).agg(F.count("*").alias("rows"), F.sum(F.shiftright(h, 32)).alias("sum"), F.bit_xor(h).alias("mix"))


def unequal_ranges(left: DataFrame, right: DataFrame) -> DataFrame:
    """Ranges whose digests differ; at most as many rows as there are ranges."""
    both = left.alias("l").join(right.alias("r"), "range", "full_outer")
    same = F.lit(True)
    for c in ("rows", "sum", "mix"):
        same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    return both.where(~same).select("range")


def reconcile_by_digest(planned: DataFrame, delivered: DataFrame, on: list[str], ranges: int = DIGEST_RANGES) -> tuple[DataFrame, DataFrame]:
    """What differs between planned and found deliveries, and the ranges that had to be compared.

    The first result has the rows of :func:`reconcile` whose counts differ. Only keys of unequal ranges are shuffled and joined; of all others each side
    shows one row a range. Two sides with equal digests but different keys would need a collision of 96 bits.
    """
    open_ = unequal_ranges(digests(planned, on, ranges), digests(delivered, on, ranges))
    some = [side.join(F.broadcast(open_), _range_of(on, ranges) == open_["range"], "left_semi") for side in (planned, delivered)]  # at most ``ranges`` rows
    return reconcile(*some, on).where("planned <> delivered"), open_
