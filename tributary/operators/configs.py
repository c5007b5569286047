"""The tenant config table: reading rules, validation and set-at-a-time maintenance.

Maintenance takes the table and a change table and returns (new table, outcome per change row), so
any number of changes is one job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.constants import DEFAULT_PREFIX, DEFAULT_REGION, PAGE_LIMIT
from tributary.functions import keys as K
from tributary.functions import rules as U
from tributary.functions.timestamps import millis
from tributary.schemas import CHANGEABLE_FIELDS, CONFIG_KEY, PATCH_FIELDS

KEY = list(CONFIG_KEY)


# -- reading rules ------------------------------------------------------------------------------

def enabled_configs(cfg: DataFrame, missing: bool) -> DataFrame:
    """Enabled rows. A missing flag is off for delivery (False) and on for the API (True)."""
    return cfg.filter(F.coalesce(F.col("enabled"), F.lit(missing)))


def unexpired_configs(cfg: DataFrame, as_of) -> DataFrame:
    now_s = F.floor(millis(as_of) / 1000)
    return cfg.filter(F.col("ttl").isNull() | (F.col("ttl") > now_s))


def delivery_problem() -> Column:
    """First reason why delivery refuses a config, NULL for a good one."""
    fields = {name: F.col(name) for names in U.REQUIRED_FIELDS.values() for name in names}
    missing = U.missing_required(F.col("type"), fields)
    return (
        F.when(U.is_empty(F.col("type")), F.lit("missing type"))
        .when(~F.col("type").isin(*U.REQUIRED_FIELDS), F.concat(F.lit("invalid type "), F.col("type")))
        .when(F.size(missing) > 0, F.concat(F.lit("missing "), F.array_join(missing, ",")))
    )


def valid_tenant_configs(cfg: DataFrame) -> DataFrame:
    """Enabled configs of tenants whose enabled configs are all valid; one bad row removes the tenant.

    The bad tenants are collected as their own small key set; the configs are not re-sorted.
    """
    enabled = enabled_configs(cfg, missing=False).withColumn("_problem", delivery_problem())
    bad = enabled.filter("_problem is not null").select("tenant_id").distinct()
    return enabled.drop("_problem").join(bad, "tenant_id", "left_anti")


def routable_configs(cfg: DataFrame, as_of=None) -> DataFrame:
    """What delivery works with: unexpired, enabled, whole tenants valid."""
    live = cfg if as_of is None else unexpired_configs(cfg, as_of)
    return valid_tenant_configs(live)


def apply_delivery_defaults(cfg: DataFrame) -> DataFrame:
    empty = F.lit("")
    return cfg.withColumns(
        {
            "target_region": F.coalesce(F.nullif(F.col("target_region"), empty), F.lit(DEFAULT_REGION)),
            "bucket_prefix": K.slashed(F.coalesce(F.nullif(F.col("bucket_prefix"), empty), F.lit(DEFAULT_PREFIX))),
        }
    )


def expand_groups(cfg: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Adds the members of named application groups to ``desired_logs``; unknown names become warnings.

    ``groups`` is (group_name, application). Group names match in any case, members exactly.
    """
    members = groups.groupBy(F.lower("group_name").alias("_name")).agg(
        F.sort_array(F.collect_set("application")).alias("_members")
    )
    named = cfg.select(*KEY, F.explode("groups").alias("group_name")).withColumn("_name", F.lower("group_name"))
    matched = named.join(members, "_name", "left")
    gathered = matched.groupBy(*KEY).agg(F.flatten(F.collect_list("_members")).alias("_extra"))
    own = F.coalesce("desired_logs", F.array().cast("array<string>"))
    extra = F.coalesce("_extra", F.array().cast("array<string>"))
    expanded = cfg.join(gathered, KEY, "left").withColumn(
        "desired_logs",
        F.when(F.size(extra) == 0, F.col("desired_logs")).otherwise(F.array_sort(F.array_distinct(F.concat(own, extra)))),
    )
    warnings = matched.filter("_members is null").select(*KEY, "group_name")
    return expanded.select(*cfg.columns), warnings


def config_overview(cfg: DataFrame) -> DataFrame:
    return cfg.select("tenant_id", "type", "enabled")


def config_types(cfg: DataFrame) -> DataFrame:
    """Number of configs and delivery types per tenant."""
    return cfg.groupBy("tenant_id").agg(
        F.count("*").alias("configs"), F.array_join(F.sort_array(F.collect_set("type")), ",").alias("types")
    )


def get_configs(cfg: DataFrame, tenant: str, kind: str | None = None) -> DataFrame:
    found = cfg.filter(F.col("tenant_id") == tenant)
    return found if kind is None else found.filter(F.col("type") == kind)


def list_configs(cfg: DataFrame, limit: int = PAGE_LIMIT, last_key: str | None = None) -> DataFrame:
    """One page in key order behind ``tenant#type``; ``last_key`` is set on all rows if more follow."""
    rest = cfg
    if last_key:
        tenant, _, kind = last_key.partition("#")
        rest = cfg.filter(
            (F.col("tenant_id") > tenant) | ((F.col("tenant_id") == tenant) & (F.col("type") > kind))
        )
    # A page is at most limit + 1 rows, so numbering it in one task is bounded.
    page = rest.orderBy(*KEY).limit(limit + 1)
    numbered = page.withColumn("_n", F.row_number().over(Window.orderBy(*KEY)))
    whole = Window.partitionBy(F.lit(0)).orderBy("_n").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    more = F.max("_n").over(whole) > limit
    last = F.max(F.when(F.col("_n") == limit, K.page_key(F.col("tenant_id"), F.col("type")))).over(whole)
    return numbered.withColumn("last_key", F.when(more, last)).filter(F.col("_n") <= limit).drop("_n")


# -- maintenance --------------------------------------------------------------------------------

def _stamp(as_of) -> Column:
    return F.timestamp_millis(millis(as_of))


def create_configs(cfg: DataFrame, new: DataFrame, as_of, order: str = "request_no") -> tuple[DataFrame, DataFrame]:
    """Inserts rows whose key is free; of several requests for one key the first wins.

    Outcome: key, request number, ``created`` or ``already_exists``.
    """
    row = F.struct(order, *CHANGEABLE_FIELDS, *[c for c in ("created_at",) if c in new.columns])
    first = new.groupBy(*KEY).agg(F.min_by(row, order).alias("_row"))
    free = first.join(cfg.select(*KEY), KEY, "left_anti")
    made = free.select(*KEY, "_row.*")
    created_at = F.coalesce(F.col("created_at"), _stamp(as_of)) if "created_at" in new.columns else _stamp(as_of)
    inserted = made.withColumns(
        {
            "enabled": F.coalesce("enabled", F.lit(True)),
            "created_at": created_at,
            "updated_at": _stamp(as_of),
        }
    )
    winners = made.select(*KEY, F.col(order).alias("_winner"))
    outcome = new.join(winners, KEY, "left").select(
        *KEY, order, F.when(F.col(order) == F.col("_winner"), "created").otherwise("already_exists").alias("outcome")
    )
    return cfg.unionByName(inserted.select(*cfg.columns)), outcome


def update_configs(
    cfg: DataFrame, changes: DataFrame, as_of, order: str = "request_no", fields=CHANGEABLE_FIELDS
) -> tuple[DataFrame, DataFrame]:
    """Sets the non-null fields of each change and always the update stamp; later requests win per field.

    Requests of one key fold into one row before the join. Outcome: ``updated`` or ``not_found``.
    """
    folded = changes.groupBy(*KEY).agg(
        *[F.max_by(f, F.when(F.col(f).isNotNull(), F.col(order))).alias(f"_new_{f}") for f in fields]
    ).withColumn("_hit", F.lit(True))
    joined = cfg.join(folded, KEY, "left")
    sets = {f: F.coalesce(f"_new_{f}", f) for f in fields}
    sets["updated_at"] = F.when(F.col("_hit"), _stamp(as_of)).otherwise(F.col("updated_at"))
    table = joined.withColumns(sets).select(*cfg.columns)
    known = cfg.select(*KEY, F.lit(True).alias("_known"))
    outcome = changes.join(known, KEY, "left").select(
        *KEY, order, F.when(F.col("_known"), "updated").otherwise("not_found").alias("outcome")
    )
    return table, outcome


def patch_configs(cfg: DataFrame, changes: DataFrame, as_of, order: str = "request_no") -> tuple[DataFrame, DataFrame]:
    """Update limited to the flag and the application list."""
    return update_configs(cfg, changes, as_of, order, PATCH_FIELDS)


def delete_configs(cfg: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Removes rows by key. Outcome: one row per requested key, ``deleted`` or ``not_found``."""
    wanted = keys.select(*KEY).distinct()
    known = cfg.select(*KEY, F.lit(True).alias("_known"))
    outcome = wanted.join(known, KEY, "left").select(
        *KEY, F.when(F.col("_known"), "deleted").otherwise("not_found").alias("outcome")
    )
    return cfg.join(wanted, KEY, "left_anti").select(*cfg.columns), outcome


# -- validation ---------------------------------------------------------------------------------

def _present(field: str, label: str) -> Column:
    lacks = U.is_empty(F.col(field))
    return F.struct(
        F.lit(field).alias("field"),
        F.when(lacks, "missing").otherwise("ok").alias("status"),
        F.when(lacks, f"Required {label.lower() if label == 'Field' else label + ' field'} {field} is missing or empty")
        .otherwise(f"{label if label == 'Field' else label + ' field'} {field} is present")
        .alias("message"),
    )


def _bad_format(when: Column, field: str, message: str) -> Column:
    return F.when(
        F.coalesce(when, F.lit(False)),
        F.struct(F.lit(field).alias("field"), F.lit("invalid").alias("status"), F.lit(message).alias("message")),
    )


def validation_checks(cfg: DataFrame) -> DataFrame:
    """Adds ``checks`` (field, status, message) and ``valid`` to every config."""
    kind = F.col("type")
    checks = [_present("tenant_id", "Field"), _present("type", "Field")]
    labels = {"cloudwatch": "CloudWatch", "s3": "S3"}
    for t, names in U.REQUIRED_FIELDS.items():
        checks += [F.when(kind == t, _present(name, labels[t])) for name in names]
    arn, bucket, region = F.col("log_distribution_role_arn"), F.col("bucket_name"), F.col("target_region")
    checks += [
        _bad_format((kind == "cloudwatch") & (arn != "") & ~U.valid_role_arn(arn), "log_distribution_role_arn",
                    "Role ARN format is invalid"),
        _bad_format((kind == "s3") & (bucket != "") & ~U.valid_bucket(bucket), "bucket_name",
                    "S3 bucket name format appears invalid"),
        _bad_format((region != "") & ~U.valid_region(region, allow_underscore=True), "target_region",
                    "Target region format appears invalid"),
    ]
    listed = cfg.withColumn("checks", F.array_compact(F.array(*checks)))
    return listed.withColumn("valid", F.forall("checks", lambda c: c["status"] == "ok"))


def validate_configs(cfg: DataFrame) -> DataFrame:
    """Validation report: one row per check."""
    return (
        validation_checks(cfg)
        .select(*KEY, "valid", F.posexplode("checks").alias("check_no", "check"))
        .select(*KEY, "valid", "check_no", "check.field", "check.status", "check.message")
    )


def _format_problem(fields: list[str], problem: Column | None = None) -> Column:
    """First field whose given value has a bad format."""
    formats = {
        "log_distribution_role_arn": U.valid_role_arn,
        "bucket_name": U.valid_bucket,
        "target_region": U.valid_region,
        "desired_logs": U.valid_desired_logs,
    }
    for name in fields:
        bad = F.col(name).isNotNull() & ~formats[name](F.col(name))
        problem = F.when(bad, F.lit(name)) if problem is None else problem.when(bad, F.lit(name))
    return problem


# Which formats each kind of request checks.
CHECKED_FIELDS = {
    "create": ["log_distribution_role_arn", "bucket_name", "desired_logs"],
    "update": ["log_distribution_role_arn", "target_region", "desired_logs"],
    "patch": ["desired_logs"],
}


def validate_requests(requests: DataFrame, operation: str = "create") -> DataFrame:
    """Requests that would be refused, with the field at fault.

    A create request needs a good key and the fields of its type; updates and patches name an
    existing row and are judged only by what they set.
    """
    if operation != "create":
        return requests.withColumn("problem", _format_problem(CHECKED_FIELDS[operation])).filter("problem is not null")
    kind = F.col("type")
    key = F.when(~U.valid_tenant_id(F.col("tenant_id")), F.lit("tenant_id")).when(
        F.coalesce(~kind.isin(*U.REQUIRED_FIELDS), F.lit(True)), F.lit("type")
    )
    fields = {name: F.col(name) for names in U.REQUIRED_FIELDS.values() for name in names}
    missing = F.get(U.missing_required(kind, fields, blank_counts=False), F.lit(0))
    problem = F.coalesce(_format_problem(CHECKED_FIELDS["create"], key), F.concat(F.lit("missing "), missing))
    return requests.withColumn("problem", problem).filter("problem is not null")
