"""Object keys: tenant identity, file names, prefixes, destination keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.constants import DEFAULT_ENVIRONMENT, DEFAULT_PREFIX, ENVIRONMENTS

BLANK = r"^\s*$"
# Four segments with a visible character, each closed by a slash.
ROUTABLE = r"^(?:[^\S/]*+[^\s/][^/]*+/){4}"
DIMENSIONS = ("cluster_id", "namespace", "application", "pod_name")


def segments(key: Column) -> Column:
    return F.split(key, "/", -1)


def is_routable(key: Column) -> Column:
    """One pattern instead of a test per segment: key filters sit close to the scan."""
    return F.coalesce(key.rlike(ROUTABLE), F.lit(False))


def key_problem(key: Column) -> Column:
    """Why a key cannot be routed, NULL for a good key."""
    parts = segments(key)
    problem = F.when(key.isNull() | (F.size(parts) < 5), F.lit("too_few_segments"))
    for i, name in enumerate(DIMENSIONS):
        problem = problem.when(F.get(parts, F.lit(i)).rlike(BLANK), F.lit(f"blank_{name}"))
    return problem


def environment(cluster_id: Column) -> Column:
    word = F.substring_index(cluster_id, "-", 1)
    found = F.lit(None).cast("string")
    for prefix, name in ENVIRONMENTS.items():
        found = F.when(word == prefix, name).otherwise(found)
    return F.when(cluster_id.contains("-"), F.coalesce(found, F.lit(DEFAULT_ENVIRONMENT))).otherwise(DEFAULT_ENVIRONMENT)


def filename(key: Column) -> Column:
    return F.substring_index(key, "/", -1)


def slashed(prefix: Column) -> Column:
    """A non-empty prefix ends with a slash."""
    return F.when((prefix != "") & ~prefix.endswith("/"), F.concat(prefix, F.lit("/"))).otherwise(prefix)


def slashed_or_empty(prefix: Column) -> Column:
    """Config-side reading: NULL becomes the empty prefix."""
    return F.coalesce(slashed(prefix), F.lit(""))


def destination_key(prefix: Column, tenant: Column, application: Column, pod: Column, key: Column) -> Column:
    """Cluster id is left out on purpose: it stays inside the platform."""
    base = slashed(F.coalesce(F.nullif(prefix, F.lit("")), F.lit(DEFAULT_PREFIX)))
    return F.concat(base, F.concat_ws("/", tenant, application, pod, filename(key)))


def unescape_key(key: Column) -> Column:
    """Query unescape; NULL where an escape is broken."""
    return F.try_url_decode(key)


def page_key(tenant: Column, kind: Column) -> Column:
    return F.concat_ws("#", tenant, kind)


def parse_page_key(key: Column) -> Column:
    parts = F.split(key, "#", 2)
    return F.struct(F.get(parts, F.lit(0)).alias("tenant_id"), F.get(parts, F.lit(1)).alias("type"))
