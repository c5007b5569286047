"""Catalog of queries over the derived tables: name -> (Spark job, SQL to check it against)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tributary.operators import configs as C
from tributary.operators import records as R
from tributary.operators import routing
from tributary.plans import derive
from tributary.session import configure


class Tables:
    """The derived tables of one data folder, built when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = configure(spark), sf_dir

    def given(self, name: str) -> DataFrame:
        return derive.table(self.spark, self.sf_dir, name)

    @cached_property
    def raw(self) -> DataFrame:
        return derive.raw_logs(self.spark, self.sf_dir)

    @cached_property
    def pods(self) -> DataFrame:
        return derive.pod_logs(self.spark, self.sf_dir)

    @cached_property
    def stored(self) -> DataFrame:
        return derive.stored_lines(self.spark, self.sf_dir)

    @cached_property
    def stored_with_upload(self) -> DataFrame:
        """Stored lines with the upload time a scan would give them."""
        return derive.stored_lines(self.spark, self.sf_dir, "ingest_ms AS upload_ms")

    @cached_property
    def records(self) -> DataFrame:
        return R.parse_lines(self.stored)

    @cached_property
    def events(self) -> DataFrame:
        return R.to_log_events(self.records, derive.AS_OF_MS)

    @cached_property
    def listing(self) -> DataFrame:
        return derive.listing(self.spark, self.sf_dir)

    @cached_property
    def objects(self) -> DataFrame:
        """Routable objects with their tenant identity and upload time."""
        valid, _ = routing.split_valid_keys(self.listing)
        return routing.extract_tenant_info(valid).withColumnRenamed("modified_ms", "upload_ms")

    @cached_property
    def configs(self) -> DataFrame:
        return derive.configs(self.spark, self.sf_dir)

    @cached_property
    def routable(self) -> DataFrame:
        return C.routable_configs(self.configs, derive.AS_OF_MS)

    @cached_property
    def routed(self) -> DataFrame:
        return routing.route(self.objects, self.routable)

    @cached_property
    def messages(self) -> DataFrame:
        return derive.messages(self.spark, self.sf_dir)


@dataclass(frozen=True)
class Query:
    job: Callable[[Tables], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(job: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(job, sql)
        return job

    return register


def jobs() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf, q=q: q.job(Tables(spark, sf))) for name, q in REGISTRY.items()}


def sql_texts() -> dict[str, str]:
    return {name: q.sql for name, q in REGISTRY.items() if q.sql}
