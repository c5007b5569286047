"""Several tables of one run, visible together or not at all.

Every attempt of a run writes its tables below folders of its own. Last of all a manifest, a small folder renamed into place, names the
attempt that counts. Readers look at manifests first, so they never see an attempt that failed half-way, and a
repeated run finds its manifest and changes nothing.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFESTS, DRAFTS, RUN = "runs", "drafts", "run"
#: Tables of a run written at the same time: small ones leave cores idle.
WRITERS = 4
_MANIFEST = "run bigint, source string, as_of bigint, attempt string, schemas string, counts string"


@dataclass(frozen=True)
class Run:
    """One committed run. ``source`` says what it worked on, ``counts`` are figures its writer wants to keep."""

    run: int
    source: str
    as_of: int
    attempt: str
    schemas: Mapping[str, str]
    counts: Mapping[str, int]


class RunStore:
    """The runs below one folder. What reaches the driver is one short row a run."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def runs(self) -> list[Run]:
        """All committed runs in order."""
        folder = f"{self.root}/{MANIFESTS}"
        if not self._fs.exists(self._path(folder)):
            return []
        rows = self.spark.read.schema(_MANIFEST).option("recursiveFileLookup", "true").json(folder).collect()
        found = [Run(r.run, r.source, r.as_of, r.attempt, json.loads(r.schemas), json.loads(r.counts)) for r in rows]
        return sorted(found, key=lambda r: r.run)

    def write(self, run: int, tables: Mapping[str, DataFrame], partition: str | None = None) -> tuple[str, dict[str, str]]:
        """Writes the tables of one attempt, which stays invisible; returns its name and the tables' schemas. ``partition`` names a column that becomes folders."""
        attempt = uuid4().hex
        with ThreadPoolExecutor(WRITERS) as pool:
            put = lambda name: tables[name].write.partitionBy(*[partition] * bool(partition)).parquet(f"{self.root}/{name}/{RUN}={run}/attempt={attempt}")
            list(pool.map(put, tables))
        return attempt, {name: table.schema.json() for name, table in tables.items()}

    def written(self, run: int, attempt: str, name: str) -> DataFrame:
        """One table of an attempt, committed or not."""
        return self.spark.read.parquet(f"{self.root}/{name}/{RUN}={run}/attempt={attempt}")

    def commit(self, run: int, source: str, as_of: int, attempt: str, schemas: Mapping[str, str], counts: Mapping[str, int] | None = None) -> bool:
        """Makes an attempt the one that counts; False if the run has been committed before."""
        row = (run, source, as_of, attempt, json.dumps(dict(schemas)), json.dumps(dict(counts or {})))
        draft, final = f"{self.root}/{DRAFTS}/{attempt}", f"{self.root}/{MANIFESTS}/{RUN}={run}"
        self.spark.createDataFrame([row], _MANIFEST).coalesce(1).write.json(draft)
        self._fs.mkdirs(self._path(f"{self.root}/{MANIFESTS}"))
        if self._fs.exists(self._path(final)):
            return False
        return bool(self._fs.rename(self._path(draft), self._path(final)))

    def schema(self, run: Run, name: str) -> T.StructType:
        return T.StructType.fromJson(json.loads(run.schemas[name]))

    def read(self, name: str, runs: list[Run] | None = None) -> DataFrame | None:
        """One table over the committed runs (or the given ones), with the column ``run``; None before the first one."""
        chosen = [r for r in (self.runs() if runs is None else runs) if name in r.schemas]
        if not chosen:
            return None
        schema = self.schema(chosen[-1], name)
        paths = [f"{self.root}/{name}/{RUN}={r.run}/attempt={r.attempt}" for r in chosen]
        rows = self.spark.read.schema(schema.add(RUN, T.LongType())).option("basePath", f"{self.root}/{name}").parquet(*paths)
        return rows.select(*[c for c in rows.columns if c != "attempt"])

    def sweep(self) -> int:
        """Removes the folders of attempts that no manifest names; for times when no run is being written. Returns their number."""
        kept, gone = {r.attempt for r in self.runs()}, 0
        for pattern in (f"{self.root}/*/{RUN}=*/attempt=*", f"{self.root}/{DRAFTS}/*"):
            for found in self._fs.globStatus(self._path(pattern)) or []:
                if found.getPath().getName().removeprefix("attempt=") not in kept:
                    gone += bool(self._fs.delete(found.getPath(), True))
        return gone


def observed_max(df: DataFrame, column: str) -> int | None:
    """The largest value of a written table's column: one row to the driver."""
    return df.agg(F.max(column).alias("most")).first()["most"]
