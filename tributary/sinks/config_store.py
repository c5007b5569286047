"""The config table as a bucketed snapshot with a change log.

Rows live in ``slots`` folders by a hash of their key. A set of requests reads the rows of its own keys only, and adds their new images to the
log; nothing else is written. A compaction folds the log into the slots it touches and leaves all others where they are.
Snapshots and changes are runs with a manifest each (see commits), so a reader sees whole ones only, and can read the table as of any run.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators import configs as C
from tributary.operators.configs import KEY
from tributary.sinks.commits import RUN, Run, RunStore

SLOTS = 64
SLOT, DELETED = "_slot", "_deleted"


class ConfigStore:
    """One config table below a folder. What reaches the driver is a row a run and the slots of a change, at most ``slots``."""

    def __init__(self, spark: SparkSession, root: str, slots: int = SLOTS):
        self.spark, self.slots, self.store = spark, slots, RunStore(spark, root)

    def _slot(self):
        return F.pmod(F.xxhash64(*KEY), F.lit(self.slots)).cast("int")

    def _snapshot(self, rows: DataFrame, number: int, as_of: int, source: str) -> Run:
        """Writes whole slots; the manifest lists them."""
        attempt, schemas = self.store.write(number, {"slots": rows.withColumn(SLOT, self._slot())}, partition=SLOT)
        written = [r[SLOT] for r in self.store.written(number, attempt, "slots").select(SLOT).distinct().collect()]
        self.store.commit(number, source, as_of, attempt, schemas, {str(s): 1 for s in written})
        return self.store.runs()[-1]

    def load(self, cfg: DataFrame, as_of: int) -> Run:
        """The first snapshot."""
        return self._snapshot(cfg, 0, as_of, "load")

    def _base(self, runs: Sequence[Run], slots: Sequence[int] | None) -> DataFrame:
        """Rows of the newest snapshot of each slot."""
        newest: dict[int, Run] = {}
        for r in runs:
            if "slots" in r.schemas:
                # A compaction that left a slot empty lists it with 0.
                newest |= {int(s): r for s in r.counts}
        root, paths = self.store.root, []
        for s, r in newest.items():
            if r.counts[str(s)] and (slots is None or s in slots):
                paths.append(f"{root}/slots/{RUN}={r.run}/attempt={r.attempt}/{SLOT}={s}")
        schema = self.store.schema(next(r for r in reversed(runs) if "slots" in r.schemas), "slots")
        columns = [c for c in schema.names if c != SLOT]
        if not paths:
            return self.spark.createDataFrame([], schema).select(*columns)
        return self.spark.read.schema(schema).option("basePath", f"{root}/slots").parquet(*paths).select(*columns)

    def _log(self, runs: Sequence[Run], after: int, slots: Sequence[int] | None) -> DataFrame | None:
        """Newest image of each key that changed in runs behind ``after``."""
        images = self.store.read("changes", [r for r in runs if r.run > after])
        if images is None:
            return None
        if slots is not None:
            images = images.where(self._slot().isin(*slots))
        rest = [c for c in images.columns if c not in (*KEY, RUN)]
        newest = images.groupBy(*KEY).agg(F.max_by(F.struct(*rest), RUN).alias("_row"))
        return newest.select(*KEY, "_row.*")

    def current(self, run: int | None = None, slots: Sequence[int] | None = None) -> DataFrame:
        """The table as of a run (None: the last), or only some slots of it."""
        runs = [r for r in self.store.runs() if run is None or r.run <= run]
        folded = max((r.run for r in runs if r.source == "compaction"), default=-1)
        base, log = self._base(runs, slots), self._log(runs, folded, slots)
        if log is None:
            return base
        kept = base.join(log.select(*KEY), KEY, "left_anti")
        return kept.select(*base.columns).unionByName(log.where(~F.col(DELETED)).select(*base.columns))

    def _apply(self, requests: DataFrame, as_of: int, name: str, change: Callable[[DataFrame], tuple[DataFrame, DataFrame, DataFrame]]) -> DataFrame:
        """Runs a change over the rows of the requested keys; returns its outcome."""
        touched = [r["s"] for r in requests.select(self._slot().alias("s")).distinct().collect()]
        rows = self.current(slots=touched).join(requests.select(*KEY).distinct(), KEY, "left_semi")
        changed, deleted, outcome = change(rows)
        gone = rows.join(deleted.select(*KEY).distinct(), KEY, "left_semi").withColumn(DELETED, F.lit(True))
        images = changed.select(*rows.columns).withColumn(DELETED, F.lit(False)).unionByName(gone)
        number = self.store.runs()[-1].run + 1
        attempt, schemas = self.store.write(number, {"changes": images, "outcome": outcome})
        self.store.commit(number, name, as_of, attempt, schemas)
        return self.store.written(number, attempt, "outcome")

    def create(self, new: DataFrame, as_of: int, order: str = "request_no") -> DataFrame:
        def change(rows):
            table, outcome = C.create_configs(rows, new, as_of, order)
            return table.join(rows.select(*KEY), KEY, "left_anti"), rows.limit(0), outcome

        return self._apply(new, as_of, "create", change)

    def update(self, changes: DataFrame, as_of: int, order: str = "request_no") -> DataFrame:
        return self._apply(changes, as_of, "update", lambda rows: self._set(C.update_configs(rows, changes, as_of, order), rows))

    def patch(self, changes: DataFrame, as_of: int, order: str = "request_no") -> DataFrame:
        return self._apply(changes, as_of, "patch", lambda rows: self._set(C.patch_configs(rows, changes, as_of, order), rows))

    @staticmethod
    def _set(done: tuple[DataFrame, DataFrame], rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        return done[0], rows.limit(0), done[1]

    def delete(self, keys: DataFrame, as_of: int) -> DataFrame:
        return self._apply(keys, as_of, "delete", lambda rows: (rows.limit(0), rows, C.delete_configs(rows, keys)[1]))

    def compact(self, as_of: int) -> int:
        """Folds the log into the slots it touches; returns how many were rewritten."""
        runs = self.store.runs()
        folded = max((r.run for r in runs if r.source == "compaction"), default=-1)
        log = self._log(runs, folded, None)
        touched = [] if log is None else [r["s"] for r in log.select(self._slot().alias("s")).distinct().collect()]
        if not touched:
            return 0
        number = runs[-1].run + 1
        rows = self.current(slots=touched).withColumn(SLOT, self._slot())
        attempt, schemas = self.store.write(number, {"slots": rows}, partition=SLOT)
        written = {r[SLOT] for r in self.store.written(number, attempt, "slots").select(SLOT).distinct().collect()}
        self.store.commit(number, "compaction", as_of, attempt, schemas, {str(s): int(s in written) for s in touched})
        return len(touched)
