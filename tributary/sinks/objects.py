"""Gzip objects of lines, written by tasks below folders, visible once all are written.

Each object is written under a hidden name. What the tasks that count have written stands in a log, and a second pass moves just these objects to their
names, in tasks as well: a repeated task leaves nothing twice, and neither renames nor listings pass through the driver.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame

from tributary.session import ship_with_tasks
from tributary.sources.objects import store_root

ship_with_tasks(__name__)

EMPTY_FOLDER = "__HIVE_DEFAULT_PARTITION__"
BLOCK = 1 << 20
#: Characters that a folder's value shows as %XX, as in Spark's own partitioned writes.
UNSAFE = re.compile(r"""[\x01-\x1f\x7f"#%'*/:=?\\{\[\]^]""")


def _folder(names: Sequence[str], values: Sequence[str | None]) -> str:
    shown = (UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", v) if v else EMPTY_FOLDER for v in values)
    return "/".join(f"{n}={v}" for n, v in zip(names, shown))


class _Object:
    """One open object."""

    def __init__(self, store, base: str, folder: str, name: str):
        self.store, self.part, self.goal = store, f"{base}/{folder}/.{name}", f"{base}/{folder}/{name}"
        store.create_dir(f"{base}/{folder}", recursive=True)
        self.out, self.packer = store.open_output_stream(self.part, compression=None), zlib.compressobj(wbits=31)
        self.lines, self.held, self.size = [], 0, 0

    def add(self, line: bytes) -> None:
        self.lines.append(line)
        self.held += len(line) + 1
        self.size += len(line) + 1
        if self.held >= BLOCK:
            self.flush()

    def flush(self) -> None:
        self.out.write(self.packer.compress(b"".join(x + b"\n" for x in self.lines)))
        self.lines, self.held = [], 0

    def close(self) -> tuple[str, str]:
        self.flush()
        self.out.write(self.packer.flush())
        self.out.close()
        return self.part, self.goal


def _put(root: str, folders: Sequence[str], roll: str | None, limit: int, suffix: str, token: str):
    """Writes the lines of each folder, which come one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        task, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        store, base = fs.FileSystem.from_uri(root)
        base, open_, at, number, opened, done = base.rstrip("/"), None, None, 0, 0, []
        for batch in batches:
            names = zip(*(batch[f].to_pylist() for f in folders))
            for values, line in zip(names, batch["line"].cast(pa.binary()).to_pylist()):
                line = line or b""
                other = values != at
                if open_ is None or other or (roll and open_.size + len(line) + 1 > limit):
                    if open_:
                        done.append(open_.close())
                    at, number = values, 0 if other else number + 1
                    folder = _folder(folders, values) + (f"/{roll}={number}" if roll else "")
                    # Null and empty values share a folder, and keys are read without the roll: the count keeps names apart.
                    open_, opened = _Object(store, base, folder, f"part-{task:05d}-{token}-{attempt}-{opened}{suffix}"), opened + 1
                open_.add(line)
            if len(done) >= 1000:
                yield _moves(done)
                done = []
        if open_:
            done.append(open_.close())
        yield _moves(done)

    return run


def _moves(done: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([p for p, _ in done], pa.string()), pa.array([g for _, g in done], pa.string())], ["part", "goal"])


def _show(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(root)
        for batch in batches:
            for part, goal in zip(batch["part"].to_pylist(), batch["goal"].to_pylist()):
                try:
                    store.move(part, goal)
                except FileNotFoundError:  # moved by an earlier attempt
                    if store.get_file_info(goal).type != fs.FileType.File:
                        raise
            yield batch

    return run


def write_lines(rows: DataFrame, path: str, folders: Sequence[str], suffix: str, roll: str | None = None, limit: int = 0) -> None:
    """Adds objects with the lines of ``rows`` (text columns ``folders`` and ``line``) to a folder that tasks can open.

    Rows are dealt out, and sorted by folder, by the caller: a folder gets one object from each task that has rows of it. With ``roll``, a folder
    of that name numbers its objects, which hold at most ``limit`` bytes of unpacked lines, or one longer line.
    """
    spark = rows.sparkSession
    root = store_root(spark, path, make=True)
    if root is None:
        raise ValueError(f"tasks cannot open {path}")
    log, schema = f"{path.rstrip('/')}/_written-{uuid4().hex}", "part string, goal string"
    rows.select(*folders, "line").mapInArrow(_put(root, folders, roll, limit, suffix, uuid4().hex), schema).write.parquet(log)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.read.schema(schema).parquet(log).repartition(n).mapInArrow(_show(root), schema).write.format("noop").mode("overwrite").save()
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(log)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
