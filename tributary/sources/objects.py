"""Log objects: gzip or plain newline-delimited JSON, one object per pod and time span."""

from __future__ import annotations

import bz2
import gzip
import zlib
from collections.abc import Iterator
from contextlib import ExitStack

import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.session import ship_with_tasks

ship_with_tasks(__name__)

SCAN_SUFFIX = ".json.gz"
NOTIFY_SUFFIX = ".gz"
#: Bytes read, or handed on, at once; the part of a plain object that one task reads; levels of folders opened one shuffle each.
BLOCK, SPLIT, LEVELS = 1 << 20, 64 << 20, 3
PACKED = (".gz", ".bz2")
#: Objects in a file of notes.
NOTED = 100_000


def lines(spark: SparkSession, path) -> DataFrame:
    """Plain line source: one column ``message``."""
    return spark.read.text(path, lineSep="\n").withColumnRenamed("value", "message")


def spread(df: DataFrame) -> DataFrame:
    """Redistributes rows when the scan has fewer partitions than cores.

    A gzip object is read by one task. Where a few large ones feed an expensive parse, moving the
    raw rows is cheaper than leaving cores idle. A scan of many objects is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def key_below(root: str) -> Column:
    """Object key of the current file: its path below the root folder, percent-decoded."""
    path = F.try_url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    base = root.rstrip("/") + "/"
    base = base[base.index(":") + 1 :].lstrip("/") if ":" in base.split("/")[0] else base.lstrip("/")
    at = F.instr(path, base)
    return F.when(at > 0, F.substring(path, at + len(base), F.length(path))).otherwise(path)


def store_root(spark: SparkSession, path: str, make: bool = False) -> str | None:
    """A folder as tasks open it. None for what only Spark's own sources open: patterns, single files, other file systems, nothing at all."""
    from pyarrow import fs

    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    root = store.makeQualified(place).toUri().toString()
    try:
        fs.FileSystem.from_uri(root)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return None
    if make:
        store.mkdirs(place)
    return root if store.exists(place) and store.getFileStatus(place).isDirectory() else None


def _hidden(name: str) -> bool:
    """Names that Spark's file sources leave out."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


_LISTED = pa.schema([("folder", pa.string()), ("object_key", pa.string()), ("size_bytes", pa.int64()), ("modified_ms", pa.int64())])


def _open_folders(root: str, deep: bool):
    """Objects and folders of the named folders, or all objects below them; objects found before pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        base = base.rstrip("/") + "/"
        for batch in batches:
            yield pa.RecordBatch.from_arrays(batch.filter(batch["folder"].is_null()).columns, schema=_LISTED)
            todo, found = batch["folder"].drop_null().to_pylist(), []
            while todo:
                for info in store.get_file_info(fs.FileSelector(base + todo.pop(), allow_not_found=True)):
                    name = info.path.removeprefix(base)
                    if _hidden(info.base_name):
                        continue
                    if info.type == fs.FileType.File:
                        found.append((None, name, info.size, info.mtime_ns // 1_000_000))
                    elif deep:
                        todo.append(name)
                    else:
                        found.append((name, None, None, None))
                if len(found) >= 10_000 or not todo:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*found) if found else [()] * 4, _LISTED)], schema=_LISTED)
                    found = []

    return run


def _found_objects(spark: SparkSession, root: str) -> DataFrame:
    """(object_key, size_bytes, modified_ms) of all objects below a folder, listed by tasks: nothing of it reaches the driver."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = "folder string, object_key string, size_bytes bigint, modified_ms bigint"
    none = F.lit(None).cast("bigint")
    rows = spark.range(1, numPartitions=1).select(F.lit("").alias("folder"), none.cast("string").alias("object_key"), none.alias("size_bytes"), none.alias("modified_ms"))
    for level in range(LEVELS + 1):
        rows = (rows.repartition(n) if level else rows).mapInArrow(_open_folders(root, level == LEVELS), schema)
    return rows.drop("folder").repartition(n)


def _blocks(store, name: str, start: int) -> Iterator[bytes]:
    """Unpacked content; that of a plain object from a place on."""
    with ExitStack() as opened:
        if name.endswith(PACKED):
            raw = opened.enter_context(store.open_input_stream(name, compression=None))
            reader = opened.enter_context(gzip.GzipFile(fileobj=raw) if name.endswith(".gz") else bz2.BZ2File(raw))
        else:
            reader = opened.enter_context(store.open_input_file(name))
            reader.seek(start)
        while block := reader.read(BLOCK):
            yield block


def _lines_of(store, name: str, start: int, stop: int) -> Iterator[tuple[int, bytes]]:
    """Lines that begin in a part of an object, with the place where they begin."""
    at, open_line, skip = max(start - 1, 0), [], start > 0
    for block in _blocks(store, name, at):
        first, *more = block.split(b"\n")
        open_line.append(first)
        for part in more:
            line = b"".join(open_line)
            if not skip:
                yield at, line.removeprefix(b"\xef\xbb\xbf") if not at else line
            at, open_line, skip = at + len(line) + 1, [part], False
            if at >= stop:
                return
    line = b"".join(open_line)
    if line and not skip:
        yield at, line.removeprefix(b"\xef\xbb\xbf") if not at else line


def _text(values: list) -> pa.Array:
    """Bytes as strings, whatever they hold."""
    kept = pa.array(values, pa.binary())
    return pa.Array.from_buffers(pa.string(), len(kept), kept.buffers())


def _read_lines(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        rows, held = [], 0

        def out():
            keys, places, texts, stamps = zip(*rows)
            return pa.record_batch([pa.array(keys, pa.string()), pa.array(places, pa.int64()), _text(texts), pa.array(stamps, pa.int64())], ["object_key", "line_no", "line", "upload_ms"])

        for batch in batches:
            for key, start, stamp in zip(*(batch[c].to_pylist() for c in ("object_key", "start", "modified_ms"))):
                stop = 1 << 62 if key.endswith(PACKED) else start + SPLIT
                for place, line in _lines_of(store, f"{base.rstrip('/')}/{key}", start, stop):
                    rows.append((key, place, line, stamp))
                    held += len(line) + 64
                    if held >= BLOCK:
                        yield out()
                        rows, held = [], 0
        if rows:
            yield out()

    return run


def read_log_objects(spark: SparkSession, path: str) -> DataFrame:
    """(object_key, line_no, line, upload_ms) of all objects below a folder; ``.gz`` and ``.bz2`` names are unzipped.

    ``line_no`` grows along a file but is not dense: numbering densely would cost a shuffle, and
    order is all that later operators need. Tasks list the folder each time the rows are computed, and large plain
    objects are read in parts.
    """
    if root := store_root(spark, path):
        whole = F.col("object_key").rlike(r"\.(gz|bz2)$")
        starts = F.when(whole, F.array(F.lit(0).cast("bigint"))).otherwise(F.sequence(F.lit(0).cast("bigint"), F.col("size_bytes"), F.lit(SPLIT).cast("bigint")))
        parts = _found_objects(spark, root).select("object_key", "modified_ms", F.explode(starts).alias("start"))
        return parts.mapInArrow(_read_lines(root), "object_key string, line_no bigint, line string, upload_ms bigint")
    raw = spark.read.option("recursiveFileLookup", "true").text(path, lineSep="\n")
    return raw.select(
        key_below(path).alias("object_key"),
        F.monotonically_increasing_id().alias("line_no"),
        F.col("value").alias("line"),
        F.unix_millis("_metadata.file_modification_time").alias("upload_ms"),
    )


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of each object, or one row with an error code; a broken object yields no line at all."""
    keys, places, texts, stamps, codes, held = [], [], [], [], [], 0

    def out():
        return pa.record_batch(
            [pa.array(keys, pa.string()), pa.array(places, pa.int64()), pa.array(texts, pa.string()), pa.array(stamps, pa.int64()), pa.array(codes, pa.string())],
            ["object_key", "line_no", "line", "upload_ms", "error_code"],
        )

    for batch in batches:
        for key, stamp, content in zip(batch["object_key"].to_pylist(), batch["upload_ms"].to_pylist(), batch["content"]):
            lines, code, text = [None], None, ""
            try:
                raw = content.as_py()
                text = (gzip.decompress(raw) if key.endswith(".gz") else raw).decode("utf-8", "replace")
                lines = text.removesuffix("\n").split("\n") if text else []
            except EOFError:
                code = "truncated"
            except (OSError, zlib.error):
                code = "corrupt"
            n = len(lines)
            keys += [key] * n
            places += range(n)
            texts += lines
            stamps += [stamp] * n
            codes += [code] * n
            held += len(text) + 64
            if held >= BLOCK:
                yield out()
                keys, places, texts, stamps, codes, held = [], [], [], [], [], 0
    yield out()


def note_new_objects(spark: SparkSession, root: str, notes: str, per_file: int | None = None) -> None:
    """Adds the objects below a folder that are not yet noted to ``notes``, files of (object_key, modified_ms) with at most ``per_file`` rows each.

    Tasks list the folder and compare; the driver sees a file of notes, not an object. What is noted stays so: an object is new once. One writer at a time."""
    schema = "object_key string, modified_ms bigint"
    found = _found_objects(spark, root).select("object_key", "modified_ms")
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(notes)
    begun = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
    if begun:
        found = found.join(spark.read.schema(schema).parquet(notes).select("object_key"), "object_key", "left_anti")
    found = found.persist(StorageLevel.DISK_ONLY)
    if (n := found.count()) or not begun:
        per_file = per_file or NOTED
        found.repartitionByRange(n // per_file + 1, "modified_ms", "object_key").write.mode("append").option("maxRecordsPerFile", per_file).parquet(notes)
    found.unpersist()


def stream_noted_objects(spark: SparkSession, root: str, notes: str, per_file: int | None = None) -> DataFrame:
    """Stream of (object_key, upload_ms, content) of the noted objects, opened by tasks; with ``per_file`` a file of notes makes a micro-batch."""
    reader = spark.readStream.schema("object_key string, modified_ms bigint")
    if per_file:
        reader = reader.option("maxFilesPerTrigger", 1)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return reader.parquet(notes).repartition(n).mapInArrow(_read_contents(root), "object_key string, upload_ms bigint, content binary")


def unpack_objects(files: DataFrame) -> DataFrame:
    """(object_key, line_no, line, upload_ms, error_code) of files (object_key, upload_ms, content), batch or stream.

    Each object is unpacked by itself: one that is ``corrupt`` or ``truncated`` gives one row with that code and no
    line, and the others go on. An object is held whole; the central sink bounds its size.
    """
    return files.mapInArrow(_unpack, "object_key string, line_no bigint, line string, upload_ms bigint, error_code string")


def whole_files(reader, path: str) -> DataFrame:
    """(object_key, upload_ms, content) of all files below a folder, from a batch or stream reader."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"  # streams ask for it
    files = reader.format("binaryFile").schema(schema).option("recursiveFileLookup", "true").load(path)
    return files.select(key_below(path).alias("object_key"), F.unix_millis("modificationTime").alias("upload_ms"), "content")


def _read_contents(root: str):
    """Contents of the listed objects; one that is gone meanwhile is left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        rows, held = [], 0

        def out():
            keys, stamps, contents = zip(*rows)
            return pa.record_batch([pa.array(keys, pa.string()), pa.array(stamps, pa.int64()), pa.array(contents, pa.binary())], ["object_key", "upload_ms", "content"])

        for batch in batches:
            for key, stamp in zip(batch["object_key"].to_pylist(), batch["modified_ms"].to_pylist()):
                try:
                    with store.open_input_stream(f"{base.rstrip('/')}/{key}", compression=None) as reader:
                        content = reader.read()
                except FileNotFoundError:
                    continue
                if rows and held + len(content) >= BLOCK:
                    yield out()
                    rows, held = [], 0
                rows.append((key, stamp, content))
                held += len(content) + 64
        if rows:
            yield out()

    return run


def read_each_object(spark: SparkSession, path: str) -> DataFrame:
    """As :func:`read_log_objects`, with an error code for each object that cannot be read."""
    if root := store_root(spark, path):
        return unpack_objects(_found_objects(spark, root).mapInArrow(_read_contents(root), "object_key string, upload_ms bigint, content binary"))
    return unpack_objects(whole_files(spark.read.option("ignoreMissingFiles", "true"), path))


def _read_whole(root: str):
    """Contents of the named objects, opened one by one on the executor; an error code for those that cannot be read."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        for frame in frames:
            rows, held = [], 0
            for key in frame["object_key"]:
                content = code = None
                try:
                    with store.open_input_stream(f"{base}/{key}", compression=None) as reader:
                        raw = reader.read()
                    content = (gzip.decompress(raw) if key.endswith(".gz") else raw).decode("utf-8", "replace")
                except FileNotFoundError:
                    code = "missing"
                except EOFError:
                    code = "truncated"
                except (OSError, zlib.error):
                    code = "corrupt"
                rows.append((key, content, code))
                held += len(content or "") + 64
                if held >= BLOCK:
                    yield pd.DataFrame(rows, columns=names, dtype=object)
                    rows, held = [], 0
            yield pd.DataFrame(rows, columns=names, dtype=object)

    names = ["object_key", "content", "error_code"]
    return run


def read_whole_objects(spark: SparkSession, path: str, keys: DataFrame | None = None) -> DataFrame:
    """(object_key, content, error_code), one row per file; with ``keys`` only those files are opened.

    The content of a ``missing``, ``truncated`` or ``corrupt`` file is null, and the others go on.
    """
    if keys is not None:
        wanted = keys.select("object_key").distinct()
        return wanted.mapInPandas(_read_whole(path), "object_key string, content string, error_code string")
    raw = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    return raw.select(key_below(path).alias("object_key"), F.col("value").alias("content"), F.lit(None).cast("string").alias("error_code"))


def list_objects(spark: SparkSession, path: str, bucket: str) -> DataFrame:
    """Listing without reading any content: (bucket, object_key, size_bytes, modified_ms). Tasks list the folder, each time the rows are computed."""
    if root := store_root(spark, path):
        return _found_objects(spark, root).select(F.lit(bucket).alias("bucket"), "object_key", "size_bytes", "modified_ms")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(
        F.lit(bucket).alias("bucket"),
        key_below(path).alias("object_key"),
        F.col("length").alias("size_bytes"),
        F.unix_millis("modificationTime").alias("modified_ms"),
    )


def with_suffix(df: DataFrame, suffix: str = SCAN_SUFFIX, key: str = "object_key") -> DataFrame:
    return df.filter(F.col(key).endswith(suffix))


def scan_new_objects(listing: DataFrame, ledger: DataFrame, suffix: str = SCAN_SUFFIX) -> DataFrame:
    """Objects with the suffix that no earlier scan has finished."""
    return with_suffix(listing, suffix).join(ledger.select("object_key"), "object_key", "left_anti")


def update_ledger(ledger: DataFrame, results: DataFrame) -> DataFrame:
    """Ledger plus the objects that succeeded; failed ones stay open for the next scan."""
    done = results.filter("succeeded").select("object_key")
    return ledger.select("object_key").unionByName(done).distinct()
