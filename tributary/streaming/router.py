"""New central objects -> routing -> event batches, copy plans and metrics, continuously."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial
from threading import Thread

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tributary.constants import MAX_BATCH_BYTES, MAX_BATCH_EVENTS
from tributary.operators import accounting as A
from tributary.operators import configs as C
from tributary.operators import delivery as D
from tributary.operators import records as R
from tributary.operators import routing as RT
from tributary.sinks.central import bare_key
from tributary.sources.objects import SCAN_SUFFIX, note_new_objects, store_root, stream_noted_objects, unpack_objects, whole_files, with_suffix
from tributary.session import ensure_checkpoint_dir
from tributary.streaming.collector import now_ms

#: Seconds between two looks at the source.
INTERVAL_S = 10


@dataclass(frozen=True)
class RouterConf:
    """Where a router reads and writes; ``configs`` is called for every micro-batch, so changes apply at once."""

    source: str
    bucket: str
    output: str
    checkpoint: str
    configs: Callable[[], DataFrame]
    as_of: int | None = None
    files_per_batch: int | None = None
    max_events: int = MAX_BATCH_EVENTS
    max_bytes: int = MAX_BATCH_BYTES
    chunks: int | None = None
    suffix: str = SCAN_SUFFIX


def read_object_lines(spark: SparkSession, path: str, files_per_batch: int | None = None, notes: str | None = None) -> DataFrame:
    """Stream of (object_key, line_no, line, upload_ms, error_code) of new objects; the checkpoint is the ledger.

    An object that cannot be unpacked gives one row with an error code instead of failing its micro-batch. With ``notes``, a folder kept by
    :func:`note_new_objects`, the stream takes the objects noted there and tasks open them; else Spark's file source lists the objects in the driver.
    """
    if notes and (root := store_root(spark, path)):
        return unpack_objects(stream_noted_objects(spark, root, notes, files_per_batch)).withColumn("object_key", bare_key(F.col("object_key")))
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return unpack_objects(whole_files(reader, path)).withColumn("object_key", bare_key(F.col("object_key")))


def route_lines(
    lines: DataFrame,
    configs: DataFrame,
    bucket: str,
    as_of,
    max_events: int = MAX_BATCH_EVENTS,
    max_bytes: int = MAX_BATCH_BYTES,
    chunks: int | None = None,
    suffix: str = SCAN_SUFFIX,
) -> dict[str, DataFrame]:
    """All tables of one run: rejects, unroutable, copies, batches, failed objects and metrics.

    Routing works on keys; only lines of objects with an event delivery are parsed. Rows with an ``error_code``, if
    there is such a column, stand for objects that could not be read: their event deliveries are failed objects.
    """
    unreadable = None
    if "error_code" in lines.columns:
        unreadable, lines = lines.filter("error_code is not null"), lines.filter("error_code is null").drop("error_code")
    readable_or_not = lines.select("object_key", "upload_ms")
    if unreadable is not None:
        readable_or_not = readable_or_not.unionByName(unreadable.select("object_key", "upload_ms"))
    seen = readable_or_not.groupBy("object_key").agg(F.max("upload_ms").alias("upload_ms")).withColumn("bucket", F.lit(bucket))
    objects = with_suffix(seen, suffix)
    valid, rejects = RT.split_valid_keys(objects)
    named = RT.extract_tenant_info(valid)
    routable = C.routable_configs(configs, as_of)
    routed = RT.route(named, routable)
    wanted = D.lines_to_deliver(with_suffix(lines, suffix), routable)
    # Statistics, fallback and packing all read the records: parse once, pin the result.
    ensure_checkpoint_dir(lines.sparkSession)
    records = R.parse_lines(wanted).drop("line").checkpoint()
    events, failed = R.object_events(wanted, as_of, records, D.STREAM)
    if unreadable is not None:
        lost_ones = D.lines_to_deliver(with_suffix(unreadable.drop("error_code"), suffix), routable)
        failed = failed.unionByName(lost_ones.select("object_key", *D.STREAM, F.lit("recoverable").alias("error_class")))
    deliveries = R.fallback_ts(events).drop("upload_ms")
    packed = D.pack_deliveries(deliveries, max_events, max_bytes, chunks)
    batches = D.delivery_batches(packed)
    stamp = F.timestamp_millis(as_of if not isinstance(as_of, int) else F.lit(as_of).cast("bigint"))
    sent = batches.groupBy("tenant_id", "object_key").agg(
        F.sum("events").alias("successful_events"), F.lit(0).cast("bigint").alias("failed_events")
    )
    lost = failed.select(
        "tenant_id", "object_key", F.lit(0).cast("bigint").alias("successful_events"), F.lit(1).cast("bigint").alias("failed_events")
    )
    return {
        "rejects": rejects,
        "unroutable": RT.unroutable(named, C.unexpired_configs(configs, as_of), routable),
        "copies": D.plan_object_copies(routed, as_of),
        "batches": batches,
        "failed_objects": failed,
        "metrics": A.event_delivery_metrics(sent.unionByName(lost).withColumn("ts", stamp)),
    }


def _keep_noting(query: StreamingQuery, note: Callable[[], None], every_s: float) -> None:
    """Notes new objects as long as the query runs; a listing that fails ends the query."""
    try:
        while not query.awaitTermination(every_s):
            note()
    except Exception:
        if query.isActive:
            query.stop()
            raise


def start_router(spark: SparkSession, conf: RouterConf, once: bool = False) -> StreamingQuery:
    """Each micro-batch writes its tables below ``output/<table>/run=<n>``; a replay writes the same place.

    Tasks list the source, before the query starts and then every ten seconds, and note new objects in a folder of the checkpoint. A checkpoint that
    a router without notes began keeps its file source, which knows what has been delivered."""
    ensure_checkpoint_dir(spark)
    notes = f"{conf.checkpoint.rstrip('/')}/objects"
    begun = store_root(spark, f"{conf.checkpoint.rstrip('/')}/offsets") and not store_root(spark, notes)
    root = None if begun else store_root(spark, conf.source)
    note = partial(note_new_objects, spark, root, notes, conf.files_per_batch)
    if root:
        note()

    def run(batch: DataFrame, number: int) -> None:
        # Several tables come from the same lines; a reliable checkpoint reads the objects once.
        kept = batch.checkpoint()
        as_of = conf.as_of if conf.as_of is not None else now_ms()
        tables = route_lines(
            kept, conf.configs(), conf.bucket, as_of, conf.max_events, conf.max_bytes, conf.chunks, conf.suffix
        )
        for name, table in tables.items():
            table.write.mode("overwrite").parquet(f"{conf.output}/{name}/run={number}")

    lines = read_object_lines(spark, conf.source, conf.files_per_batch, notes if root else None)
    trigger = {"availableNow": True} if once else {"processingTime": f"{INTERVAL_S} seconds"}
    query = lines.writeStream.foreachBatch(run).option("checkpointLocation", conf.checkpoint).trigger(**trigger).start()
    if root and not once:
        Thread(target=_keep_noting, args=(query, note, INTERVAL_S), daemon=True).start()
    return query
