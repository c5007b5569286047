"""Queue messages -> deliveries -> retries and dead letters, run after run.

A run takes the messages of a micro-batch and those of earlier runs that have become visible again, delivers what they name, and commits
all its tables together. Nothing of an unfinished run is seen by the next one.

* A failed event delivery sends its message back with its offset, one more retry and a growing delay; only the deliveries that failed are
  tried again. Without a receipt handle, or above the retry limit, it is dropped.
* A message that could not be understood but is worth a retry comes back after the visibility time. One received too often becomes a dead letter, one kept too
  long expires.
* A destination's answers are rows: a call that failed, or the places of events refused for their time.

No state is rewritten: a waiting message is taken by the first run whose time has reached its own, so whether a row has been taken follows from the
times in the manifests.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tributary.constants import MAX_BATCH_BYTES, MAX_BATCH_EVENTS, MAX_RECEIVE_COUNT, MAX_RETRIES, MESSAGE_RETENTION_S, VISIBILITY_TIMEOUT_S
from tributary.operators import accounting as A
from tributary.operators import configs as C
from tributary.operators import delivery as D
from tributary.operators import queue as Q
from tributary.operators import records as R
from tributary.operators import routing as RT
from tributary.operators.packing import pack_batches
from tributary.session import ensure_checkpoint_dir
from tributary.sinks.commits import Run, RunStore, observed_max
from tributary.sources.notifications import parse_notifications

MESSAGE = ["message_id", "body", "receipt_handle", "receive_count", "sent_ms", "visible_ms"]
#: What a message waits with besides: the deliveries to try (null: all).
WAITING = [*MESSAGE, "only"]
#: One delivery of one record of one message.
ATTEMPT = ["message_id", "record_idx", "object_key", "tenant_id", "type"]


def accept_in_time(as_of: int, max_age_ms: int = 14 * 86_400_000, max_ahead_ms: int = 2 * 3_600_000) -> Callable[[DataFrame], DataFrame]:
    """A destination that takes every call and refuses events by their age, as the published limits say."""

    def send(batches: DataFrame) -> DataFrame:
        age = lambda e: F.lit(as_of) - e["event_ts_ms"]
        old = F.size(F.filter("log_events", lambda e: age(e) > max_age_ms))
        new = F.size(F.filter("log_events", lambda e: age(e) < -max_ahead_ms))
        return batches.withColumns({
            "failed": F.lit(False), "too_new_start": F.when(new > 0, F.col("events") - new), "too_old_end": F.when(old > 0, (old - 1).cast("bigint")),
            "expired_end": F.lit(None).cast("bigint"),
        })

    return send


def copy_all(plan: DataFrame) -> DataFrame:
    """A store that takes every copy."""
    return plan.withColumn("succeeded", F.lit(True))


@dataclass(frozen=True)
class DeliveryConf:
    """Where runs read and write.

    ``listing`` gives (object_key, upload_ms) of those objects of a table of keys that are there, ``objects`` their (object_key, line_no, line, error_code): an error code
    stands in a row without a line, for an object that cannot be read. ``send`` takes event batches and adds failed,
    too_new_start, too_old_end and expired_end; ``copy`` takes a copy plan and adds succeeded. Both are made for a run's time. ``clock`` gives that time in epoch
    ms for a run number; it must not go back.
    """

    output: str
    listing: Callable[[DataFrame], DataFrame]
    objects: Callable[[DataFrame], DataFrame]
    configs: Callable[[], DataFrame]
    send: Callable[[int], Callable[[DataFrame], DataFrame]] = accept_in_time
    copy: Callable[[int], Callable[[DataFrame], DataFrame]] = lambda as_of: copy_all
    clock: Callable[[int], int] = lambda run: time.time_ns() // 1_000_000
    max_retries: int = MAX_RETRIES
    max_receive: int = MAX_RECEIVE_COUNT
    visibility_s: int = VISIBILITY_TIMEOUT_S
    retention_s: int = MESSAGE_RETENTION_S
    max_events: int = MAX_BATCH_EVENTS
    max_bytes: int = MAX_BATCH_BYTES
    chunks: int | None = None


def due_messages(store: RunStore, runs: list[Run], as_of: int) -> DataFrame | None:
    """Waiting messages of earlier runs that no run has taken yet and that are visible by now.

    Runs whose last waiting message was due before the last run began are not opened."""
    if not runs:
        return None
    last = runs[-1]
    fresh = [r for r in runs if r is last or r.counts.get("last_visible_ms", 0) > last.as_of]
    waiting = store.read("queue", fresh)
    if waiting is None:
        return None
    untaken = (F.col("run") == last.run) | (F.col("visible_ms") > last.as_of)
    return waiting.where(untaken & (F.col("visible_ms") <= as_of)).select(*WAITING)


def untaken_messages(store: RunStore) -> DataFrame | None:
    """All messages that wait for a later run."""
    return due_messages(store, store.runs(), 2**62)


def _stream_name(type_: str = "type", key: str = "object_key"):
    return F.concat_ws(" ", type_, key)


def _routed(notes: DataFrame, configs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Deliveries of the records that name a good key, and the records with a bad one."""
    valid, bad = RT.split_valid_keys(notes.where("object_key is not null"))
    routed = RT.route(RT.extract_tenant_info(valid), configs)
    wanted = F.col("only").isNull() | F.array_contains("only", _stream_name())
    return routed.where(wanted), bad


def _skipped(events: DataFrame) -> DataFrame:
    """Events behind their delivery's offset, in file order. Only deliveries with an offset are numbered; one is the events of one object, whose size the central sink bounds."""
    cut = events.where("offset > 0").withColumn("_rank", F.row_number().over(Window.partitionBy(*ATTEMPT).orderBy("line_no", "item_no")))
    return events.where("offset <= 0").unionByName(cut.where("_rank > offset").drop("_rank"))


def run_tables(spark: SparkSession, conf: DeliveryConf, received: DataFrame, as_of: int) -> tuple[dict[str, DataFrame], Observation]:
    """All tables of one run over the received messages (columns of ``WAITING``), but for those that still wait, and the counts of lines, records and events."""
    ensure_checkpoint_dir(spark)
    notes = parse_notifications(received.select("message_id", "body", "receipt_handle", "only")).checkpoint()
    configs = conf.configs()
    routable = C.routable_configs(configs, as_of)
    routed, bad_keys = _routed(notes, routable)
    uploads = conf.listing(routed.select("object_key").distinct()).select("object_key", "upload_ms")
    routed = routed.join(uploads, "object_key", "left").checkpoint()
    streams = RT.event_destination(routed.where("type = 'cloudwatch'"))

    # Objects are read and parsed once, however many messages and deliveries name them. Lines stay only where no event came out of them: the
    # whole-file fallback looks at objects without any event. What stands for an unreadable object is no JSON.
    lines = conf.objects(streams.where("upload_ms is not null").select("object_key").distinct())
    shown = lines.withColumn("line", F.when(F.col("error_code").isNull(), F.col("line")).otherwise(F.lit("unreadable")))
    counts, first = Observation("stages"), (F.col("item_no") == 0) & F.col("error_code").isNull()
    records = R.parse_lines(shown).withColumn("line", F.when((F.col("item_no") == 0) & ~F.col("is_object"), F.col("line"))).observe(
        counts, F.count_if(first).alias("lines"), F.count_if(first & F.col("parse_error")).alias("broken_lines"),
        F.count_if(~F.col("parse_error")).alias("records"), F.count_if("is_object").alias("events"),
    ).checkpoint()
    parsed, unparsed = R.object_events(records.where("line is not null").select("object_key", "line_no", "line"), as_of, records.drop("line", "error_code"))
    lost = unparsed.select("object_key").distinct().withColumn("lost", F.lit(True))

    # Event deliveries.
    carried = [*ATTEMPT, "log_group", "log_stream", "offset", "retry_count", "upload_ms"]
    events = R.fallback_ts(RT.lookup_join(parsed, streams.select(*carried), ["object_key"])).drop("upload_ms")
    events = _skipped(events)
    keys = [*ATTEMPT, "retry_count", "log_group", "log_stream"]
    packed = pack_batches(events, keys, ["event_ts_ms", "line_no", "item_no"], max_events=conf.max_events, max_bytes=conf.max_bytes, chunks=conf.chunks, costly=True)
    batches = conf.send(as_of)(D.delivery_batches(packed, keys)).checkpoint()
    stats = A.event_stats(A.rejection_stats(batches), ATTEMPT)
    whole = batches.groupBy(*ATTEMPT).agg(F.sum("events").alias("events"))
    reported = A.reported_stats(stats.join(whole, ATTEMPT)).select(*ATTEMPT, "events", "successful_events", "failed_events")
    none = F.lit(0).cast("bigint")
    failing = F.col("lost").isNotNull() | F.col("upload_ms").isNull()
    of_object = streams.join(lost, "object_key", "left").join(reported, ATTEMPT, "left")
    sent = of_object.select(
        *ATTEMPT, "offset", "retry_count", "receipt_handle", "upload_ms", (~failing & (F.coalesce("failed_events", none) == 0)).alias("succeeded"),
        F.coalesce("events", none).alias("events"), F.coalesce("successful_events", none).alias("successful_events"),
        F.when(F.col("lost").isNotNull(), F.lit(1).cast("bigint")).otherwise(F.coalesce("failed_events", none)).alias("failed_events"),
    )

    # Copies: an object that is not there fails, any other is copied without a look at its content.
    to_copy = routed.where("type = 's3'")
    plan = D.plan_object_copies(to_copy.where("upload_ms is not null"), as_of).dropDuplicates(["copy_source", "dst_bucket", "dst_key"])
    copied = conf.copy(as_of)(plan).select("tenant_id", "object_key", "bucket", "succeeded")
    outcome = to_copy.join(copied.groupBy("tenant_id", "object_key", "bucket").agg(F.min("succeeded").alias("done")), ["tenant_id", "object_key", "bucket"], "left")
    copies = outcome.select(
        *ATTEMPT, "offset", "retry_count", "receipt_handle", "upload_ms", F.coalesce("done", F.lit(False)).alias("succeeded"),
        *[none.alias(c) for c in ("events", "successful_events", "failed_events")],
    )
    attempts = sent.unionByName(copies).withColumns({"delivered_ms": F.lit(as_of).cast("bigint"), "ts": F.timestamp_millis(F.lit(as_of).cast("bigint"))}).checkpoint()

    # What goes back to the queue: one message, however many of its deliveries failed.
    failed = Q.event_failures(attempts)
    again = failed.groupBy("message_id").agg(
        F.max("offset").alias("offset"), F.max("retry_count").alias("retry_count"), F.array_sort(F.collect_set(_stream_name())).alias("failed_deliveries")
    )
    failures = received.drop("only").join(again, "message_id")
    requeued = Q.requeue(failures.drop("failed_deliveries"), as_of, conf.max_retries).join(again.select("message_id", F.col("failed_deliveries").alias("only")), "message_id")
    requeued = requeued.join(received.select("message_id", "receipt_handle"), "message_id")
    back = requeued.select("message_id", "body", "receipt_handle", F.lit(0).alias("receive_count"), F.lit(as_of).cast("bigint").alias("sent_ms"), "visible_ms", "only")
    unclear = notes.where("error_class = 'recoverable'").select("message_id").distinct()
    kept = received.join(unclear, "message_id", "left_semi").withColumn("visible_ms", F.lit(as_of + conf.visibility_s * 1000).cast("bigint")).select(*WAITING)

    results = notes.groupBy("message_id").agg(F.min("error_class").alias("error_class")).join(A.delivery_stats(attempts), "message_id", "left")
    published = attempts.where("events > 0 or failed_events > 0 or type = 's3'")
    of_copies = published.where(F.col("type") == "s3")
    metrics = A.event_delivery_metrics(published.where("type = 'cloudwatch'")).unionByName(A.object_delivery_metrics(of_copies)).unionByName(A.latency_metrics(published))
    rejects = notes.where("error_code is not null").select("message_id", "record_idx", "object_key", F.col("error_code").alias("reason"))
    tables = {
        "waiting": back.unionByName(kept),
        "attempts": attempts.select(*ATTEMPT, "retry_count", "succeeded", "events", "successful_events", "failed_events", "upload_ms", "delivered_ms"),
        "batches": batches,
        "copies": plan,
        "rejects": rejects.unionByName(bad_keys.select("message_id", "record_idx", "object_key", "reason")),
        "late": A.late_events(events, as_of, ATTEMPT).where("not delivered").drop("delivered"),
        "metrics": metrics,
        "item_failures": A.batch_item_failures(results),
        "summary": A.batch_summary(results),
    }
    return tables, counts


def deliver(spark: SparkSession, conf: DeliveryConf, messages: DataFrame | None = None, source: str | None = None) -> Run:
    """One run over new messages (columns of ``MESSAGE``; None: retries only). A source that has been committed is not run again.

    ``message_id`` names a message: a redelivered copy in one run counts once, the latest one."""
    store = RunStore(spark, conf.output)
    runs = store.runs()
    if source is not None and (done := [r for r in runs if r.source == source]):
        return done[-1]
    number = runs[-1].run + 1 if runs else 0
    as_of = int(conf.clock(number))
    if runs and as_of < runs[-1].as_of:
        raise ValueError(f"run {number} would begin before run {runs[-1].run}")
    parts = [due_messages(store, runs, as_of)]
    if messages is not None:
        parts.append(messages.select(*MESSAGE, F.lit(None).cast("array<string>").alias("only")))
    found = None
    for part in parts:
        if part is not None:
            found = part if found is None else found.unionByName(part)
    if found is None:
        raise ValueError("no messages, and no earlier run to take any from")
    newest = F.struct("receive_count", "visible_ms", *[c for c in WAITING if c not in ("message_id", "receive_count", "visible_ms")])
    once = found.groupBy("message_id").agg(F.max(newest).alias("m")).select("message_id", "m.*").select(*WAITING)
    ensure_checkpoint_dir(spark)
    judged = once.withColumn("_state", Q.queue_state(as_of, conf.max_receive, conf.retention_s)).checkpoint()
    received = judged.where("_state = 'visible'").withColumn("receive_count", F.col("receive_count") + 1).select(*WAITING)
    tables, counted = run_tables(spark, conf, received, as_of)
    tables["queue"] = tables.pop("waiting").unionByName(judged.where("_state in ('delayed', 'in_flight')").select(*WAITING))
    tables["dead_letters"] = judged.where("_state = 'dead_letter'").select(*MESSAGE)
    tables["expired"] = judged.where("_state = 'expired'").select(*MESSAGE)
    attempt, schemas = store.write(number, tables)
    counts = {k: int(v) for k, v in counted.get.items()}
    counts["last_visible_ms"] = observed_max(store.written(number, attempt, "queue"), "visible_ms") or 0
    store.commit(number, source or f"retries {number}", as_of, attempt, schemas, counts)
    return store.runs()[-1]


def start_deliveries(messages: DataFrame, conf: DeliveryConf, checkpoint: str, once: bool = False) -> StreamingQuery:
    """A run for each micro-batch of a message stream. A micro-batch that was committed before a crash is not delivered again.

    A stream without new messages makes no run: call :func:`deliver` on a schedule for retries that become due meanwhile."""
    spark = messages.sparkSession

    def run(batch: DataFrame, number: int) -> None:
        deliver(spark, conf, batch, f"{checkpoint} {number}")

    trigger = {"availableNow": True} if once else {"processingTime": "10 seconds"}
    return messages.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**trigger).start()
