"""Heartbeat alerts and period statistics over streams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tributary.constants import HEARTBEAT_MAX_GAP_S, MAX_RECEIVE_COUNT, MESSAGE_RETENTION_S, VISIBILITY_TIMEOUT_S
from tributary.operators.accounting import STATISTICS
from tributary.session import ship_with_tasks

ship_with_tasks(__name__)


#: Many beat intervals (30 s): a beat that a slow collector delivers minutes late raises no false alert.
LATENESS = "10 minutes"


def late_rows(query: StreamingQuery) -> int:
    """Rows the query dropped so far because they came after the watermark, over the progress Spark keeps."""
    states = [s for p in query.recentProgress for s in p["stateOperators"]]
    return sum(s["numRowsDroppedByWatermark"] for s in states)


def heartbeat_alerts(
    beats: DataFrame, key: str = "cluster_id", max_gap_s: int = HEARTBEAT_MAX_GAP_S, lateness: str = LATENESS
) -> DataFrame:
    """One row per silence longer than the limit: key, last_beat, first_beat, beats.

    A silence is the end of a session: beats no further apart than the limit form one, and append
    mode emits it as soon as the watermark has passed its end. Sessions are merged on the map side. Beats
    that come up to ``lateness`` after newer ones still count; :func:`late_rows` tells how many came later than that.
    """
    live = beats.withWatermark("ts", lateness)
    # The limit itself is no silence yet, so a session reaches one millisecond further.
    session = F.session_window("ts", f"{max_gap_s * 1000 + 1} milliseconds")
    return (
        live.groupBy(key, session)
        .agg(F.max("ts").alias("last_beat"), F.min("ts").alias("first_beat"), F.count("*").alias("beats"))
        .select(key, "last_beat", "first_beat", "beats")
    )


class SilenceWatch(StatefulProcessor):
    """State of one key: the beats whose silence is not decided yet, in order, and one timer for the first of them.

    Times are doubled milliseconds, plus one for a real beat; an even number is the time from which the key is known.
    A beat is decided once the watermark (or the clock) has passed it by the limit: nothing that still counts can come in
    between then. So beats that come late, in any order and batch, give the same alerts as beats in order.
    """

    def __init__(self, key: str, gap_ms: int, event_time: bool, forget_s: int | None):
        self.key, self.gap_ms, self.event_time, self.forget_s = key, gap_ms, event_time, forget_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        ttl = None if self.event_time or self.forget_s is None else self.forget_s * 1000
        self.open = handle.getValueState("open", "beats binary", ttl)

    def _now(self, timers) -> int:
        return timers.getCurrentWatermarkInMs() if self.event_time else timers.getCurrentProcessingTimeInMs()

    def _beats(self) -> np.ndarray:
        return np.frombuffer(bytes(self.open.get()[0]), np.int64) if self.open.exists() else np.zeros(0, np.int64)

    def _keep(self, before: np.ndarray, beats: np.ndarray) -> None:
        """Stores the open beats; the timer stands at the first of them."""
        if not len(beats):
            self.open.clear()
            return
        self.open.update((beats.tobytes(),))
        if not len(before) or before[0] != beats[0]:
            self.handle.registerTimer(int(beats[0] // 2) + self.gap_ms + 1)

    def _alerts(self, name, timers) -> Iterator[pd.DataFrame]:
        """Alerts of all beats that can be decided by now."""
        beats = self._beats()
        if not self.event_time:  # on the clock only the newest beat counts
            beats = beats[-1:]
        done = int(np.searchsorted(beats // 2, self._now(timers) - self.gap_ms - 1, side="right"))
        at = beats // 2
        silent = np.append(at[1:] - at[:-1] > self.gap_ms, True)[:done] if done else np.zeros(0, bool)
        self._keep(np.zeros(0, np.int64), beats[done:])
        if silent.any():
            ends = beats[:done][silent]
            stamp = pd.to_datetime(pd.Series(np.where(ends % 2 == 1, ends // 2, np.iinfo(np.int64).min)), unit="ms").where(ends % 2 == 1)
            yield pd.DataFrame({self.key: [name[0]] * len(ends), "last_beat": stamp, "silent_from": pd.to_datetime(pd.Series(ends // 2), unit="ms")})

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        known = initialState["known_ms"].to_numpy(np.int64) * 2
        self._keep(np.zeros(0, np.int64), np.sort(known)[:1])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = self._beats()
        new = [f["beat_ms"].to_numpy(np.int64) * 2 + 1 if self.event_time else np.array([self._now(timerValues) * 2 + 1]) for f in rows]
        beats = np.unique(np.concatenate([before, *new]))
        self._keep(before, beats if self.event_time else beats[-1:])
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        return self._alerts(key, timerValues)


def silence_alerts(
    beats: DataFrame, key: str = "cluster_id", max_gap_s: int = HEARTBEAT_MAX_GAP_S, lateness: str = LATENESS, known: DataFrame | None = None, event_time: bool = True,
    forget_s: int | None = None,
) -> DataFrame:
    """(key, last_beat, silent_from) of each silence of more than ``max_gap_s`` seconds, once for each.

    ``known`` lists keys (key, ts) that should beat from that time on: one that never does is alerted with no last_beat. In event time, an alert comes when
    the watermark has passed the limit, and beats up to ``lateness`` late still count. Otherwise timers follow the wall clock and fire without any
    further row, even if every key has fallen silent; a key without beats for ``forget_s`` seconds is then forgotten. Append mode; needs the
    RocksDB state store (:func:`use_rocksdb`).
    """
    use_rocksdb(beats.sparkSession)
    schema = T.StructType([T.StructField(key, beats.schema[key].dataType), T.StructField("last_beat", T.TimestampType()), T.StructField("silent_from", T.TimestampType())])
    live = beats.withWatermark("ts", lateness) if event_time else beats
    rows = live.select(key, "ts", F.unix_millis("ts").alias("beat_ms"))
    initial = None if known is None else known.select(key, F.unix_millis("ts").alias("known_ms")).groupBy(key)
    watch = SilenceWatch(key, max_gap_s * 1000, event_time, forget_s)
    return rows.groupBy(key).transformWithStateInPandas(watch, schema, "Append", "EventTime" if event_time else "ProcessingTime", initial)


#: A time that has not come.
NEVER = np.iinfo(np.int64).max
#: Groups of messages that share one state by default.
BUCKETS = 1024


@dataclass
class Messages:
    """Undecided messages of one bucket. ``receives`` holds (message, time) in order; a dead letter keeps its place until it expires."""

    keys: pa.Array
    sent: np.ndarray
    deleted: np.ndarray
    done: np.ndarray
    receives: np.ndarray

    @staticmethod
    def unpack(raw: bytes | None) -> Messages:
        if raw is None:
            return Messages(pa.array([], pa.string()), *(np.zeros(0, np.int64) for _ in range(2)), np.zeros(0, bool), np.zeros((2, 0), np.int64))
        rows = pa.ipc.open_stream(raw).read_all().combine_chunks()
        sent, deleted, done, counts = (rows[c].to_numpy() for c in ("sent", "deleted", "done", "counts"))
        times = np.frombuffer(rows.schema.metadata[b"receives"], np.int64)
        return Messages(rows["key"].chunk(0) if len(rows) else pa.array([], pa.string()), sent, deleted, done, np.stack([np.repeat(np.arange(len(rows)), counts), times]))

    def pack(self) -> bytes:
        counts = np.bincount(self.receives[0], minlength=len(self.keys))
        rows = pa.table({"key": self.keys, "sent": self.sent, "deleted": self.deleted, "done": self.done, "counts": counts})
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, rows.schema.with_metadata({"receives": self.receives[1].tobytes()})) as writer:
            writer.write_table(rows)
        return out.getvalue().to_pybytes()

    def add(self, keys: pa.Array, kind: np.ndarray, at: np.ndarray) -> Messages:
        """With further events. Receives of a dead letter count no more."""
        coded = pa.concat_arrays([self.keys, keys]).dictionary_encode(null_encoding="encode")
        place, n = coded.indices.to_numpy(), len(coded.dictionary)
        old, new = place[: len(self.keys)], place[len(self.keys) :]
        sent, deleted, done = np.full(n, NEVER), np.full(n, NEVER), np.zeros(n, bool)
        sent[old], deleted[old], done[old] = self.sent, self.deleted, self.done
        for first, name in ((sent, "sent"), (deleted, "deleted")):
            np.minimum.at(first, new[kind == name], at[kind == name])
        came = (kind == "received") & ~done[new]
        of, times = np.append(old[self.receives[0]], new[came]), np.append(self.receives[1], at[came])
        order = np.lexsort((times, of))
        return Messages(coded.dictionary, sent, deleted, done, np.stack([of[order], times[order]]))

    def keep(self, kept: np.ndarray, counted: np.ndarray) -> Messages:
        """The kept messages, with the receives of the ``counted`` ones."""
        held = (kept & counted)[self.receives[0]]
        place = np.cumsum(kept) - 1
        receives = np.stack([place[self.receives[0][held]], self.receives[1][held]])
        return Messages(self.keys.filter(pa.array(kept)), self.sent[kept], self.deleted[kept], self.done[kept], receives)


class MessageWatch(StatefulProcessor):
    """State of a bucket of messages: when each was sent, deleted and received, and whether it has been decided.

    The bucket's timer stands where the first of its messages can be decided: where a receive becomes void or where a message expires. Messages are judged
    once the watermark has passed that time, when nothing that still counts can change the order of what happened before. A message by itself would
    cost several calls to the state store in every micro-batch; a bucket's state is read and written as a whole.
    """

    def __init__(self, key: str, max_receive: int, visibility_ms: int, retention_ms: int):
        self.key, self.max_receive, self.visibility_ms, self.retention_ms = key, max_receive, visibility_ms, retention_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("messages", "packed binary, due_ms bigint")

    def _load(self) -> tuple[Messages, int]:
        packed, due = self.state.get() if self.state.exists() else (None, NEVER)
        return Messages.unpack(None if packed is None else bytes(packed)), due

    def _ends(self, m: Messages) -> tuple[np.ndarray, np.ndarray]:
        """When each message becomes a dead letter, and when it expires, as far as is known."""
        expires = np.where(m.sent < NEVER, np.minimum(m.sent, NEVER - self.retention_ms) + self.retention_ms, NEVER)
        dead = np.full(len(m.keys), NEVER)
        counts = np.bincount(m.receives[0], minlength=len(m.keys))
        often = np.flatnonzero((counts >= self.max_receive) & ~m.done)
        last = m.receives[1][(np.cumsum(counts) - counts)[often] + self.max_receive - 1] + self.visibility_ms
        dead[often] = np.where((m.deleted[often] <= last) | (last > expires[often]), NEVER, last)
        return dead, expires

    def _store(self, m: Messages, timer: int) -> None:
        """The bucket's state, and its timer if that has moved."""
        if not len(m.keys):
            self.state.clear()
            return
        due = int(min(x.min() for x in self._ends(m)))
        self.state.update((m.pack(), due))
        if due != timer:
            if timer < NEVER:
                self.handle.deleteTimer(timer)
            if due < NEVER:
                self.handle.registerTimer(due)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        m, due = self._load()
        new = pd.concat([f[[self.key, "kind", "at_ms"]] for f in rows], ignore_index=True)
        new = new[new["at_ms"].notna()]
        self._store(m.add(pa.array(new[self.key], pa.string(), from_pandas=True), new["kind"].to_numpy(), new["at_ms"].to_numpy(np.int64)), due)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        m, _ = self._load()
        if not len(m.keys):
            return
        now = timerValues.getCurrentWatermarkInMs()
        dead_ms, expires = self._ends(m)
        dead, over = dead_ms <= now, expires <= now
        expired = over & ~m.done & ~dead & (m.deleted > expires)
        counts = np.bincount(m.receives[0], minlength=len(m.keys))
        m.done |= dead
        self._store(m.keep(~over, ~m.done), NEVER)  # the timer that has just expired goes by itself
        for which, outcome, at, received in ((dead, "dead_letter", dead_ms, np.full(len(counts), self.max_receive)), (expired, "expired", expires, counts)):
            if which.any():
                yield pd.DataFrame({self.key: m.keys.filter(pa.array(which)).to_pandas(), "outcome": outcome, "at_ms": at[which], "receive_count": received[which].astype(np.int32)})


def message_outcomes(
    events: DataFrame, key: str = "message_id", lateness: str = LATENESS, max_receive: int = MAX_RECEIVE_COUNT, visibility_s: int = VISIBILITY_TIMEOUT_S,
    retention_s: int = MESSAGE_RETENTION_S, buckets: int = BUCKETS,
) -> DataFrame:
    """(key, outcome, at_ms, receive_count) of messages that become a dead letter or expire, from a stream of (key, kind, ts).

    kind is ``sent``, ``received`` or ``deleted``. A message received ``max_receive`` times and not deleted while the last of these receives hid it is a dead letter; one
    neither deleted nor dead at the end of the retention time expires. Each is reported once. Events may come out of order, up to ``lateness`` late.
    Append mode; needs the RocksDB state store. Messages share state by hash: a task holds the open messages of one of ``buckets`` at a time. The key must be
    a type that casts to text and back.
    """
    use_rocksdb(events.sparkSession)
    kind_of_key = events.schema[key].dataType
    schema = T.StructType([
        T.StructField(key, T.StringType()), T.StructField("outcome", T.StringType()), T.StructField("at_ms", T.LongType()), T.StructField("receive_count", T.IntegerType()),
    ])
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("_bucket")
    rows = events.withWatermark("ts", lateness).select(bucket, F.col(key).cast("string").alias(key), "kind", "ts", F.unix_millis("ts").alias("at_ms"))
    watch = MessageWatch(key, max_receive, visibility_s * 1000, retention_s * 1000)
    outcomes = rows.groupBy("_bucket").transformWithStateInPandas(watch, schema, "Append", "EventTime")
    return outcomes.withColumn(key, F.col(key).cast(kind_of_key))


def use_rocksdb(spark) -> None:
    """State stores of queries started from now on: keeps state outside the JVM heap and knows timers."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def stream_metric_statistics(
    metrics: DataFrame,
    period: int,
    stats: Sequence[str] = ("sum", "average", "maximum"),
    lateness: str = LATENESS,
    keys: Sequence[str] = ("metric", "tenant"),
) -> DataFrame:
    """Period statistics that are final once the watermark has passed the period."""
    grouped = (
        metrics.withWatermark("ts", lateness)
        .groupBy(F.window("ts", f"{period} seconds"), *keys)
        .agg(*[STATISTICS[s]("value").alias(s) for s in stats])
    )
    return grouped.select(F.col("window.start").alias("period_start"), *keys, *stats)


def dedupe_stream(attempts: DataFrame, keys: Sequence[str], within: str = "1 hour", time: str = "ts") -> DataFrame:
    """Drops redelivered rows that arrive within the given time of each other."""
    return attempts.withWatermark(time, within).dropDuplicatesWithinWatermark(list(keys))
