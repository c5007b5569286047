"""Greedy packing of ordered events into batches limited by count and bytes.

A batch is closed before an event that would break a limit; an event larger than the limit travels
alone. Every boundary depends on all earlier ones, so no window frame can say it. The work is still
spread over chunks of a key:

1. Each chunk answers "if a batch starts at my row j, how does the batch that is still open at my end
   look?" for the first rows. A batch that is open when the chunk begins must close within
   ``max_events`` rows, so that many answers cover every case.
2. A walk over the chunk answers of a key (one short row per chunk) fixes the state each chunk starts in.
3. Each chunk assigns batch numbers from its starting state.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.constants import MAX_BATCH_BYTES, MAX_BATCH_EVENTS
from tributary.functions.rules import event_size
from tributary.operators.ordering import CHUNK, range_chunks, row_rank, same_keys
from tributary.session import ship_with_tasks

ship_with_tasks(__name__)

SIZE = "_size"
# State of the batch that is open when a chunk begins, and what was already numbered.
STATE = ("_open_events", "_open_bytes", "_batches", "_rows")


def _last_row(batch: pa.RecordBatch, keys: Sequence[str]) -> list:
    return [batch.column(k)[batch.num_rows - 1].as_py() for k in keys]


def _first_row(batch: pa.RecordBatch, keys: Sequence[str]) -> list:
    return [batch.column(k)[0].as_py() for k in keys]


def _key_starts(batch: pa.RecordBatch, keys: Sequence[str], previous: list | None) -> np.ndarray:
    """True where a row's key differs from the row before it."""
    n = batch.num_rows
    starts = np.zeros(n, dtype=bool)
    starts[0] = previous is None or _first_row(batch, keys) != previous
    for k in keys if n > 1 else ():
        now, before = batch.column(k).slice(1), batch.column(k).slice(0, n - 1)
        differs = pc.fill_null(pc.not_equal(now, before), False)
        null_flip = pc.not_equal(pc.is_null(now), pc.is_null(before))
        starts[1:] |= pc.or_(differs, null_flip).to_numpy(zero_copy_only=False)
    return starts


def _next_starts(prefix: np.ndarray, max_events: int, max_bytes: int) -> np.ndarray:
    """For every row the start of the batch after the one starting there (m = none in this run)."""
    m = len(prefix) - 1
    rows = np.arange(m)
    by_bytes = np.searchsorted(prefix, prefix[:-1] + max_bytes, side="right") - 1
    return np.minimum(np.maximum(np.minimum(by_bytes, rows + max_events), rows + 1), m)


def _summary(sizes: np.ndarray, max_events: int, max_bytes: int) -> dict:
    """Answers of one run of a key inside a chunk, for every possible first boundary."""
    m = len(sizes)
    prefix = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    following = _next_starts(prefix, max_events, max_bytes)
    at = np.arange(min(m, max_events))
    batches = np.ones(len(at), dtype=np.int64)
    while True:
        ahead = following[at]
        moving = ahead < m
        if not moving.any():
            break
        at = np.where(moving, ahead, at)
        batches += moving
    return {
        "rows": m,
        "sizes": sizes[: len(at)].tolist(),
        "exit_events": (m - at).tolist(),
        "exit_bytes": (prefix[m] - prefix[at]).tolist(),
        "exit_batches": batches.tolist(),
    }


def _enter(state: tuple, row: dict, max_events: int, max_bytes: int) -> tuple:
    """State behind a run, given the state in front of it."""
    events, size, batches, rows = state
    rows += row["rows"]
    sizes = np.asarray(row["sizes"], dtype=np.int64)
    if events == 0:
        first = 0
    else:
        grown = size + np.cumsum(sizes)
        breaks = (grown > max_bytes) | (events + np.arange(1, len(sizes) + 1) > max_events)
        if not breaks.any():
            return events + len(sizes), int(grown[-1]), batches, rows
        first = int(np.argmax(breaks))
    return row["exit_events"][first], row["exit_bytes"][first], batches + row["exit_batches"][first], rows


def _summarise(keys: Sequence[str], max_events: int, max_bytes: int):
    """Per chunk: the answers of its first and of its last key; keys in between never leave a chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        previous, chunk, first_done = None, None, False
        run_keys: list = []
        pieces: list[np.ndarray] = []
        out: list[dict] = []

        def close(is_last: bool) -> None:
            nonlocal first_done
            if pieces and (is_last or not first_done):
                row = _summary(np.concatenate(pieces), max_events, max_bytes)
                out.append({CHUNK: chunk, **dict(zip(keys, run_keys)), **row})
                first_done = True

        for batch in batches:
            if batch.num_rows == 0:
                continue
            if chunk is None:
                chunk = batch.column(CHUNK)[0].as_py()
            starts = np.flatnonzero(_key_starts(batch, keys, previous))
            sizes = batch.column(SIZE).to_numpy(zero_copy_only=False)
            head = sizes[: starts[0]] if len(starts) else sizes
            if len(head):
                pieces.append(head)
            if len(starts):
                # The run that ended, then (if it is the chunk's first) the first full run inside.
                close(False)
                if not first_done and len(starts) > 1:
                    pieces = [sizes[starts[0] : starts[1]]]
                    run_keys = [batch.column(k)[int(starts[0])].as_py() for k in keys]
                    close(False)
                pieces = [sizes[starts[-1] :]]
                run_keys = _last_row(batch, keys)
            previous = _last_row(batch, keys)
        close(True)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow_schema["value"])

    arrow_schema: dict = {}
    return run, arrow_schema


def _walk(keys: Sequence[str], max_events: int, max_bytes: int, schema: pa.Schema):
    """Chunk answers sorted by key and chunk -> the state in front of each chunk that continues a key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        previous, state = None, (0, 0, 0, 0)
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                key = [row[k] for k in keys]
                if key != previous:
                    previous, state = key, (0, 0, 0, 0)
                if state[3]:
                    out.append({CHUNK: row[CHUNK], **dict(zip(keys, key)), **dict(zip(STATE, state))})
                state = _enter(state, row, max_events, max_bytes)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _assign(keys: Sequence[str], max_events: int, max_bytes: int, kept: Sequence[str], schema: pa.Schema):
    """Number the events and batches of a sorted chunk; a key starts from its carried state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        previous = None
        events = size = numbered = seen = 0
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            starts = np.flatnonzero(_key_starts(batch, keys, previous))
            prefix = np.concatenate(([0], np.cumsum(batch.column(SIZE).to_numpy(zero_copy_only=False), dtype=np.int64)))
            carried = [batch.column(c) for c in STATE]
            batch_ids, ranks = np.empty(n, np.int64), np.empty(n, np.int64)
            begins = starts.tolist() if len(starts) and starts[0] == 0 else [0, *starts.tolist()]
            fresh = set(starts.tolist())
            for at, end in zip(begins, [*begins[1:], n]):
                if at in fresh:
                    events, size, numbered, seen = (c[at].as_py() for c in carried)
                ranks[at:end] = seen + np.arange(1, end - at + 1)
                seen += end - at
                # One step for each batch: how far the open one reaches, by count and by bytes.
                while at < end:
                    left = max_bytes - size if events else max_bytes
                    by_bytes = int(np.searchsorted(prefix, prefix[at] + left, side="right")) - 1
                    stop = min(end, at + max_events - events, by_bytes)
                    if not events:
                        numbered += 1
                        stop = max(stop, at + 1)  # an event above the limit travels alone
                    if stop > at:
                        batch_ids[at:stop] = numbered - 1
                        events, size = events + stop - at, (size if events else 0) + int(prefix[stop] - prefix[at])
                        at = stop
                    if at < end:
                        events = size = 0
            previous = _last_row(batch, keys)
            columns = [batch.column(c) for c in kept]
            columns += [pa.array(ranks, pa.int64()), pa.array(batch_ids, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(
                [pa.field(c, a.type) for c, a in zip([*kept, *schema], columns)]
            ))

    return run


def pack_batches(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    message: str = "message",
    size: Column | None = None,
    max_events: int = MAX_BATCH_EVENTS,
    max_bytes: int = MAX_BATCH_BYTES,
    chunks: int | None = None,
    costly: bool = False,
) -> DataFrame:
    """Adds ``seq`` (1-based position) and ``batch_id`` (0-based) per key."""
    measured = df.withColumn(SIZE, (event_size(F.col(message)) if size is None else size).cast("bigint"))
    pinned = range_chunks(measured, keys, order, chunks, costly)

    key_fields = [df.schema[k] for k in keys]
    long_list = T.ArrayType(T.LongType())
    answers_schema = T.StructType(
        [T.StructField(CHUNK, T.IntegerType()), *key_fields, T.StructField("rows", T.LongType())]
        + [T.StructField(c, long_list) for c in ("sizes", "exit_events", "exit_bytes", "exit_batches")]
    )
    state_schema = T.StructType(
        [T.StructField(CHUNK, T.IntegerType()), *key_fields, *[T.StructField(c, T.LongType()) for c in STATE]]
    )
    summarise, slot = _summarise(keys, max_events, max_bytes)
    slot["value"] = _arrow(answers_schema)
    answers = pinned.select(CHUNK, *keys, SIZE).mapInArrow(summarise, answers_schema)
    carry = (
        answers.repartition(*keys)
        .sortWithinPartitions(*keys, CHUNK)
        .mapInArrow(_walk(keys, max_events, max_bytes, _arrow(state_schema)), state_schema)
    )
    # At most one carry row per chunk: only the chunk's first key has a predecessor.
    joined = pinned.join(F.broadcast(carry), same_keys(pinned, carry, keys), "left").select(
        *[pinned[c] for c in measured.columns], *[F.coalesce(carry[c], F.lit(0)).alias(c) for c in STATE]
    )
    result = T.StructType(
        [*df.schema.fields, T.StructField("seq", T.LongType()), T.StructField("batch_id", T.LongType())]
    )
    return joined.mapInArrow(_assign(keys, max_events, max_bytes, df.columns, ["seq", "batch_id"]), result)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def pack_by_count(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, chunks: int | None = None, costly: bool = False
) -> DataFrame:
    """Batches of n events; the position alone decides, so this stays in the JVM."""
    ranked = row_rank(df, keys, order, "seq", chunks, costly)
    return ranked.withColumn("batch_id", F.floor((F.col("seq") - 1) / n).cast("bigint"))


def batch_size_stats(packed: DataFrame, keys: Sequence[str], message: str = "message") -> DataFrame:
    """Events, bytes and overhead of every batch."""
    sized = F.octet_length(F.col(message)).cast("bigint")
    grouped = packed.groupBy(*keys, "batch_id").agg(
        F.count("*").alias("events"),
        F.sum(event_size(F.col(message))).alias("total_bytes"),
        F.sum(sized).alias("message_bytes"),
    )
    overhead = F.col("total_bytes") - F.col("message_bytes")
    return grouped.withColumn("overhead_bytes", overhead).withColumn(
        "overhead_pct", F.round(overhead * 100 / F.col("total_bytes"), 1)
    )
