"""Words of many texts at once: byte arrays in, word positions and 64-bit hashes out.

A word is a maximal run of bytes other than space, tab, line feed, vertical tab, form feed and carriage
return, so a UTF-8 text splits into the same words as with ``[^\\x20\\x09-\\x0D]+`` on its code points.
Equal words have equal hashes; different words share one with a probability of 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text a numpy step works on at once; a longer text is one step of its own.
STEP_BYTES = 1 << 20
# Arrow's own pool keeps freed memory in workers that live on; the system's gives it back.
pa.set_memory_pool(pa.system_memory_pool())
U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser; every input bit reaches every output bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, for at least n bytes."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, STEP_BYTES + 1024)
        with np.errstate(over="ignore"):
            _powers[:] = [np.cumprod(np.concatenate([[U(1)], np.full(size - 1, b, U)])) for b in (_BASE, _BASE_INVERSE)]
    return _powers


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes data[start:end] for each pair of positions."""
    power, inverse = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, U)
    np.multiply(data.astype(U) + U(1), power[: len(data)], out=total[1:])
    np.cumsum(total, out=total)
    return mix((total[end] - total[start]) * inverse[start] + (end - start).astype(U))


@dataclass
class Words:
    """Words of the texts of one step, in order."""

    data: np.ndarray  # bytes of all texts, a line feed behind each
    text_end: np.ndarray  # position of that line feed, per text
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray  # index of the text, per word
    n_texts: int

    @property
    def per_text(self) -> np.ndarray:
        return np.bincount(self.text, minlength=self.n_texts)

    def hashes(self) -> np.ndarray:
        return range_hashes(self.data, self.start, self.end)

    def joined(self, keep: np.ndarray) -> pa.StringArray:
        """The kept words of each text, joined by one space."""
        edge = np.zeros(len(self.data) + 1, np.int8)
        edge[self.start[keep]] += 1
        edge[self.end[keep] + 1] -= 1
        out = self.data[np.cumsum(edge[:-1], dtype=np.int8).view(bool)]
        out[_SPACE[out]] = 0x20
        sizes = np.bincount(self.text[keep], weights=(self.end - self.start + 1)[keep], minlength=self.n_texts).astype(np.int64)
        ends = np.cumsum(sizes)
        empty = sizes == 0
        # The last space of each text goes: shift what follows by one byte for each text before it.
        drop = np.ones(len(out), bool)
        drop[ends[~empty] - 1] = False
        offsets = np.concatenate([[0], np.cumsum(sizes - ~empty)])
        return strings(out[drop], offsets)


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """UTF-8 bytes and offsets as an Arrow array of texts."""
    kind, width = (pa.string(), np.int32) if offsets[-1] < 2**31 else (pa.large_string(), np.int64)
    return pa.Array.from_buffers(kind, len(offsets) - 1, [None, pa.py_buffer(offsets.astype(width)), pa.py_buffer(np.ascontiguousarray(data))])


def text_bytes(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts (null: empty), a line feed behind each, and the positions of these line feeds."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    empty, feed = pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string())
    plain = pc.binary_join_element_wise(texts.cast(pa.large_string()).fill_null(empty), empty, feed)
    offsets = np.frombuffer(plain.buffers()[1], np.int64)[plain.offset : plain.offset + len(plain) + 1]
    data = np.frombuffer(plain.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets[1:] - offsets[0] - 1


def split_words(texts: pa.Array | pa.ChunkedArray, written: np.ndarray | None = None) -> Words:
    """Words of the texts; ``written`` maps each byte to the byte it counts as."""
    data, text_end = text_bytes(texts)
    if written is not None:
        data = written[data]
    space = np.concatenate([[True], _SPACE[data]])
    change = np.flatnonzero(space[1:] != space[:-1])
    start, end = change[::2], change[1::2]
    text = np.searchsorted(text_end, start)
    return Words(data, text_end, start, end, text, len(text_end))


def steps(table: pa.Table | pa.RecordBatch, column: str, limit: int = STEP_BYTES) -> Iterator[pa.Table]:
    """Runs of rows with at most ``limit`` bytes of text, or one longer text."""
    if isinstance(table, pa.RecordBatch):
        table = pa.Table.from_batches([table])
    ends = np.cumsum(pc.fill_null(pc.binary_length(table[column]), 0).to_numpy().astype(np.int64) + 1)
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield table.slice(at, stop - at)
        at = stop


def gram_hashes(words: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of n consecutive words (len(words) - n + 1 of them, none if there are fewer words)."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, U)
    total = np.full(count, mix(np.array([seed + n], U))[0], U)
    for i in range(n):
        total = total * U(_BASE) + words[i : i + count]
    return mix(total)


def full_grams(text: np.ndarray, n: int) -> np.ndarray:
    """Which runs of n consecutive words lie in one text."""
    if len(text) < n:
        return np.zeros(0, bool)
    return text[: len(text) - n + 1] == text[n - 1 :]


def range_index(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, .., size[0] of them, then the same for the next pair."""
    size = np.asarray(size, np.int64)
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) - np.repeat(ends - size - np.asarray(start, np.int64), size)
