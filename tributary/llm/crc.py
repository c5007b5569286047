"""CRC-32 (as zlib has it) of many byte strings at once, and of strings joined from parts with known values."""

from __future__ import annotations

import zlib

import numpy as np

_POLYNOMIAL = 0xEDB88320
#: Bytes of a string that are worked on beside those of all others; what a longer one has beyond them goes through zlib.
_BESIDE = 64


def _byte_table() -> np.ndarray:
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = (value >> np.uint32(1)) ^ (value & np.uint32(1)) * np.uint32(_POLYNOMIAL)
    return value


_TABLE = _byte_table()


def crc32s(data: np.ndarray, start: np.ndarray, end: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """CRC of data[start:end] for each pair of positions; ``before`` is the CRC of what stands in front of each."""
    size = end - start
    order = np.argsort(-size, kind="stable")
    first, left = start[order], size[order]
    state = np.zeros(len(start), np.uint32) if before is None else before[order].astype(np.uint32)
    state ^= np.uint32(0xFFFFFFFF)
    for k in range(min(_BESIDE, int(left[0]) if len(left) else 0)):
        active = int(np.searchsorted(-left, -k))  # those with more than k bytes stand in front
        now = state[:active]
        state[:active] = _TABLE[(now ^ data[first[:active] + k]) & np.uint32(255)] ^ (now >> np.uint32(8))
    state ^= np.uint32(0xFFFFFFFF)
    for i in range(int(np.searchsorted(-left, -_BESIDE))):
        state[i] = zlib.crc32(data[first[i] + _BESIDE : first[i] + left[i]].tobytes(), int(state[i]))
    out = np.empty_like(state)
    out[order] = state
    return out


def _times(matrix: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Each value, a vector of 32 bits, times the matrix (one word for each bit)."""
    out = np.zeros_like(value)
    for bit in range(32):
        out ^= ((value >> np.uint32(bit)) & np.uint32(1)) * matrix[bit]
    return out


def _zero_bytes(power: int) -> np.ndarray:
    """The matrix that appends 2 ** power zero bytes to what a CRC has seen."""
    one_bit = np.concatenate([[np.uint32(_POLYNOMIAL)], np.uint32(1) << np.arange(31, dtype=np.uint32)]).astype(np.uint32)
    matrix = one_bit
    for _ in range(3 + power):
        matrix = _times(matrix, matrix)
    return matrix


_append: list[np.ndarray] = []


def joined(left: np.ndarray, right: np.ndarray, right_size: np.ndarray) -> np.ndarray:
    """CRC of each left string followed by its right one, from their CRCs and the bytes of the right one."""
    shifted, size = left.astype(np.uint32), right_size.astype(np.int64)
    for power in range(int(size.max()).bit_length() if len(size) else 0):
        if power == len(_append):
            _append.append(_zero_bytes(power))
        some = (size >> power) & 1 == 1
        shifted[some] = _times(_append[power], shifted[some])
    return shifted ^ right.astype(np.uint32)
