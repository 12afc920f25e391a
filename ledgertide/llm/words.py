"""Words of many texts at once: spans and 64-bit hashes with numpy over an Arrow string column.

The functions run inside tasks on record batches that Spark deals out; ``slices`` cuts a batch
so that the arrays stay small whatever a batch holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.ones(256, bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scramble of uint64, another one for each seed."""
    x = x + _U((seed * 0xD1342543DE82EF95 + 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, (n + 1).bit_length())
    if size not in _powers:
        _powers.clear()
        up, down = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        _powers[size] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers[size]


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column holding about ``limit`` bytes each, whole texts always."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4) if len(texts) else [0]
    begin = 0
    while begin < len(texts):
        end = int(np.searchsorted(offsets, offsets[begin] + limit, "right")) - 1
        end = min(len(texts), max(begin + 1, end))
        yield begin, end
        begin = end


@dataclass
class Words:
    """Words of some texts. ``first[i]:first[i+1]`` are those of text i."""

    data: np.ndarray  # the bytes of all texts
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(texts: pa.Array, lower: bool) -> Words:
    """Words (runs of bytes other than ASCII white space) of a string column; null has none.
    With ``lower``, A-Z become a-z first."""
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int32, n + 1, texts.offset * 4).astype(np.int64)
    raw = texts.buffers()[2]
    base, size = int(offsets[0]), int(offsets[-1] - offsets[0])
    data = np.frombuffer(raw, np.uint8, size, base) if raw is not None and size else np.zeros(0, np.uint8)
    offsets = offsets - base
    if lower:
        data = _LOWER[data]
    inside = _IS_WORD[data]
    if texts.null_count:
        for i in np.flatnonzero(texts.is_null().to_numpy(zero_copy_only=False)):
            inside[offsets[i]:offsets[i + 1]] = False
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < size)]
    begin[edges] = inside[edges]
    end[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    up, down = _power_tables(size)
    total = np.zeros(size + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:size], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return Words(data, starts, ends, np.searchsorted(starts, offsets), hashes)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words of the array (runs may cross texts; callers mask those)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    q = 0xD6E8FEB86659FD93
    out, have, power, width, done = None, 0, hashes, 1, 0
    while done < k:  # by doubling: runs of 1, 2, 4 ... words, joined where k has the bit
        if k & width:
            piece = power[done:done + n]
            out = piece.copy() if out is None else out * _U(pow(q, width, 1 << 64)) + piece
            done += width
        if width * 2 <= k:
            power = power[:-width] * _U(pow(q, width, 1 << 64)) + power[width:]
        width *= 2
    return mix(out, k)
