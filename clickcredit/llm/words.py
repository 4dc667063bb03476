"""Vectorised words and word hashes of Arrow text batches.

A word is a run of bytes other than 0x20 and 0x09-0x0D. That rule reads bytes, so
it is safe on UTF-8. Null texts count as empty. All work is on flat numpy arrays;
a batch is cut into slices of whole documents so that temporary arrays stay at a
few MB however large the Arrow batch is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

# Odd 64-bit multipliers of the rolling hashes, and a table that makes single
# bytes look random before they are summed.
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_WORD_BASE = np.uint64(0xD6E8FEB86659FD93)


def mix64(x: np.ndarray) -> np.ndarray:
    """Invertible finaliser that spreads all 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * _BASE)


def _inverse(a: int) -> int:
    return pow(a, -1, 1 << 64)


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept for the next call."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 12), base, dtype=np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if len(have) <= (SLICE_BYTES << 1):
            _POWERS[base] = have
    return have[:n]


def is_space(data: np.ndarray) -> np.ndarray:
    """Which bytes are 0x20 or 0x09-0x0D."""
    return _SPACE[data]


def flat(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array: document i is bytes[offsets[i]:offsets[i+1]]."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)
    offsets = offsets[texts.offset:texts.offset + len(texts) + 1]
    if len(offsets) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(texts: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES
           ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a batch into (first row, end row, bytes, offsets) of at least one document
    and, beyond one document, at most ``limit`` bytes."""
    data, offsets = flat(texts)
    first, n = 0, len(offsets) - 1
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), n)
        part = offsets[first:end + 1]
        yield first, end, data[part[0]:part[-1]], part - part[0]
        first = end


@dataclass
class Words:
    """Words of a slice: byte range of each, its hash, and each document's word range."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray  # document i has words bounds[i]:bounds[i+1]

    def document_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word's bytes."""
        n = len(self.data)
        if not len(self.start):
            return np.zeros(0, np.uint64)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_VALUE[self.data] * powers(int(_BASE), n), out=total[1:])
        out = total[self.end] - total[self.start]
        out *= powers(_inverse(int(_BASE)), n)[self.start]
        out += (self.end - self.start).astype(np.uint64)
        return mix64(out)


def find_words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    """Words of a slice as made by ``slices``; ``lower`` folds A-Z."""
    n = len(data)
    if lower:
        data = np.where((data >= 65) & (data <= 90), data | 32, data)
    solid = np.empty(n + 2, dtype=bool)
    solid[0] = solid[-1] = False
    np.logical_not(_SPACE[data], out=solid[1:-1])
    starts = solid[1:] & ~solid[:-1]
    ends = solid[:-1] & ~solid[1:]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    touching = cuts[solid[cuts + 1] & solid[cuts]]  # no space between two documents
    starts[touching] = True
    ends[touching] = True
    start, end = np.flatnonzero(starts), np.flatnonzero(ends)
    return Words(data, start, end, np.searchsorted(start, offsets))


def runs(hashes: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``width`` consecutive values (len - width + 1 of them)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    if width <= 8:
        base = np.uint64(int(_WORD_BASE) + 2 * seed)
        out = hashes[:n].copy()
        for k in range(1, width):
            out *= base
            out += hashes[k:k + n]
        return mix64(out)
    total = np.zeros(len(hashes) + 1, np.uint64)
    base = int(_WORD_BASE) + 2 * seed
    np.cumsum(hashes * powers(base, len(hashes)), out=total[1:])
    out = total[width:] - total[:-width]
    out *= powers(_inverse(base), n)
    return mix64(out)


def spans(hashes: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of each span hashes[start:end] of any length."""
    total = np.zeros(len(hashes) + 1, np.uint64)
    base = int(_WORD_BASE) + 2 * seed
    np.cumsum(hashes * powers(base, len(hashes)), out=total[1:])
    out = total[end] - total[start]
    if len(out):
        out *= powers(_inverse(base), len(hashes) + 1)[start]
    return mix64(out + (end - start).astype(np.uint64))
