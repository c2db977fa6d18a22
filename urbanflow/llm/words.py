"""Words of a column of texts as flat numpy arrays, with 64-bit hashes.

Words are runs of bytes other than 0x20 and 0x09-0x0D of the UTF-8 text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_SPAN = 1 << 19
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit (the splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        _powers.clear()
        for b in (_BASE, _INVERSE):
            t = np.full(max(n, _SPAN + 1), b, np.uint64)
            t[0] = 1
            _powers.append(np.cumprod(t, dtype=np.uint64))
    return _powers


class Words:
    """Words of several texts: bytes ``start[i]:end[i]`` of ``data``; text d has words ``first[d]:first[d + 1]``."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        if texts.null_count:
            texts = texts.fill_null("")
        kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        n = len(texts)
        _, offsets, data = texts.buffers()
        at = np.frombuffer(offsets, kind)[texts.offset : texts.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
        raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and n else np.zeros(0, np.uint8)
        self.bounds = at - at[0]
        self.data = LOWER[raw] if lower else raw
        self.start, self.end = self._edges()
        self.first = np.searchsorted(self.start, self.bounds)
        self.doc = np.repeat(np.arange(n), np.diff(self.first))

    def _edges(self) -> tuple[np.ndarray, np.ndarray]:
        size = len(self.data)
        if not size:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        gap = SEPARATOR[self.data]
        opens = np.empty(size, bool)
        opens[0] = True
        opens[1:] = gap[:-1]
        opens[self.bounds[self.bounds < size]] = True
        closes = np.empty(size, bool)
        closes[-1] = True
        closes[:-1] = gap[1:]
        closes[self.bounds[self.bounds > 0] - 1] = True
        word = ~gap
        return np.flatnonzero(word & opens), np.flatnonzero(word & closes) + 1

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, computed over spans of bounded size."""
        out = np.empty(len(self), np.uint64)
        i = 0
        while i < len(self):
            base = self.start[i]
            j = max(i + 1, int(np.searchsorted(self.end, base + _SPAN, "right")))
            span = self.data[base : self.end[j - 1]]
            up, down = _tables(len(span) + 1)
            total = np.zeros(len(span) + 1, np.uint64)
            np.cumsum(_BYTE[span] * up[: len(span)], out=total[1:])
            a, b = self.start[i:j] - base, self.end[i:j] - base
            out[i:j] = (total[b] - total[a]) * down[a] + (b - a).astype(np.uint64)
            i = j
        return mix(out)


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k consecutive word hashes, by the window's first word."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = h[:n] * _PLACE[0]
    for i in range(1, k):
        out += h[i : i + n] * _PLACE[i]
    return mix(out + np.uint64(k))


def inside(words: Words, k: int) -> np.ndarray:
    """Whether the window of k words that starts at each word ends in the same text (only where it can)."""
    n = len(words) - k + 1
    return words.doc[:n] == words.doc[k - 1 :] if n > 0 else np.zeros(0, bool)


def slices(batches: Iterable[pa.RecordBatch], col: str = "text", limit: int = _SPAN) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows whose texts have about ``limit`` bytes; a longer text stands alone."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(col))
        if not len(texts):
            continue
        if texts.null_count:
            texts = texts.fill_null("")
        sizes = pa.compute.binary_length(texts).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        i = 0
        while i < len(ends):
            before = ends[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(i, j - i)
            i = j
