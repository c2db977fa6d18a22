"""SuperMinHash signatures (Ertl 2017) of many sets at once.

Each element walks through its own random permutation of the ``m`` slots.  At
rank j it visits one slot and offers it the value j + r, r random in [0, 1);
a slot keeps its least offer.  A slot filled at rank j can't be changed by a
later rank, so a set stops as soon as all its slots are filled.  The ranks are
walked for all elements of all sets together, which gives the same values as
walking each element alone.  A value is kept as rank * 2**32 + 32 random bits.
"""

from __future__ import annotations

import numpy as np

from .words import mix

_STEP = 0x9E3779B97F4A7C15
_LOW = np.uint64(0xFFFFFFFF)
EMPTY = np.uint64(2**64 - 1)
_ROOM = 1 << 25


def _draw(h: np.ndarray, j: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """At rank j: the random bits of each element, and the place in j..m-1 that it swaps with j."""
    x = mix(h + np.uint64(_STEP * (j + 1) % 2**64))
    return x >> np.uint64(32), (j + (((x & _LOW) * np.uint64(m - j)) >> np.uint64(32))).astype(np.int64)


def signatures(h: np.ndarray, first: np.ndarray, m: int) -> np.ndarray:
    """Signatures of the sets ``h[first[d]:first[d + 1]]`` of distinct hashes, one row each; EMPTY for no element."""
    sets = len(first) - 1
    out = np.full((sets, m), EMPTY, np.uint64)
    flat = out.reshape(-1)
    row = np.repeat(np.arange(sets), np.diff(first))
    r, k0 = _draw(h, 0, m)
    np.minimum.at(flat, row * m + k0, r)
    todo = (out == EMPTY).any(1)[row]
    h, row, k0 = h[todo], row[todo], k0[todo]
    if not len(h) or m == 1:
        return out
    r, k1 = _draw(h, 1, m)
    slot = np.where(k1 == k0, 0, k1)  # rank 0 put 0 where it took k0 from
    np.minimum.at(flat, row * m + slot, r | np.uint64(1 << 32))
    todo = (out == EMPTY).any(1)[row]
    h, row, k0, k1 = h[todo], row[todo], k0[todo], k1[todo]
    cuts = np.flatnonzero(np.diff(row, prepend=-1)) if len(row) else np.zeros(0, np.int64)
    i = 0
    while i < len(cuts):  # some sets at a time, so that the permutations fit
        j = i + 1
        while j < len(cuts) and (cuts[j] - cuts[i]) * m < _ROOM:
            j += 1
        end = cuts[j] if j < len(cuts) else len(h)
        _later(flat, h[cuts[i] : end], row[cuts[i] : end], k0[cuts[i] : end], k1[cuts[i] : end], m)
        i = j
    return out


def _later(flat: np.ndarray, h: np.ndarray, row: np.ndarray, k0: np.ndarray, k1: np.ndarray, m: int) -> None:
    """Ranks from 2 on, with the permutations written out."""
    full = flat.reshape(-1, m)
    perm = np.tile(np.arange(m, dtype=np.int16), (len(h), 1))
    at = np.arange(len(h))
    for j, k in ((0, k0), (1, k1)):
        perm[at, j], perm[at, k] = perm[at, k], perm[at, j].copy()
    for j in range(2, m):
        r, k = _draw(h, j, m)
        slot = perm[at, k]
        perm[at, k] = perm[at, j]
        np.minimum.at(flat, row * m + slot, r | np.uint64(j << 32))
        sets = np.unique(row)
        done = sets[~(full[sets] == EMPTY).any(1)]
        if len(done):
            left = ~np.isin(row, done)
            h, row, perm = h[left], row[left], perm[left]
            at = np.arange(len(h))
            if not len(h):
                return
