"""Filling windows of a fixed size with token ids, cut freely: minimum bin slack on what is left of each document.

A document fills as many whole windows as it can; its remaining length is
below the window's size.  For one window at a time, a bitset subset-sum over
the remaining lengths finds the multiset, the longest length among it, that
comes closest to the capacity, and the counts are backtracked from the bitsets.
Only lengths count, and there are fewer than ``size`` of them at any scale, so
the driver works on a histogram and takes a multiset as often as the counts
allow.  What no multiset fills to the brim is laid end to end and cut at the
windows' ends; the last window, which stays short, is cut into powers of two.
So nothing has to be padded, and at most one document is cut at a window's end.

Documents find their place by their rank among those of their remaining
length: their number in their task, and how many earlier tasks have.
"""

from __future__ import annotations

from array import array
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .staging import staged
from .tokens import END, encoder
from .words import slices

SLICE_BYTES = 8 << 20


def closest(counts: dict[int, int], size: int) -> dict[int, int]:
    """How many of each length fill ``size`` best, one of the longest among them; ``counts[length]`` are at hand."""
    longest = max(counts)
    mask = (2 << size) - 1
    sums, before = 1 << longest, []
    for length in sorted(counts, reverse=True):
        most = min(counts[length] - (length == longest), (size - longest) // length)
        if most <= 0:
            continue
        before.append((length, sums))
        done = 0  # sums of up to `done` pieces of this length are in
        while done < most:
            step = min(done + 1, most - done)
            sums |= sums << step * length & mask
            done += step
        if sums >> size:
            break
    total = sums.bit_length() - 1
    taken = {longest: 1}
    for length, earlier in reversed(before):
        n = 0
        while not earlier >> total & 1:
            total, n = total - length, n + 1
        if n:
            taken[length] = taken.get(length, 0) + n
    return taken


class Plan:
    """Where the pieces of each length go.

    ``filled[length]``: (first rank, pieces in a window, first window, offset)
    of the multisets that fill a window, ascending by rank.  Ranks from
    ``rest[length][0]`` on lie on a line from position ``rest[length][1]``;
    the line is cut into windows from number ``windows``, the last of them
    into powers of two.
    """

    def __init__(self, counts: dict[int, int], size: int):
        left = {n: c for n, c in counts.items() if c > 0}
        self.size, self.windows = size, 0
        self.filled: dict[int, list[tuple[int, int, int, int]]] = {}
        used, spare = dict.fromkeys(left, 0), dict.fromkeys(left, 0)
        while left:
            taken = closest(left, size)
            times = min(left[n] // c for n, c in taken.items())
            if sum(n * c for n, c in taken.items()) == size:
                offset = 0
                for n in sorted(taken, reverse=True):
                    self.filled.setdefault(n, []).append((used[n], taken[n], self.windows, offset))
                    used[n] += taken[n] * times
                    offset += n * taken[n]
                self.windows += times
            else:
                for n, c in taken.items():
                    spare[n] += c * times
            for n, c in taken.items():
                left[n] -= c * times
                if not left[n]:
                    del left[n]
        self.rest, at = {}, 0
        for n in sorted(spare, reverse=True):
            self.rest[n] = (used[n], at)
            at += n * spare[n]
        self.whole = at // size  # windows that the line fills
        short = at % size
        self.ends, end = [], self.whole * size
        for bit in reversed(range(size.bit_length())):
            if short >> bit & 1:
                end += 1 << bit
                self.ends.append(end)

    def window(self, at: int) -> tuple[int, int, int]:
        """The window that holds position ``at`` of the line: its number, start and end."""
        if at < self.whole * self.size:
            w = at // self.size
            return self.windows + w, w * self.size, (w + 1) * self.size
        k = bisect_right(self.ends, at)
        return self.windows + self.whole + k, self.ends[k - 1] if k else self.whole * self.size, self.ends[k]

    def places(self, length: int, rank: int) -> list[tuple[int, int, int]]:
        """(length, window, offset) of the parts of a piece."""
        first, start = self.rest[length]
        if rank < first:
            rows = self.filled[length]
            base, each, window, offset = rows[bisect_right(rows, (rank, size_max, 0, 0)) - 1]
            return [(length, window + (rank - base) // each, offset + (rank - base) % each * length)]
        at = start + (rank - first) * length
        out, end = [], at + length
        while at < end:
            number, begin, stop = self.window(at)
            take = min(end, stop) - at
            out.append((take, number, at - begin))
            at += take
        return out


size_max = 1 << 62


class WordCache:
    """Ids of whole texts by a file with end-of-word mark; words are kept in two generations.

    A full cache so loses the words not seen for longest and never all of them.
    """

    ROOM = 250_000

    def __init__(self, path: str):
        self.one = encoder(path)
        if not self.one.suffix:
            raise ValueError("windows take files with an end-of-word mark; tokens.token_counts reads the others")
        self.merge = self.one.merges._core_bpe.encode_single_piece
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def merged(self, word: str) -> bytes:
        low = word.lower()
        if low.isalpha():
            return array("I", self.merge(low.encode() + END)).tobytes()
        return array("I", [i for p in self.one.pattern.findall(low) for i in self.merge(p.encode() + END)]).tobytes()

    def ids(self, text: str) -> bytes:
        """The ids of a text, each as four little-endian bytes."""
        if not self.one.plain(text):
            return array("I", self.one.library.encode(text, add_special_tokens=False).ids).tobytes()
        words = text.split()
        found = list(map(self.new.get, words))
        missed, i = found.count(None), -1
        for _ in range(missed):
            i = found.index(None, i + 1)
            w = words[i]
            ids = self.new.get(w)
            if ids is None:
                ids = self.old.get(w)
                self.new[w] = ids = self.merged(w) if ids is None else ids
            found[i] = ids
        if len(self.new) > self.ROOM:
            self.old, self.new = self.new, {}
        return b"".join(found)


_caches: dict[str, WordCache] = {}

STORED = "doc_id long, part int, length int, own long, full_before long, doc_tokens long, ids binary"
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _batch(columns: list, schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    names, types = zip(*(x.split() for x in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types)], names)


def _encoded(tokenizer: str, size: int, end_id: int):
    """Ids of each document (two bytes each if all fit), and its number in this task among those of its remaining length."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _caches:
            _caches[tokenizer] = WordCache(tokenizer)
        cache, part = _caches[tokenizer], TaskContext.get().partitionId()
        end = array("I", [end_id]).tobytes()
        seen, full = np.zeros(size, np.int64), 0
        for batch in slices(batches, limit=SLICE_BYTES):
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.frombuffer(cache.ids(text or "") + end, np.uint32)
                windows, rest = divmod(len(ids), size)
                small = ids.astype(np.uint16) if ids.max() < 1 << 16 else ids
                rows.append((doc, part, rest, int(seen[rest]), full, len(ids), small.tobytes()))
                seen[rest] += 1
                full += windows
            yield _batch(list(zip(*rows)), STORED)

    return encode


def fill_windows(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", size: int = 4096, end_id: int = 2
) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset): every piece of every document and its place.

    A document is its token ids and then ``end_id``; ``doc_tokens`` of them,
    each in exactly one piece.  ``ids`` are the piece's ids, four little-endian
    bytes each.  A sequence is gapless from offset 0 and holds ``size`` ids,
    but for at most one of each smaller power of two: no sequence needs
    padding.  Whole windows of a long document have odd numbers, the others
    even ones.

    A null text is empty and gives the one id ``end_id``.  Ids may be null or
    repeat; each row is a document of its own.  Equal lengths fall into place
    by task and order there.  A table without rows gives none.  Other columns
    are ignored.  ``size`` is a power of two.
    """
    if size < 1 or size & (size - 1):
        raise ValueError("size must be a power of two")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    coded = staged(source.mapInArrow(_encoded(tokenizer, size, end_id), STORED), "ids")

    counts = coded.where("length > 0").groupBy("part", "length").agg(F.count("*").alias("n"))
    plan = Plan({r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, size)
    table = docs.sparkSession.sparkContext.broadcast(plan)

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    ranked = coded.join(earlier, ["part", "length"], "left").select(
        "doc_id", "part", "length", (F.col("own") + F.coalesce("before", F.lit(0))).alias("rank"), "full_before", "doc_tokens", "ids"
    )

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = table.value
        for batch in batches:
            rows: list[tuple] = []
            for doc, part, rest, rank, full, n, blob in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.frombuffer(blob, np.uint16 if len(blob) == 2 * n else np.uint32).astype(np.uint32).tobytes()
                for w in range(n // size):
                    number = (part << 40 | full + w) * 2 + 1
                    rows.append((doc, w * size, size, ids[4 * w * size : 4 * (w + 1) * size], n, number, 0))
                start = n - rest
                for length, window, offset in plan.places(rest, rank) if rest else ():
                    rows.append((doc, start, length, ids[4 * start : 4 * (start + length)], n, window * 2, offset))
                    start += length
            if rows:
                yield _batch(list(zip(*rows)), PIECES)

    return ranked.mapInArrow(place, PIECES)
