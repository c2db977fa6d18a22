"""Packing documents into sequences: minimum bin slack.

A bin is filled at a time: a bitset subset-sum over the lengths that are left
finds the combination that fills it best, and the combination is taken out.
Only lengths count, and there are at most ``size`` of them however many
documents there are.  So the driver packs a histogram: a combination is taken
as often as the counts allow, and the plan has a few thousand combinations at
any scale.  Pieces find their place in the plan by their rank among those of
their length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .staging import staged
from .tokens import _strings, encoder


def fullest(counts: dict[int, int], size: int) -> dict[int, int]:
    """A combination of the lengths at hand, the longest among them, with the largest sum up to ``size``."""
    lengths = sorted(counts, reverse=True)
    seed = lengths[0]
    reach, steps, mask = 1 << seed, [], (1 << (size + 1)) - 1
    for length in lengths:
        left, copies = min(counts[length] - (length == seed), (size - seed) // length), 1
        while left > 0:
            take = min(copies, left)
            further = (reach | reach << (length * take)) & mask
            if further != reach:
                steps.append((length, take, reach))
                reach = further
            left, copies = left - take, copies * 2
        if reach >> size & 1:
            break
    total = reach.bit_length() - 1
    used = {seed: 1}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + take
            total -= length * take
    return used


def minimum_slack(counts: dict[int, int], size: int) -> list[tuple[dict[int, int], int]]:
    """Combinations and how often each is used, for ``counts[length]`` pieces of each length up to ``size``."""
    left = {n: c for n, c in counts.items() if c}
    plan = []
    while left:
        used = fullest(left, size)
        times = min(left[n] // c for n, c in used.items())
        plan.append((used, times))
        for n, c in used.items():
            left[n] -= c * times
            if not left[n]:
                del left[n]
    return plan


def places(plan: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """For each length, rows (first rank, pieces in a bin, first bin, offset in the bin), by rank."""
    out: dict[int, list] = {}
    ranks: dict[int, int] = {}
    base = 0
    for used, times in plan:
        offset = 0
        for n in sorted(used, reverse=True):
            out.setdefault(n, []).append((ranks.get(n, 0), used[n], base, offset))
            ranks[n] = ranks.get(n, 0) + used[n] * times
            offset += n * used[n]
        base += times
    return {n: np.array(rows, np.int64) for n, rows in out.items()}


def _pieces(tokenizer: str, size: int, end_id: int):
    end = np.uint32(end_id).tobytes()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for r, text in enumerate(_strings(batch.column(1))):
                ids = enc.ids(text) + end
                for p, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at : at + 4 * size]
                    row.append(r), piece.append(p), start.append(at // 4)
                    length.append(len(part) // 4), crc.append(zlib.crc32(part))
            arrays = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32())]
            arrays += [pa.array(x, pa.int64()) for x in (start, length, crc)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32"])

    return cut


def pack(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", size: int = 4096, end_id: int = 1
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): every piece of every document and its place.

    A document is its token ids and then ``end_id``; one longer than ``size``
    is cut into pieces of ``size``, the last may be shorter.  A sequence holds
    at most ``size`` ids, without gaps from offset 0.  A null text is empty and
    gives the one id ``end_id``.  Ids may be null or repeat; each row is a
    document of its own.  Other columns are ignored.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long"
    pieces = source.mapInArrow(_pieces(tokenizer, size, end_id), kinds)
    pieces = staged(pieces.withColumn("part", F.spark_partition_id()), "pieces")

    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    plan = minimum_slack({r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, size)
    table = docs.sparkSession.sparkContext.broadcast(places(plan))

    # the rank of a piece among those of its length: what earlier parts have, and its place in its own part
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    own = Window.partitionBy("part", "length").orderBy("doc_id", "piece", "ids_crc32")
    ranked = pieces.withColumn("own", F.row_number().over(own) - 1).join(earlier, ["part", "length"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("own")).alias("rank"))

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows_of = table.value
        firsts = {n: rows[:, 0].tolist() for n, rows in rows_of.items()}
        for batch in batches:
            bins, offsets = [], []
            for n, rank in zip(batch.column(3).to_pylist(), batch.column(5).to_pylist()):
                first, each, base, offset = rows_of[n][bisect_right(firsts[n], rank) - 1].tolist()
                bins.append(base + (rank - first) // each)
                offsets.append(offset + (rank - first) % each * n)
            arrays = [*batch.columns[:5], pa.array(bins, pa.int64()), pa.array(offsets, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(place, f"{kinds}, sequence_id long, offset long")
