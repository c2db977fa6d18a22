"""Exact top-k inner products with vector-approximation files.

Vectors are cut into blocks.  A block keeps, beside its exact vectors, the
cell of a uniform grid that each vector lies in.  For a query the cells alone
bound every score from both sides.  A first pass over the cells finds for each
query, over all blocks, a score that its k-th best reaches at least.  The
second reads the exact vectors of those whose upper bound reaches it, in the
order of these bounds, until none of the rest can be among the k best.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .staging import staged

CELLS = 32
LIMIT = 2.0**62
EXACT = 2.0**53
#: Whole numbers below this are exact in 32-bit floats.
EXACT_SHORT = 2.0**24
#: Queries whose bounds are held at a time.
SOME = 256

BLOCK = "dim int, kind string, ids binary, vectors binary, cells binary, least binary, width binary"


def _packed(scale: float, rows: int):
    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list] = {}

        def block(dim: int) -> pa.RecordBatch:
            ids, vectors = zip(*waiting.pop(dim))
            exact = np.stack(vectors)
            most = int(np.abs(exact).max(initial=0))
            kind = next(k for k in ("i1", "i2", "i4", "i8") if most <= np.iinfo(k).max)  # the shortest that holds all
            near = Approximation(exact)
            blobs = [np.array(ids, np.int64), exact.astype(kind), near.cell, near.least, near.width]
            arrays = [pa.array([dim], pa.int32()), pa.array([kind]), *(pa.array([x.tobytes()], pa.binary()) for x in blobs)]
            return pa.RecordBatch.from_arrays(arrays, ["dim", "kind", "ids", "vectors", "cells", "least", "width"])

        for batch in batches:
            for i, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                if i is None or not x.is_valid or x.values.null_count:
                    continue
                v = x.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if not np.isfinite(v).all():
                    continue
                v = np.clip(np.floor(v * scale), -LIMIT, LIMIT).astype(np.int64)
                own = waiting.setdefault(len(v), [])
                own.append((i, v))
                if len(own) == rows:
                    yield block(len(v))
        for dim in list(waiting):
            yield block(dim)

    return pack


class Approximation:
    """The cells of a block: 32 to a dimension, equally wide."""

    def __init__(self, exact: np.ndarray):
        least = exact.min(0)
        width = (exact.max(0) - least) // CELLS + 1
        self.cell = ((exact - least) // width).astype(np.uint8)
        self.least, self.width = least.astype(np.float64), width.astype(np.float64)

    @classmethod
    def stored(cls, cells: bytes, least: bytes, width: bytes, rows: int) -> Approximation:
        self = cls.__new__(cls)
        self.least, self.width = np.frombuffer(least), np.frombuffer(width)
        self.cell = np.frombuffer(cells, np.uint8).reshape(rows, len(self.least))
        return self

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Score of each query with each cell's lower corner, and what to add at most and at least."""
        steps = queries * self.width
        short = float(np.abs(steps).sum(1).max(initial=0)) * CELLS < EXACT_SHORT
        kind = np.float32 if short else np.float64
        corner = (steps.astype(kind) @ self.cell.astype(kind).T).astype(np.float64) + (queries @ self.least)[:, None]
        room = self.width - 1
        return corner, np.maximum(queries, 0) @ room, np.minimum(queries, 0) @ room


def _large(queries: np.ndarray, exact_most: float, dim: int) -> bool:
    """Whether scores may be beyond whole floats."""
    return float(np.abs(queries).max(initial=0)) * exact_most * max(1, dim) >= EXACT


def reached(queries: np.ndarray, own: np.ndarray, near: Approximation, ids: np.ndarray, k: int) -> np.ndarray:
    """For each query a score that k others of the block reach at least, from the cells alone; -inf where there aren't k."""
    out = np.full(len(queries), -np.inf)
    most = float((np.abs(near.least) + near.width * CELLS).max(initial=0))
    if _large(queries, most, len(near.least)):
        return out
    for at in range(0, len(queries), SOME):
        corner, _, less = near.bounds(queries[at : at + SOME].astype(np.float64))
        for i in range(len(corner)):
            others = corner[i][ids != own[at + i]]
            if len(others) >= k:
                out[at + i] = np.partition(others, len(others) - k)[len(others) - k] + less[i]
    return out


def search(
    queries: np.ndarray, own: np.ndarray, exact: np.ndarray, ids: np.ndarray, k: int,
    step: int = 64, near: Approximation | None = None, sure: np.ndarray | None = None,
):
    """For each query the k best (scores, ids) of a block but those with its own id; ties go to the smaller id.

    ``sure``: scores that the k-th best of all blocks reaches; what lies below is left out.
    """
    if _large(queries, float(np.abs(exact).max(initial=0)), exact.shape[1]):  # plain whole numbers
        for q, me in zip(queries, own):
            scores = np.clip(exact.astype(object) @ q.astype(object), -(2**63), 2**63 - 1).astype(np.int64)
            at = np.flatnonzero(ids != me)
            yield _pick(scores[at], ids[at], k)
        return
    near = near or Approximation(exact)
    for first in range(0, len(queries), SOME):
        some = queries[first : first + SOME].astype(np.float64)
        corner, more, less = near.bounds(some)
        for i, me in enumerate(own[first : first + SOME]):
            low = corner[i]
            others = np.flatnonzero(ids != me)
            if len(others) > k:
                bound = np.partition(low[others], len(others) - k)[len(others) - k] + less[i]
                others = others[low[others] + more[i] >= bound]
            if sure is not None:
                others = others[low[others] + more[i] >= sure[first + i]]
            others = others[np.argsort(-low[others], kind="stable")]
            scores, at, least = np.zeros(0), 0, -math.inf
            while at < len(others) and low[others[at]] + more[i] >= least:
                read = others[at : at + step]
                scores = np.concatenate((scores, exact[read].astype(np.float64) @ some[i]))
                at += len(read)
                if at >= k:
                    least = np.partition(scores, at - k)[at - k]
            found = ids[others[:at]]
            if sure is not None:
                found, scores = found[scores >= sure[first + i]], scores[scores >= sure[first + i]]
            yield _pick(scores.astype(np.int64), found, k)


def _pick(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    best = np.lexsort((ids, ~scores))[:k]
    return scores[best], ids[best]


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """One pair of blocks at a time, with its queries as a matrix."""
    for batch in batches:
        for r in range(batch.num_rows):
            row = {name: batch.column(name)[r].as_py() for name in batch.schema.names}
            for name in ("own", "ids"):
                row[name] = np.frombuffer(row[name], np.int64)
            row["asked"] = _matrix(row["asked"], row["asked_kind"], row["own"], row["dim"])
            row["near"] = Approximation.stored(row["cells"], row["least"], row["width"], len(row["ids"]))
            yield row


def _reached(k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            out = reached(row["asked"], row["own"], row["near"], row["ids"], k)
            yield pa.RecordBatch.from_arrays([pa.array([row["query_part"]], pa.int64()), pa.array([out.tobytes()], pa.binary())], ["query_part", "sure"])

    return run


def _most(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The largest of the scores that blocks have found, for each query of a part."""
    best: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = np.frombuffer(blob)
            best[part] = np.maximum(best[part], own) if part in best else own
    arrays = [pa.array(list(best), pa.int64()), pa.array([x.tobytes() for x in best.values()], pa.binary())]
    yield pa.RecordBatch.from_arrays(arrays, ["query_part", "sure"])


def _searched(k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            own, ids, sure = row["own"], row["ids"], np.frombuffer(row["sure"])
            exact = _matrix(row["vectors"], row["kind"], ids, row["dim"])
            found = list(search(row["asked"], own, exact, ids, k, near=row["near"], sure=sure))
            sizes = [len(s) for s, _ in found]
            arrays = [np.repeat(own, sizes), np.concatenate([i for _, i in found]), np.concatenate([s for s, _ in found])]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in arrays], ["query_id", "vec_id", "score"])

    return run


def _matrix(blob: bytes, kind: str, ids: np.ndarray, dim: int) -> np.ndarray:
    return np.frombuffer(blob, kind).astype(np.int64).reshape(len(ids), dim)


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    scale: float = 64.0,
    block: int = 4096,
    query_block: int = 4096,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of each query with ``vectors``, its own id left out.

    Components are floor(scale * x); a score is a whole number.  Ties go to the
    smaller id, and a query with fewer than k candidates gets all.  Vectors
    that are null or hold a null or non-finite component, and rows with a null
    id, take no part.  Only vectors of equal length meet; empty vectors score
    0.  Components are cut at +-2**62 and scores at the range of long.  Rows
    that repeat an id and vector count as they stand among the candidates; a
    repeated query id answers once, for the least of its usable vectors.  Other
    columns are ignored.
    """
    spark = vectors.sparkSession

    def blocks(df: DataFrame, rows: int, name: str) -> tuple[DataFrame, int]:
        df = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"))
        parts = max(1, math.ceil(df.count() / rows))
        packed = df.repartition(parts).mapInArrow(_packed(scale, rows), BLOCK)
        return staged(packed.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("number")), name), parts

    stored, parts = blocks(vectors, block, "vectors")
    known = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    usable = queries.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & known)
    asked, _ = blocks(usable.groupBy(id_col).agg(F.min(vec_col).alias(vec_col)), query_block, "queries")
    asked = asked.select(
        "dim", F.col("number").alias("query_part"), F.col("ids").alias("own"), F.col("vectors").alias("asked"), F.col("kind").alias("asked_kind")
    )

    # the stated queries meet every block: one row for each pair of blocks, dealt by block and length alone
    tasks = max(2 * parts, 2 * spark.sparkContext.defaultParallelism)
    spot = F.xxhash64("part", "dim").alias("spot")

    def pairs(asked: DataFrame, *columns: str) -> DataFrame:
        each = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).select("*", spot)
        own = stored.select("part", F.col("dim").alias("own_dim"), "ids", "cells", "least", "width", *columns, spot)
        met = each.drop("part").repartition(tasks, "spot").join(own.drop("part").repartition(tasks, "spot").hint("merge"), "spot")
        return met.where("own_dim <= dim and own_dim >= dim").drop("spot", "own_dim")  # equal hashes of other lengths

    sure = pairs(asked).mapInArrow(_reached(k), "query_part long, sure binary")
    sure = staged(sure.repartition("query_part").mapInArrow(_most, "query_part long, sure binary"), "reached")
    found = pairs(asked.join(sure, "query_part"), "vectors", "kind").mapInArrow(_searched(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
