"""Corpus passes by blocks of documents and buckets of hashes.

A pass over the corpus often has to know something global about a hash: is it
shared, how often does it occur.  A row per hash and document is far too many.
Here the documents are dealt into blocks of about equal bytes.  A block
reports each distinct hash once, packed in one binary per bucket of hashes;
the task of a bucket answers every block with a packed array in the order of
its report.  So a hash that occurs in a third of all documents costs one entry
for each block, and neither a bucket nor a block grows with the input: their
numbers do.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 6 << 20


def dealt(docs: DataFrame, blocks: int, keys: list[str]) -> DataFrame:
    """Deal rows into ``blocks`` blocks by a hash of ``keys``; column ``block``.  All passes share this one exchange."""
    return docs.withColumn("block", F.pmod(F.xxhash64(*keys), F.lit(blocks)).cast("int")).repartition(blocks, "block")


def text_of(table: pa.Table, col: str = "text") -> pa.Array:
    column = table.column(col).cast(pa.large_string()).combine_chunks()
    return column.chunk(0) if isinstance(column, pa.ChunkedArray) else column


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each hash; sorted hashes give sorted buckets."""
    return ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def cuts(h: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's part of sorted hashes begins, with the end."""
    return np.searchsorted(bucket_of(h, buckets), np.arange(buckets + 1, dtype=np.uint64))


def answers(table: pa.Table, h: np.ndarray, buckets: int, dtype: type, col: str = "answer") -> np.ndarray:
    """The buckets' answers to a block, in the order of its sorted hashes; dtype bool for packed bits."""
    at = cuts(h, buckets)
    out = np.zeros(len(h), dtype)
    for b, blob in zip(table.column("bucket").to_pylist(), table.column(col).to_pylist()):
        n = at[b + 1] - at[b]
        if dtype is bool:
            out[at[b] : at[b + 1]] = np.unpackbits(np.frombuffer(blob, np.uint8), count=n)
        else:
            out[at[b] : at[b + 1]] = np.frombuffer(blob, dtype)
    return out


SLICED = "slice int, part binary"


def sliced(array: np.ndarray, slices: int) -> pa.RecordBatch:
    """One row for each of ``slices`` equal parts of a flat array."""
    rows = [x.tobytes() for x in array.reshape(slices, -1)]
    return pa.RecordBatch.from_arrays([pa.array(range(slices), pa.int32()), pa.array(rows, pa.binary())], ["slice", "part"])


def summed(rows: DataFrame, slices: int, size: int, dtype: type) -> np.ndarray:
    """The sum of the arrays that tasks have sent in slices; each slice is added up as it arrives, ``size`` values reach the driver."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[s] = total.get(s, 0) + np.frombuffer(blob, dtype)
        parts = [x.tobytes() for x in total.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(parts, pa.binary())], ["slice", "part"])

    out = np.zeros((slices, size // slices), dtype)
    for r in rows.repartition(slices, "slice").mapInArrow(add, SLICED).collect():
        out[r["slice"]] = np.frombuffer(r["part"], dtype)
    return out.reshape(-1)
