"""Repeated passages: difference-cover anchors find the places, window hashes decide.

A passage is a window of ``length`` consecutive words.  Hashing every window
of the corpus is too much to shuffle.  A difference cover D of a period v
holds, for every difference mod v, two members that differ by it.  So for two
equal windows there is an offset below v at which both documents are at a
position of D, and the ``length - v + 1`` words from there are equal too:
an aligned anchor.  Only anchors at positions of D are reported (3 of 7).
Windows that hold a shared anchor extend it to full length and are the only
ones whose hashes are compared.

All passes are one plan over one exchange of the texts, and nothing is
compared pair by pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .blocks import BLOCK_BYTES, answers, cuts, dealt, text_of
from .staging import parts_for, text_bytes
from .words import Words, windows

COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9)}
BUCKET_BYTES = 12 << 20


class Block:
    """The documents of one block in the order of their ids, with their anchors and windows."""

    def __init__(self, table: pa.Table, length: int, period: int):
        ids = table.column("doc_id").combine_chunks()
        order = pa.compute.sort_indices(ids)
        self.table = table.take(order)
        self.ids = self.table.column("doc_id").fill_null(0).to_numpy()
        self.known = self.table.column("doc_id").is_valid().to_numpy()
        self.words = words = Words(text_of(self.table))
        self.h = words.hashes()
        self.length, self.period = length, period
        size = np.diff(words.first)
        place = np.arange(len(words)) - words.first[words.doc]
        width = length - period + 1
        usable = self.known[words.doc] & (size[words.doc] >= length)
        cover = np.zeros(period, bool)
        cover[list(COVERS[period])] = True
        self.spots = np.flatnonzero(usable & cover[place % period] & (place + width <= size[words.doc]))
        self.starts = usable & (place + length <= size[words.doc])
        self.anchors, self.anchor_of = np.unique(windows(self.h, width)[self.spots], return_inverse=True)

    def repeated(self) -> np.ndarray:
        """Whether each distinct anchor occurs in two documents of this block."""
        least = np.full(len(self.anchors), np.iinfo(np.int64).max)
        most = np.full(len(self.anchors), np.iinfo(np.int64).min)
        own = self.ids[self.words.doc[self.spots]]
        np.minimum.at(least, self.anchor_of, own)
        np.maximum.at(most, self.anchor_of, own)
        return least < most

    def candidates(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Windows around shared anchors: their starts, their distinct hashes, which each start has, and each one's least id."""
        mark = np.zeros(len(self.words) + self.period + 1, np.int64)
        mark[self.spots[shared[self.anchor_of]]] = 1
        total = np.concatenate(([0], np.cumsum(mark)))
        n = len(self.words)
        near = total[self.period : n + self.period] > total[:n]
        at = np.flatnonzero(near & self.starts)
        distinct, which = np.unique(windows(self.h, self.length)[at], return_inverse=True)
        least = np.full(len(distinct), np.iinfo(np.int64).max)
        np.minimum.at(least, which, self.ids[self.words.doc[at]])
        return at, distinct, which, least


def _anchors(length: int, period: int, buckets: int):
    def report(table: pa.Table) -> pa.Table:
        block = Block(table, length, period)
        many, at = block.repeated(), cuts(block.anchors, buckets)
        short = block.anchors.astype(np.uint32)  # with the bucket this tells anchors apart well enough to extend them
        full = np.flatnonzero(np.diff(at))
        return pa.table(
            {
                "bucket": pa.array(full, pa.int32()),
                "block": pa.array([table.column("block")[0].as_py()] * len(full), pa.int32()),
                "hashes": pa.array([short[at[b] : at[b + 1]].tobytes() for b in full], pa.binary()),
                "many": pa.array([np.packbits(many[at[b] : at[b + 1]]).tobytes() for b in full], pa.binary()),
            }
        )

    return report


def _answer(table: pa.Table, sizes: list[int], yes: np.ndarray) -> pa.Table:
    ends = np.cumsum([0, *sizes])
    bits = [np.packbits(yes[ends[i] : ends[i + 1]]).tobytes() for i in range(len(sizes))]
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "answer": pa.array(bits, pa.binary())})


def _shared(table: pa.Table) -> pa.Table:
    parts = [np.frombuffer(x, np.uint32) for x in table.column("hashes").to_pylist()]
    many = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(p)) for x, p in zip(table.column("many").to_pylist(), parts)]
    _, which, count = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    known = np.zeros(len(count), bool)
    known[which[np.concatenate(many) > 0]] = True
    return _answer(table, [len(p) for p in parts], ((count > 1) | known)[which])


def _windows(length: int, period: int, anchor_buckets: int, buckets: int):
    def report(table: pa.Table, told: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({"bucket": pa.array([], pa.int32()), "block": pa.array([], pa.int32()),
                             "hashes": pa.array([], pa.binary()), "ids": pa.array([], pa.binary())})
        block = Block(table, length, period)
        _, distinct, _, least = block.candidates(answers(told, block.anchors, anchor_buckets, bool))
        at = cuts(distinct, buckets)
        full = np.flatnonzero(np.diff(at))
        return pa.table(
            {
                "bucket": pa.array(full, pa.int32()),
                "block": pa.array([table.column("block")[0].as_py()] * len(full), pa.int32()),
                "hashes": pa.array([distinct[at[b] : at[b + 1]].tobytes() for b in full], pa.binary()),
                "ids": pa.array([least[at[b] : at[b + 1]].tobytes() for b in full], pa.binary()),
            }
        )

    return report


def _earliest(table: pa.Table) -> pa.Table:
    parts = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
    ids = np.frombuffer(b"".join(table.column("ids").to_pylist()), np.int64)
    distinct, which = np.unique(np.concatenate(parts), return_inverse=True)
    least = np.full(len(distinct), np.iinfo(np.int64).max)
    np.minimum.at(least, which, ids)
    return _answer(table, [len(p) for p in parts], ids == least[which])


def _removed(length: int, period: int, anchor_buckets: int, buckets: int, names: list[str]):
    def remove(table: pa.Table, told: pa.Table) -> pa.Table:
        block = Block(table, length, period)
        words = block.words
        first_told, then_told = (told.filter(pa.compute.equal(told.column("step"), s)) for s in (1, 2))
        at, distinct, which, least = block.candidates(answers(first_told, block.anchors, anchor_buckets, bool))
        own = answers(then_told, distinct, buckets, bool)
        late = at[(block.ids[words.doc[at]] > least[which]) | ~own[which]]
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, late, 1)
        np.add.at(edge, late + length, -1)
        gone = np.cumsum(edge[:-1]) > 0
        removed = np.bincount(words.doc[gone], minlength=len(block.ids))
        texts = block.table.column("text").to_pylist()
        for d in np.flatnonzero(removed):
            i, j, lo = words.first[d], words.first[d + 1], words.bounds[d]
            follow = np.append(words.start[i + 1 : j], words.bounds[d + 1]) - lo
            begin = words.start[i:j] - lo
            stay = np.zeros(words.bounds[d + 1] - lo + 1, np.int8)
            np.add.at(stay, begin[gone[i:j]], 1)
            np.add.at(stay, follow[gone[i:j]], -1)
            raw = words.data[lo : words.bounds[d + 1]]
            texts[d] = raw[np.cumsum(stay[:-1], dtype=np.int8) == 0].tobytes().decode()
        out = {n: block.table.column(n) for n in names}
        out |= {"n_words": pa.array(np.diff(words.first)), "n_removed": pa.array(removed), "text": pa.array(texts, pa.string())}
        return pa.table(out)

    return remove


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 13, period: int = 7, carry: tuple[str, ...] = ()
) -> DataFrame:
    """(doc_id, carried, n_words, n_removed, text) for every row of ``docs``.

    A word goes if a window of ``length`` words that covers it also starts in a
    document with a smaller id; windows are judged on the input.  ``text`` is
    the text without those words and the white space after each.  ``period``
    is one of COVERS.  Null texts have no words and stay null.  Rows with a
    null id lose nothing and take nothing from others; repeated ids are one
    document in this respect.  Columns named in ``carry`` come back in the
    struct ``carried``; others are ignored.
    """
    if period not in COVERS or period > length:
        raise ValueError(f"period must be one of {sorted(COVERS)} and at most length")
    spark = docs.sparkSession
    size = text_bytes(docs, text_col)
    blocks = parts_for(spark, size, BLOCK_BYTES)
    # an anchor costs 4 bytes and there are 3 for 7 words of about 6 bytes; a window costs 16
    anchor_buckets = window_buckets = parts_for(spark, size * 2 // 5, BUCKET_BYTES)
    carried = F.struct(*[F.col(c) for c in carry]) if carry else F.lit(None).cast("string")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), carried.alias("carried"))
    texts = dealt(source, blocks, ["doc_id"])
    by_block = texts.groupBy("block")

    anchors = by_block.applyInArrow(_anchors(length, period, anchor_buckets), "bucket int, block int, hashes binary, many binary")
    answer = "block int, bucket int, answer binary"
    shared = anchors.groupBy("bucket").applyInArrow(_shared, answer)
    found = by_block.cogroup(shared.groupBy("block")).applyInArrow(
        _windows(length, period, anchor_buckets, window_buckets), "bucket int, block int, hashes binary, ids binary"
    )
    first = found.groupBy("bucket").applyInArrow(_earliest, answer)
    told = shared.withColumn("step", F.lit(1)).union(first.withColumn("step", F.lit(2)))
    kind = StructType([source.schema["doc_id"], source.schema["carried"]])
    kind = kind.add("n_words", "long").add("n_removed", "long").add("text", "string")
    return by_block.cogroup(told.groupBy("block")).applyInArrow(
        _removed(length, period, anchor_buckets, window_buckets, ["doc_id", "carried"]), kind
    )
