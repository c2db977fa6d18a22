"""The trie of all conversations' prefixes, by van Emde Boas' recursion on depth.

Sequences of turns are cut at half their depth, again and again, down to
segments of ``HEIGHT`` turns.  Going down, every cut prefix gets a name made of
the name it hangs below and the digest of the upper half, and the upper trie
and the lower forests below it are worked on side by side: a level of the
recursion is one join for all of them.  Conversations with equal turns up to a
depth have equal names there, so a node of the trie is a name.  Going back up,
the totals of the lower parts are grafted on the upper ones.

A node belongs to its smallest member.  A conversation owns the lower end of
its path, so a subtree's total is what its owner's path holds from there on,
and everything that the other members own.  No step gathers the turns of a
conversation, the members of a node or the children of a node in one task: a
conversation with a third of all turns is a third of the segments.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import parts_for, staged

#: Turns of a segment, at which the recursion ends.
HEIGHT = 32
PART_BYTES = 16 << 20
CHUNK = 1 << 16
ROOT = "root"


def digest(*parts: Column) -> Column:
    """32 hexadecimal letters of a SHA-256."""
    return F.substring(F.sha2(F.concat(*parts).cast("binary"), 256), 1, 32)


def _ranked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number of each row among its conversation's rows in this task; conversations stand together."""
    part, last, held = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        conv = batch.column(0).to_numpy()
        if not len(conv):
            continue
        first = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
        runs = np.diff(np.append(first, len(conv)))
        own = np.arange(len(conv)) - np.repeat(first, runs) + 1
        if conv[0] == last:
            own[: runs[0]] += held
        last, held = conv[-1], int(own[-1])
        arrays = [pa.array(np.full(len(conv), part, np.int32)), *batch.columns, pa.array(own)]
        yield pa.RecordBatch.from_arrays(arrays, ["part", "conv", "x", "size", "own"])


def numbered(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, pos, x, size): every turn by its place from 1 on, a digest of role and text, the text's bytes.

    Turns are in the order of ``turn_col``, null first, equal ones in the order
    of their digests.  Null roles and texts are empty.  Rows without an id are
    no conversation and left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv"),
        F.col(turn_col).alias("turn"),
        digest(F.octet_length(role).cast("string"), F.lit(":"), role, text).alias("x"),
        F.octet_length(text).cast("long").alias("size"),
    )
    rows = rows.withColumn("row", F.monotonically_increasing_id())  # deals equal rows
    parts = parts_for(turns.sparkSession, rows.count() * 64, PART_BYTES)
    order = ["conv", F.col("turn").asc_nulls_first(), "x", "row"]
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("conv", "x", "size")
    rows = staged(rows.mapInArrow(_ranked, "part int, conv long, x string, size long, own long"), "turns")

    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = rows.groupBy("conv", "part").agg(F.count("*").alias("n")).withColumn("before", F.sum("n").over(before))
    # at most one conversation goes on into a part, so these are no more rows than parts
    earlier = earlier.where("before is not null").drop("n")
    placed = rows.join(earlier, ["conv", "part"], "left")
    return placed.select("conv", (F.col("own") + F.coalesce("before", F.lit(0))).alias("pos"), "x", "size")


def swept(parts: DataFrame, start: Column, merge: Callable, hand_down: Callable, name: str) -> DataFrame:
    """(conv, b, carry) for the parts (conv, b, v) of sequences: what the recursion hands to each part.

    Going up, an upper and a lower part become one of twice the height, of
    value ``merge(upper, lower)``; going down, ``hand_down(carry, upper, lower)``
    gives what the upper and the lower one get.  Either half may be missing.
    """
    top = parts.agg(F.max("b")).first()[0] or 0
    levels, half = [], F.expr("b div 2")
    while top:
        sides = [F.max(F.when(F.col("b") % 2 == i, F.col("v"))).alias(side) for i, side in enumerate(("upper", "lower"))]
        pairs = staged(parts.groupBy("conv", half.alias("b")).agg(*sides), name)
        levels.append(pairs)
        parts = pairs.select("conv", "b", merge(F.col("upper"), F.col("lower")).alias("v"))
        top //= 2
    carried = parts.select("conv", "b", start.alias("carry"))
    for pairs in reversed(levels):
        to_upper, to_lower = hand_down(F.col("carry"), F.col("upper"), F.col("lower"))
        up = F.when(F.col("upper").isNotNull(), F.struct((F.col("b") * 2).alias("b"), to_upper.alias("carry")))
        down = F.when(F.col("lower").isNotNull(), F.struct((F.col("b") * 2 + 1).alias("b"), to_lower.alias("carry")))
        both = pairs.join(carried, ["conv", "b"]).select("conv", F.explode(F.array_compact(F.array(up, down))).alias("s"))
        carried = both.select("conv", "s.b", "s.carry")
    return carried


def paths(sequences: DataFrame, convs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """(conv, pos, name, parent, size, n) for every prefix of every conversation, the empty one included.

    ``sequences``: (conv, pos, x, size, n), a row for each turn; ``convs``:
    (conv, n), a row for each conversation, also for those without turns.
    """
    block = F.expr(f"(pos - 1) div {height}")
    inside = Window.partitionBy("conv", "b").orderBy("pos")
    local = sequences.withColumn("b", block)
    local = local.withColumn("part", digest(F.array_join(F.collect_list("x").over(inside), "")))
    local = staged(local.withColumn("above", F.lag("part").over(inside)).drop("x"), "segments")

    joined = lambda a, b: digest(a, b)
    ends = local.where(f"n > {height} and (pos = n or pos % {height} = 0)").select("conv", "b", F.col("part").alias("v"))
    named = swept(
        ends, F.lit(ROOT), lambda u, w: F.when(w.isNull(), u).otherwise(joined(u, w)), lambda c, u, w: (c, joined(c, u)), "cuts"
    )
    named = staged(named, "names")
    # the cut prefix as a node: the last turn of the segment above
    node = named.join(ends, ["conv", "b"]).select("conv", (F.col("b") + 1).alias("b"), joined(F.col("carry"), F.col("v")).alias("cut"))
    segments = named.join(node, ["conv", "b"], "left")
    short = local.where(f"n <= {height}").withColumns({"carry": F.lit(ROOT), "cut": F.lit(None).cast("string")})
    rows = short.unionByName(local.where(f"n > {height}").join(segments, ["conv", "b"]))
    below = F.when(F.col("above").isNotNull(), joined(F.col("carry"), F.col("above"))).otherwise(F.coalesce("cut", F.lit(ROOT)))
    rows = rows.select("conv", "pos", joined(F.col("carry"), F.col("part")).alias("name"), below.alias("parent"), "size", "n")
    none = F.lit(None).cast("string")
    roots = convs.select("conv", F.lit(0).cast("long").alias("pos"), F.lit(ROOT).alias("name"), none.alias("parent"), F.lit(0).cast("long").alias("size"), "n")
    return rows.unionByName(roots)


def _chunks(limit: int):
    """Runs of ids of one node as text, cut at ``limit`` letters."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("name", pa.string()), ("first", pa.int64()), ("ids", pa.string())])
        name, first, ids, size = None, None, [], 0
        for batch in batches:
            out = []
            for node, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if node != name or size > limit:
                    if ids:
                        out.append((name, first, ",".join(ids)))
                    name, first, ids, size = node, conv, [], 0
                ids.append(str(conv))
                size += len(ids[-1])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip((name, first, ",".join(ids)), schema.types)], schema=schema)

    return cut


def _hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's chunks, fed one after the other."""
    name, sha = None, None
    for batch in batches:
        out = []
        for node, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if node != name:
                if sha:
                    out.append((name, sha.hexdigest()))
                name, sha = node, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], ["name", "ends_sha256"])
    if sha:
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([sha.hexdigest()])], ["name", "ends_sha256"])


def ends_digests(ends: DataFrame) -> DataFrame:
    """(name, ends_sha256) of rows (name, conv): ids ascending, joined by commas; texts of ids, not ids, meet in a task."""
    spark = ends.sparkSession
    parts = parts_for(spark, ends.count() * 64, PART_BYTES)
    rows = ends.select("name", "conv").repartitionByRange(parts, "name", "conv").sortWithinPartitions("name", "conv")
    chunks = rows.mapInArrow(_chunks(CHUNK), "name string, first long, ids string")
    chunks = chunks.repartition("name").sortWithinPartitions("name", "first").select("name", "ids")
    return chunks.mapInArrow(_hashed, "name string, ends_sha256 string")


def trie(sequences: DataFrame, convs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The nodes of the trie of ``sequences``; see ``prefix_trie`` for the columns and ``paths`` for the arguments."""
    steps = staged(paths(sequences, convs, height), "paths")
    nodes = steps.groupBy("name").agg(
        F.max("pos").alias("depth"),
        F.min("conv").alias("owner"),
        F.count("*").alias("n_convs"),
        F.min("parent").alias("parent"),
        ((F.count("*") - 1) * F.max("size")).alias("saved"),
        F.when(F.max("n") == F.max("pos"), 1).otherwise(0).cast("long").alias("leaves"),
    )
    nodes = staged(nodes, "nodes")

    # what each owner's path holds from a node on: inside its segment, and grafted from the segments below
    total = F.struct(F.col("saved"), F.col("leaves"))
    chains = nodes.withColumn("b", F.expr(f"depth div {height}"))
    down = Window.partitionBy("owner", "b").orderBy(F.desc("depth"))
    chains = chains.withColumns({"saved": F.sum("saved").over(down), "leaves": F.sum("leaves").over(down)})
    sums = [F.sum(c).alias(c) for c in ("saved", "leaves")]
    segments = nodes.groupBy("owner", F.expr(f"depth div {height}").alias("b")).agg(*sums, F.min("depth").alias("top"))
    segments = staged(segments, "chains")
    owned = segments.groupBy("owner").agg(*sums, F.min("top").alias("top"), F.count("*").alias("parts"))
    long = segments.join(owned.where("parts > 1").select("owner"), "owner").select(F.col("owner").alias("conv"), "b", total.alias("v"))

    def value(c: Column, field: str) -> Column:
        return F.coalesce(c[field], F.lit(0).cast("long"))

    def plus(a: Column, b: Column) -> Column:
        return F.struct(*((value(a, f) + value(b, f)).alias(f) for f in ("saved", "leaves")))

    nothing = F.struct(*(F.lit(0).cast("long").alias(f) for f in ("saved", "leaves")))
    grafts = swept(long, nothing, plus, lambda c, u, w: (plus(c, w), c), "grafts").withColumnRenamed("conv", "owner")
    chains = chains.join(grafts, ["owner", "b"], "left")
    chains = chains.withColumns({f: F.col(f) + value(F.col("carry"), f) for f in ("saved", "leaves")}).drop("b", "carry")

    # what the other members of a node own lies below it as well
    zero = F.lit(0).cast("long")
    others = steps.select("conv", "pos", "name").join(owned.withColumnRenamed("owner", "conv"), "conv").where("pos < top")
    none = {"depth": "long", "owner": "long", "n_convs": "long", "parent": "string"}
    blank = [F.lit(None).cast(t).alias(c) for c, t in none.items()]
    others = others.groupBy("name").agg(*sums).select("name", *blank, "saved", "leaves", zero.alias("n_children"))
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    children = children.select("name", *blank, zero.alias("saved"), zero.alias("leaves"), "n_children")
    own = chains.select("name", *none, "saved", "leaves", zero.alias("n_children"))
    rows = own.unionByName(others).unionByName(children).groupBy("name")
    rows = rows.agg(*(F.max(c).alias(c) for c in none), *sums, F.sum("n_children").alias("n_children"))

    above = nodes.select(F.col("name").alias("parent"), F.col("owner").alias("parent_conv_id"))
    out = rows.join(above, "parent", "left").join(ends_digests(steps.where("pos = n")), "name", "left")
    empty = hashlib.sha256().hexdigest()
    return out.select(
        F.col("owner").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
    )


def with_lengths(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbered turns with the lengths of their conversations, and (conv, n)."""
    convs = rows.groupBy("conv").agg(F.count("*").alias("n"))
    return rows.join(convs, "conv"), convs


def prefix_trie(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", height: int = HEIGHT
) -> DataFrame:
    """The trie of the conversations in ``turns``, a row for each node.

    A node is a distinct sequence of first turns (role, text); the root has
    none.  conv_id, the smallest conversation that starts with it; depth;
    parent_conv_id, that of its parent (root: null); n_convs, conversations
    that start with it; n_children; n_leaves, childless nodes in its subtree,
    itself included; saved_tokens, over its subtree, each node's (n_convs - 1)
    times the bytes of its last text; ends_sha256 of the ascending ids, joined
    by commas, of the conversations that end here.

    Order and nulls are those of ``numbered``: null turns come first, equal
    turns in the order of their digests, repeated rows are turns of their own,
    and rows without an id are left out.  A table without conversations has no
    nodes.  Other columns are ignored.  ``height`` changes no result.
    """
    return trie(*with_lengths(numbered(turns, id_col, turn_col, role_col, text_col)), height)


def rebuilt(rows: DataFrame, every: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Numbered turns of conversations that begin like others, with lengths; and (conv, n), also of those left without turns.

    Conversation c gets the first h turns of c - c % ``every`` (the remainder
    has the sign of c), all if there are fewer, and then its own after its
    first h; h is the CRC-32 of the decimal c, modulo ``most``.
    """
    convs = rows.groupBy("conv").agg(F.count("*").alias("own"))
    convs = convs.withColumns({"h": F.crc32(F.col("conv").cast("string").cast("binary")) % most, "base": F.expr(f"conv - conv % {every}")})
    bases = convs.where("conv = base").select(F.col("conv").alias("base"), F.col("own").alias("found"))
    convs = convs.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("found", F.lit(0))))
    convs = staged(convs.withColumn("n", F.expr("taken + greatest(own - h, 0)")).drop("found", "own"), "convs")
    heads = rows.where(f"conv % {every} = 0 and pos < {most}").withColumnRenamed("conv", "base")
    heads = heads.join(convs, "base").where("pos <= h").select("conv", "pos", "x", "size", "n")
    own = rows.join(convs, "conv").where("pos > h").select("conv", F.expr("taken + pos - h").alias("pos"), "x", "size", "n")
    return heads.unionByName(own), convs.select("conv", "n")
