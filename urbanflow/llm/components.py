"""Connected components of a table of links: union-find inside each partition, then hooking between partitions."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import staged


def _forest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], ["node", "root"])


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every end of ``links`` (its first two columns, long); component is the least node reached.

    Rows with a null end are left out.  Every round replaces the roots that a
    link joins by the least root beside them and shortens the chains this
    makes; it ends when no link joins two roots.
    """
    a, b = links.columns[:2]
    links = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).dropna()
    forest = staged(links.mapInArrow(_forest, "node long, root long"), "forest")
    label = staged(forest.groupBy("node").agg(F.min("root").alias("component")), "labels")
    while True:
        ends = label.select(F.col("node").alias("root"), F.col("component").alias("other"))
        joined = forest.join(label, "node").join(ends, "root").where("component <> other")
        hooks = joined.groupBy(F.greatest("component", "other").alias("old")).agg(F.min(F.least("component", "other")).alias("new"))
        hooks = staged(hooks, "hooks")
        if hooks.isEmpty():
            return label
        for _ in range(3):
            further = hooks.select(F.col("old").alias("new"), F.col("new").alias("end"))
            hooks = hooks.join(further, "new", "left").select("old", F.coalesce("end", "new").alias("new"))
        moved = label.join(hooks.withColumnRenamed("old", "component"), "component", "left")
        label = staged(moved.select("node", F.coalesce("new", "component").alias("component")), "labels")
