"""Near-duplicate documents: SuperMinHash, banding, verification on whole sets, union-find grouping.

Which documents are linked is decided on their whole sets of word shingles.
Bands only choose what to compare: with 25 bands of 5 values a pair at a
similarity of 0.85 shares no band with a probability of about 4e-7.

1. Documents with the same set become one node (its least doc_id), so exact
   copies cost one row each however many there are.
2. In every band bucket each node is compared with the bucket's least node
   only, never with all others.
3. Buckets whose nodes are still in different components are cut into blocks
   of a few hundred nodes.  Each two blocks meet in one task, which compares
   pairs of different components on their signatures and then on their whole
   sets, and gives back only links that join something.  Signatures may fall
   short of the threshold by ``slack``, over 5 standard errors.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import text_of
from .components import components
from .staging import staged
from .superminhash import signatures
from .words import Words, mix, slices, windows

_SALTS = (np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB))


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct k-word shingles of each text, and where each text's begin; short texts are one shingle."""
    words = Words(texts, lower=True)
    h = words.hashes()
    whole = windows(h, k)
    sets = []
    for d in range(len(texts)):
        i, j = words.first[d], words.first[d + 1]
        own = whole[i : j - k + 1] if j - i >= k else windows(h[i:j], int(j - i)) if j > i else h[:0]
        own = np.sort(own)
        if len(own) > 1:
            own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        sets.append(own)
    first = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(s) for s in sets], out=first[1:])
    return (np.concatenate(sets) if sets else h[:0]), first


def _sums(h: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    out = []
    for salt in _SALTS:
        total = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(mix(h ^ salt), out=total[1:])
        out.append((total[first[1:]] - total[first[:-1]]).view(np.int64))
    return out


def _binary(rows: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(rows)
    width = data.shape[1] * data.itemsize
    kind = pa.binary(width)
    return pa.Array.from_buffers(kind, len(data), [None, pa.py_buffer(data.tobytes())]).cast(pa.binary())


def _signed(k: int, m: int):
    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            h, first = shingle_sets(part.column(1), k)
            sig = signatures(h, first, m)
            # 32 bits of each value are enough to compare by; equal values stay equal
            short = (mix(sig) >> np.uint64(32)).astype(np.uint32)
            d1, d2 = _sums(h, first)
            columns = [part.column(0), pa.array(np.diff(first)), pa.array(d1), pa.array(d2), _binary(short)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "d1", "d2", "sig"])

    return sign


def _banded(bands: int, rows: int):
    places = np.arange(1, bands + 1, dtype=np.uint64)

    def band(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint32).reshape(batch.num_rows, bands * rows)
            acc = np.zeros((batch.num_rows, bands), np.uint64)
            for r in range(rows):
                acc = mix(acc * np.uint64(31) + sig[:, r::rows] + np.uint64(1))
            acc = mix(acc ^ (places * _SALTS[0]))
            node = np.repeat(batch.column(0).to_numpy(), bands)
            n = np.repeat(batch.column(1).to_numpy(), bands)
            number = np.tile(np.arange(bands, dtype=np.int32), batch.num_rows)
            arrays = [pa.array(x) for x in (acc.reshape(-1).view(np.int64), number, node, n)]
            yield pa.RecordBatch.from_arrays(arrays, ["bucket", "band", "node", "n"])

    return band


def similar(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    """Whether two sets, sorted, share enough of their union."""
    both = np.concatenate((left, right))
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return common > 0 and 100 * common >= percent * (len(both) - common)


class _Sets:
    """Shingle sets of texts met before, up to a bounded number of shingles."""

    ROOM = 1 << 22

    def __init__(self, k: int):
        self.k, self.known, self.size = k, {}, 0

    def of(self, texts: pa.Array, i: int, node: int) -> np.ndarray:
        text = texts.slice(i, 1)
        key = node, zlib.crc32(text[0].as_buffer())  # an id may have several texts
        if key not in self.known:
            if self.size > self.ROOM:
                self.known, self.size = {}, 0
            self.known[key] = shingle_sets(text, self.k)[0]
            self.size += len(self.known[key])
        return self.known[key]


def _confirmed(k: int, percent: int):
    def confirm(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = _Sets(k)
        for batch in batches:
            a, b, keep = batch.column(0).to_numpy(), batch.column(1).to_numpy(), np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                left, right = sets.of(batch.column(2), i, a[i]), sets.of(batch.column(3), i, b[i])
                keep[i] = similar(left, right, percent)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], ["a", "b"])

    return confirm


def _joined(bands: int, rows: int, k: int, percent: int, slack: float):
    """Links between different components inside one group: a block of a bucket, or two.

    Pairs that share an earlier band meet there and are left to it.  Pairs
    whose signatures fall short by more than ``slack`` are not looked at;
    the others are compared on their whole sets, most similar first, unless
    links found before have joined them.
    """
    least = percent / 100 - slack

    def join(table: pa.Table) -> pa.Table:
        node, comp, n, side = (table.column(c).to_numpy() for c in ("node", "component", "n", "side"))
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint32).reshape(-1, bands, rows)
        band, same = table.column("band")[0].as_py(), table.column("own")[0].as_py()
        left = np.flatnonzero(side == 0)
        right = left if same else np.flatnonzero(side == 1)
        pairs = []
        for i in left:
            fits = 100 * np.minimum(n[right], n[i]) >= percent * np.maximum(n[right], n[i])
            others = right[(comp[right] != comp[i]) & fits & ((node[right] > node[i]) if same else True)]
            equal = sig[others] == sig[i]
            agree = equal.mean((1, 2))
            new = (agree >= least) & ~equal[:, :band].all(2).any(1)
            pairs += zip((-agree[new]).tolist(), [int(i)] * int(new.sum()), others[new].tolist())
        pairs.sort()
        texts, sets, parent = text_of(table), {}, {}

        def shingles(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = shingle_sets(texts.slice(i, 1), k)[0]
            return sets[i]

        def root(c: int) -> int:
            while (up := parent.get(c, c)) != c:
                parent[c] = parent.get(up, up)
                c = up
            return c

        links = []
        for _, i, j in pairs:
            a, b = root(int(comp[i])), root(int(comp[j]))
            if a != b and similar(shingles(i), shingles(j), percent):
                parent[max(a, b)] = min(a, b)
                links.append((int(node[i]), int(node[j])))
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([x for _, x in links], pa.int64())})

    return join


def _unsettled(member: DataFrame, label: DataFrame, block: int) -> DataFrame:
    """Buckets whose nodes are in several components, cut into blocks that meet each other once: as (i, j), i <= j."""
    named = member.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = named.groupBy("bucket").agg(
        F.min("component").alias("least"), F.max("component").alias("most"), F.count("*").alias("members")
    )
    mixed = mixed.where("least < most").select("bucket", F.ceil(F.col("members") / block).cast("long").alias("blocks"))
    rest = named.join(mixed, "bucket").withColumn("mine", F.pmod(F.xxhash64("node"), "blocks"))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return rest.select(
        "bucket", "band", "node", "component", "n", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
        (F.col("mine") > F.col("other")).cast("int").alias("side"), (F.col("mine") == F.col("other")).alias("own"),
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = 5,
    percent: int = 85,
    bands: int = 25,
    rows: int = 5,
    block: int = 256,
    slack: float = 0.17,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Two documents are linked if 100 * |A and B| >= percent * |A or B| of their
    sets of k-word shingles (ASCII letters lower-cased); a component is named by
    its least doc_id, and only that document is kept.  A document shorter than
    k words is one shingle.  Null, empty and blank texts have no shingle and are
    linked with nothing.  A row with a null id is returned with its n_shingles,
    a null component and null kept.  Repeated ids are one node; every row comes
    back.  Other columns are ignored.
    """
    m = bands * rows
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = staged(source.mapInArrow(_signed(k, m), "doc_id long, n_shingles long, d1 long, d2 long, sig binary"), "signed")
    key = ["n_shingles", "d1", "d2"]
    full = signed.where("doc_id is not null and n_shingles > 0")
    nodes = staged(full.groupBy(*key).agg(F.min_by("sig", "doc_id").alias("sig"), F.min("doc_id").alias("node")), "nodes")

    member = nodes.select("node", F.col("n_shingles").alias("n"), "sig").mapInArrow(
        _banded(bands, rows), "bucket long, band int, node long, n long"
    )
    first = F.min(F.struct("node", "n"))
    shared = member.groupBy("bucket").agg(first.alias("first"), F.max("node").alias("most")).where("first.node < most")
    shared = shared.select("bucket", F.col("first.node").alias("centre"), F.col("first.n").alias("n_centre"))
    member = staged(member.join(shared, "bucket"), "buckets")

    # the wanted ids grow with the corpus, so this is a sort-merge join at every size
    wanted = member.select("node").distinct().join(nodes.select("node", "sig"), "node").withColumnRenamed("node", "doc_id")
    texts = staged(source.join(wanted.hint("merge"), "doc_id"), "texts")

    def verify(pairs: DataFrame) -> DataFrame:
        pairs = pairs.distinct()
        left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("left"))
        right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("right"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
        return both.mapInArrow(_confirmed(k, percent), "a long, b long")

    stars = member.where("node <> centre").where(f"100 * least(n, n_centre) >= {percent} * greatest(n, n_centre)")
    links = staged(verify(stars.select(F.col("centre").alias("a"), F.col("node").alias("b"))), "links")

    label = components(links)
    rest = staged(_unsettled(member.where("node <> centre"), label, block), "rest")
    if not rest.isEmpty():
        held = texts.select(F.col("doc_id").alias("node"), "text", "sig")
        groups = rest.join(held, "node").groupBy("bucket", "i", "j")
        links = links.union(groups.applyInArrow(_joined(bands, rows, k, percent, slack), "a long, b long"))
        label = components(links)

    named = nodes.join(label, "node", "left").select(*key, F.coalesce("component", "node").alias("component_id"))
    out = signed.drop("sig").join(named, key, "left")
    component = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("component_id", "doc_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))
