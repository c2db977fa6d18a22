"""Frequent phrases and how tightly their words hold together: relational mining after SETM.

The relation of a level holds the occurrences of frequent phrases of k words,
sorted by place; it is written once for each level.  A merge-join of
neighbouring places makes the occurrences of k + 1 words, groups are counted,
and a semi-join with the frequent groups leaves the next relation.  A place is
left free between two pieces, so neighbouring places are in one piece.

A block of the relation is a run of documents and travels as packed arrays.
Its distinct groups are counted in the block, so what moves is an entry for
each distinct group and block, and a phrase that all documents share weighs one
entry for each block.  A bucket of groups adds the entries up, keeps what is
frequent, and answers each block with the ids of its frequent groups.  Groups
are pairs of ids of the level before, words are compared as texts: no hash
decides a count.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .staging import parts_for, staged, text_bytes
from .words import LOWER, mix, slices

#: Text of a block, and text whose groups meet in a bucket.  Larger blocks report less, at more memory for a task.
BLOCK_BYTES = 8 << 20
BUCKET_BYTES = 16 << 20

_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1  # between words
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2  # between pieces

GROWN = "block long, kind int, bucket int, start long, n long, x binary, y binary, z binary, lang string"
COUNTED_WORDS = "block long, start long, n long, x binary, y binary, id long, lang string, phrase string, f long"
COUNTED = "block long, start long, n long, x binary, y binary, id long, first long, last long, f long"
_KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
#: Kinds of rows of GROWN: the relation, a report to a bucket, the words of a language.
RELATION, REPORT, TOTAL = range(3)


def rows_of(schema: str, rows: list[tuple]) -> pa.Table:
    names, kinds = zip(*(x.split() for x in schema.split(", ")))
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.table([pa.array(c, _KINDS[k]) for c, k in zip(columns, kinds)], names=list(names))


def packed(a: np.ndarray) -> bytes:
    """Whole numbers from 0 on, compressed by planes of bytes; four bytes each if all fit."""
    width = 4 if not len(a) or a.max() < 1 << 32 else 8
    planes = np.ascontiguousarray(a.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T)
    return bytes([width]) + pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(blob: bytes, n: int) -> np.ndarray:
    width = blob[0]
    planes = pa.decompress(memoryview(blob)[1:], n * width, codec="zstd")
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, n).T).view(f"<u{width}").reshape(-1).astype(np.int64)


def steps(a: np.ndarray) -> np.ndarray:
    """Differences of ascending numbers."""
    return np.diff(a, prepend=0)


def block_words(texts: list[str], langs: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (word, lang) of a block with their counts; the place and the code of each word; the lang of each word.

    A place is left free between two pieces.
    """
    data = LOWER[np.frombuffer("\n".join(texts).encode(), np.uint8)]
    kind = _KIND[data]
    word = kind == 0
    edge = np.flatnonzero(np.diff(word, prepend=False, append=False))
    start, end = edge[::2], edge[1::2]
    breaks = np.cumsum(kind == 2, dtype=np.int32)[start] if len(start) else np.zeros(0, np.int32)
    places = np.arange(len(start)) + np.cumsum(np.diff(breaks, prepend=breaks[:1]) > 0)
    sizes = np.fromiter((len(t.encode()) + 1 for t in texts), np.int64, len(texts))
    lang = langs[np.searchsorted(np.cumsum(sizes), start, "right")]
    at = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    column = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(at), pa.py_buffer(data[word])).dictionary_encode()
    kinds = max(len(column.dictionary), 1)
    distinct, code, counts = np.unique(lang * kinds + column.indices.to_numpy(), return_inverse=True, return_counts=True)
    return column.dictionary.take(pa.array(distinct % kinds)), distinct // kinds, counts, places, code, lang


def word_buckets(words: pa.LargeStringArray, buckets: int) -> np.ndarray:
    """A bucket for each word (none is empty) by a hash of its bytes."""
    _, offsets, data = words.buffers()
    at = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
    if not len(words):
        return np.zeros(0, np.int64)
    letters = np.frombuffer(data, np.uint8)[at[0] : at[-1]].astype(np.uint64)
    place = np.arange(len(letters)) - np.repeat(at[:-1] - at[0], np.diff(at))
    spread = (letters + np.uint64(1)) * mix((place % 64 + 1).astype(np.uint64))
    return (mix(np.add.reduceat(spread, at[:-1] - at[0])) % np.uint64(buckets)).astype(np.int64)


def relation(block: int, places: np.ndarray, codes: np.ndarray) -> tuple:
    return (block, RELATION, None, None, len(places), packed(steps(places)), packed(codes), None, None)


def _blocks(limit: int, buckets: int):
    """The words of every block of about ``limit`` bytes, and their reports; a longer text is a block of its own."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in slices(batches, limit=limit):
            names = batch.column(0).dictionary_encode()
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            words, lang, counts, places, codes, each = block_words(texts, names.indices.to_numpy().astype(np.int64))
            bucket = word_buckets(words, buckets)
            order = np.argsort(bucket, kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            rows = [relation(block, places, rank[codes])]
            table = pa.table([words.take(pa.array(order)), names.dictionary.take(pa.array(lang[order])), pa.array(counts[order])], ["word", "lang", "n"])
            at = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            for a, b in zip(at, [*at[1:], len(order)]):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_table(table.slice(a, b - a).combine_chunks())
                rows.append((block, REPORT, int(bucket[order[a]]), int(a), int(b - a), sink.getvalue().to_pybytes(), None, None, None))
            total = np.bincount(each, minlength=len(names.dictionary))
            rows += [(block, TOTAL, None, None, int(n), None, None, None, name) for n, name in zip(total, names.dictionary.to_pylist())]
            yield from rows_of(GROWN, rows).to_batches()
            block += 1

    return cut


def grow(block: int, places: np.ndarray, codes: np.ndarray, ids: np.ndarray, buckets: int) -> pa.Table:
    """Join neighbouring places, count the pairs, and report them to their buckets.

    ``ids[codes[i]]`` is the phrase at ``places[i]``; ids ascend.  The joined
    relation is coded by the order of the reports, which hold the ids of the
    first and the last words, and counts.
    """
    near = np.flatnonzero(places[1:] == places[:-1] + 1)
    pairs, code, counts = np.unique(codes[near] * max(len(ids), 1) + codes[near + 1], return_inverse=True, return_counts=True)
    first, last = ids[pairs // max(len(ids), 1)], ids[pairs % max(len(ids), 1)]
    spread = mix(first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + last.astype(np.uint64))
    bucket = (spread % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    first, last, counts, bucket = first[order], last[order], counts[order], bucket[order]
    at = np.flatnonzero(np.diff(bucket, prepend=-1))
    rows = [relation(block, places[near], rank[code])]
    for a, b in zip(at, [*at[1:], len(bucket)]):
        own = packed(steps(first[a:b])), packed(last[a:b]), packed(counts[a:b])
        rows.append((block, REPORT, int(bucket[a]), int(a), int(b - a), *own, None))
    return rows_of(GROWN, rows)


def _joined(buckets: int):
    """Semi-join a block's relation with the ids of its frequent groups, as the buckets answered, and grow it."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return rows_of(GROWN, [])
        n = left.column("n")[0].as_py()
        places, codes = np.cumsum(unpacked(left.column("x")[0].as_py(), n)), unpacked(left.column("y")[0].as_py(), n)
        id_of = np.full(int(codes.max(initial=0)) + 1, -1, np.int64)
        for start, m, hits, ids in zip(*(right.column(c).to_pylist() for c in ("start", "n", "x", "y"))):
            id_of[start + np.cumsum(unpacked(hits, m))] = unpacked(ids, m)
        frequent = np.flatnonzero(id_of >= 0)
        frequent = frequent[np.argsort(id_of[frequent])]
        rank = np.full(len(id_of), -1, np.int64)
        rank[frequent] = np.arange(len(frequent))
        here = rank[codes]
        kept = here >= 0
        return grow(left.column("block")[0].as_py(), places[kept], here[kept], id_of[frequent], buckets)

    return run


def numbers(total: np.ndarray, least: int, bucket: int, buckets: int) -> np.ndarray:
    """Ids of a bucket's groups, -1 for those below ``least``; frequent groups get small ids, no two buckets the same."""
    often = np.flatnonzero(total >= least)
    out = np.full(len(total), -1, np.int64)
    out[often[np.argsort(-total[often], kind="stable")]] = np.arange(len(often)) * buckets + bucket
    return out


def answered(reports: pa.Table, ids: np.ndarray) -> list[tuple]:
    """A row for each block: where in its report frequent groups are, and their ids."""
    rows, at = [], 0
    for block, start, n in zip(*(reports.column(c).to_pylist() for c in ("block", "start", "n"))):
        own = ids[at : at + n]
        at += n
        hits = np.flatnonzero(own >= 0)
        if len(hits):
            rows.append((block, start, len(hits), packed(steps(hits)), packed(own[hits]), None, None, None, None))
    return rows


def _counted_words(buckets: int, least: int):
    """A bucket of words: add up the reports, number the frequent words, answer the blocks that have them."""

    def run(reports: pa.Table) -> pa.Table:
        bucket = reports.column("bucket")[0].as_py()
        words = pa.concat_tables([pa.ipc.open_stream(x).read_all() for x in reports.column("x").to_pylist()])
        word, lang = (words.column(c).combine_chunks().dictionary_encode() for c in ("word", "lang"))
        key = word.indices.to_numpy().astype(np.int64) * len(lang.dictionary) + lang.indices.to_numpy()
        groups, group = np.unique(key, return_inverse=True)
        total = np.zeros(len(groups), np.int64)
        np.add.at(total, group, words.column("n").to_numpy())
        number = numbers(total, least, bucket, buckets)
        rows = answered(reports, number[group])
        often = np.flatnonzero(number >= 0)
        texts = word.dictionary.take(pa.array(groups[often] // len(lang.dictionary))).to_pylist()
        names = lang.dictionary.take(pa.array(groups[often] % len(lang.dictionary))).to_pylist()
        none = (None,) * 5
        rows += [(*none, i, name, text, f) for i, name, text, f in zip(number[often].tolist(), names, texts, total[often].tolist())]
        return rows_of(COUNTED_WORDS, rows)

    return run


def _counted(buckets: int, least: int):
    """A bucket of pairs: add up the reports, number the frequent groups, answer the blocks that have them."""

    def run(reports: pa.Table) -> pa.Table:
        bucket = reports.column("bucket")[0].as_py()
        first, last, counts = [], [], []
        for n, x, y, z in zip(*(reports.column(c).to_pylist() for c in ("n", "x", "y", "z"))):
            first.append(np.cumsum(unpacked(x, n)))
            last.append(unpacked(y, n))
            counts.append(unpacked(z, n))
        first, last, counts = (np.concatenate(c) for c in (first, last, counts))
        order = np.lexsort((last, first))
        new = np.concatenate([[True], (np.diff(first[order]) != 0) | (np.diff(last[order]) != 0)])
        head = np.flatnonzero(new)
        total = np.add.reduceat(counts[order], head)
        number = numbers(total, least, bucket, buckets)
        ids = np.empty(len(order), np.int64)
        ids[order] = number[np.cumsum(new) - 1]
        often = np.flatnonzero(number >= 0)
        lead = order[head[often]]
        none = (None,) * 5
        groups = zip(number[often].tolist(), first[lead].tolist(), last[lead].tolist(), total[often].tolist())
        return rows_of(COUNTED, answered(reports, ids) + [(*none, *g) for g in groups])

    return run


def frequent_phrases(
    docs: DataFrame, text_col: str, lang_col: str, least: int, longest: int, block_bytes: int, bucket_bytes: int
) -> tuple[DataFrame, DataFrame]:
    """(k, lang, phrase, f) of all phrases of up to ``longest`` words that occur ``least`` times; (lang, n) of all words."""
    spark = docs.sparkSession
    size = docs.select(F.col(text_col).alias("text"))
    buckets = parts_for(spark, text_bytes(size), bucket_bytes)
    source = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    places = staged(source.mapInArrow(_blocks(block_bytes, buckets), GROWN), "places1")
    n = places.where(f"kind = {TOTAL}").groupBy("lang").agg(F.sum("n").alias("n"))

    levels: list[DataFrame] = []
    for k in range(1, longest + 1):
        count, schema = (_counted, COUNTED) if k > 1 else (_counted_words, COUNTED_WORDS)
        reports = places.where(f"kind = {REPORT}").select("block", "bucket", "start", "n", "x", "y", "z")
        counted = staged(reports.groupBy("bucket").applyInArrow(count(buckets, least), schema), f"groups{k}")
        groups = counted.where("id is not null")
        if k == 1:
            level = groups.select("id", "lang", "phrase", F.col("phrase").alias("tail"), "f")
        else:
            head = levels[-1].select(F.col("id").alias("first"), "lang", F.col("phrase").alias("head"))
            tail = levels[-1].select(F.col("id").alias("last"), "tail")
            level = groups.select("id", "first", "last", "f").join(head, "first").join(tail, "last")
            level = staged(level.select("id", "lang", F.concat_ws(" ", "head", "tail").alias("phrase"), "tail", "f"), f"phrases{k}")
        levels.append(level)
        if k < longest:
            here = places.where(f"kind = {RELATION}").select("block", "n", "x", "y").groupBy("block")
            answers = counted.where("block is not null").select("block", "start", "n", "x", "y").groupBy("block")
            places = staged(here.cogroup(answers).applyInArrow(_joined(buckets), GROWN), f"places{k + 1}")
    out = [level.select(F.lit(k).alias("k"), "lang", "phrase", "f") for k, level in enumerate(levels, 1)]
    union = out[0]
    for other in out[1:]:
        union = union.unionByName(other)
    return union, n


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 100, longest: int = 5, top: int = 2000,
    block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language whose words hold together best.

    Letters A-Z are lower-cased; texts fall into pieces at ``.,;:!?`` and
    line ends, pieces into words at spaces and tabs.  Candidates are phrases of
    2 to ``longest`` words that occur ``a >= least`` times inside pieces,
    overlaps included.  Cut in two, with ``l`` and ``r`` occurrences of the
    parts, a candidate scores floor(1000 a n / (l r)), n being all words of the
    language; the lowest score counts, of equal ones the earliest cut.
    A candidate that a longer one contains and that never occurs without it is
    left out.  Order: score and a descending, phrase by its bytes.

    A null text is empty, a null language is ``und``; repeated rows count
    again.  No words, no rows.  Other columns are ignored.  All arithmetic is
    in whole numbers.
    """
    phrases, n = frequent_phrases(docs, text_col, lang_col, least, longest, block_bytes, bucket_bytes)
    counts = phrases.select("lang", "phrase", "f")
    long = phrases.where("k > 1")
    cuts = long.withColumn("cut", F.explode(F.expr("sequence(1, k - 1)")))
    cuts = cuts.withColumns({"head": F.expr("substring_index(phrase, ' ', cut)"), "rest": F.expr("substring_index(phrase, ' ', cut - k)")})
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]).join(n, "lang")
    wide = {c: f"cast({c} as decimal(18, 0))" for c in ("f", "n", "l", "r")}
    score = F.expr(f"cast(({wide['f']} * {wide['n']} * 1000) div ({wide['l']} * {wide['r']}) as long)")
    lowest = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("s")
    scored = cuts.groupBy("lang", "phrase").agg(F.max("f").alias("a"), F.max("n").alias("n"), lowest)

    # if a longer phrase contains it every time, then so does one that is longer by one word
    sides = F.array(F.expr("substring_index(phrase, ' ', k - 1)"), F.expr("substring_index(phrase, ' ', 1 - k)"))
    around = phrases.where("k > 2").select("lang", F.explode(sides).alias("phrase"), "f")
    around = around.groupBy("lang", "phrase").agg(F.max("f").alias("around"))
    kept = scored.join(around, ["lang", "phrase"], "left").where("around is null or around < a")
    kept = kept.select("lang", "phrase", "a", "s.l", "s.r", "n", "s.score")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
