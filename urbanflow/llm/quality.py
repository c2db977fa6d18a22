"""Quality rules: plain counts, and a likelihood ratio of hashed n-grams between trusted and raw text.

The n-grams are every run of ``n`` bytes of a text, hashed into a fixed number
of bins.  Two multinomials are counted over the corpus: one over all documents,
one over the documents labelled good.  A document's score is the mean over its
n-grams of log(p_trusted / p_raw); the threshold is the one that separates the
labelled documents best.  Log ratios are rounded to whole numbers, so scores
are sums of integers and don't depend on how rows are dealt.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .blocks import SLICED, sliced, summed
from .words import SEPARATOR, Words, slices, windows

#: Bins of the hashed n-grams, and their share that each task sends in one row.
BINS = 1 << 16
SLICES = 16
#: A log ratio of 1 as a whole number; scores are kept to 1 / STEPS.
UNIT = 1 << 16
STEPS = 4096
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


def repeated_words(h: np.ndarray, k: int = 8) -> int:
    """How many of the words are covered by windows of k words that occur twice or more."""
    w = windows(h, k)
    if len(w) < 2:
        return 0
    order = np.sort(w)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    edge = np.zeros(len(h) + 1, np.int64)
    hit = np.flatnonzero(np.isin(w, twice))
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + k, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def repeated_lines(text: bytes) -> int:
    """How many lines with a word equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.split()]
    return len(lines) - len(set(lines))


def base_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    words = Words(texts)
    h, data, bounds = words.hashes(), words.data, words.bounds
    inner = np.concatenate(([0], np.cumsum(~SEPARATOR[data] & ((data & 0xC0) != 0x80))))
    marks = np.concatenate(([0], np.cumsum(SYMBOLS[data])))
    docs = range(len(texts))
    first = words.first
    return {
        "n_words": np.diff(first),
        "word_chars": inner[bounds[1:]] - inner[bounds[:-1]],
        "n_symbols": marks[bounds[1:]] - marks[bounds[:-1]],
        "n_dup_lines": np.array([repeated_lines(data[bounds[d] : bounds[d + 1]].tobytes()) for d in docs], np.int64),
        "n_repeat_words": np.array([repeated_words(h[first[d] : first[d + 1]]) for d in docs], np.int64),
    }


def gram_bins(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin of every n-gram of the texts, and where each text's begin; a text shorter than n has none."""
    words = Words(texts)
    data, bounds = words.data, words.bounds
    if len(data) < n:
        return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    code = np.zeros(len(data) - n + 1, np.uint64)
    for i in range(n):
        code = code * np.uint64(257) + data[i : len(code) + i]
    bins = ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64)
    inside = np.ones(len(bins), bool)
    for b in bounds[1:-1]:
        inside[max(0, b - n + 1) : b] = False
    at = np.concatenate(([0], np.cumsum(inside)))
    return bins[inside], at[np.minimum(bounds, len(bins))]


def _counted(n: int):
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BINS), np.int64)
        for part in slices(batches):
            bins, first = gram_bins(part.column(0), n)
            total[0] += np.bincount(bins, minlength=BINS)
            good = np.repeat(part.column(1).to_numpy(zero_copy_only=False), np.diff(first))
            total[1] += np.bincount(bins[good], minlength=BINS)
        yield sliced(total.reshape(2, SLICES, -1).transpose(1, 0, 2).reshape(-1), SLICES)

    return count


def log_ratios(total: np.ndarray) -> np.ndarray:
    """The ratio of each bin as a whole number, each bin counted once more than seen; 0 without trusted text."""
    if not total[1].any():
        return np.zeros(BINS, np.int64)
    logs = np.log(total + 1.0) - np.log(total.sum(1, keepdims=True) + BINS)
    return np.rint((logs[1] - logs[0]) * UNIT).astype(np.int64)


def best_threshold(rows: list[tuple[int, int, int]]) -> int:
    """The score from which on to keep: rows (score, good, bad); most good kept and bad dropped, in shares.

    Of thresholds that do equally well the middle of the widest run is taken.
    """
    rows = sorted(rows)
    good, bad = sum(r[1] for r in rows), sum(r[2] for r in rows)
    if not good or not bad:
        return np.iinfo(np.int64).min
    best, found, lost, dropped = -1.0, (rows[0][0], rows[0][0]), 0, 0
    last = rows[0][0]
    for score, g, b in rows:
        worth = (good - lost) / good + dropped / bad
        if worth > best or worth == best and score - last > found[1] - found[0]:
            best, found = worth, (last, score)
        if g or b:
            last = score
        lost, dropped = lost + g, dropped + b
    return (found[0] + found[1] + 1) // 2


def _scores(batches: Iterable[pa.RecordBatch], table: np.ndarray, n: int, with_text: bool) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        base = base_counts(part.column(1))
        bins, first = gram_bins(part.column(1), n)
        total = np.concatenate(([0], np.cumsum(table[bins])))
        size = np.maximum(np.diff(first), 1)
        value = (total[first[1:]] - total[first[:-1]]) * STEPS // (size * UNIT)
        arrays = [part.column(0), part.column(2), *(pa.array(x, pa.int64()) for x in base.values()), pa.array(value, pa.int64())]
        texts = [part.column(1)] * with_text
        yield pa.RecordBatch.from_arrays([*arrays, *texts], ["doc_id", "carried", *base, "value", *["text"] * with_text])


def quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = 4,
    least_words: int = 20,
    repeat_percent: int = 30,
    carry: tuple[str, ...] = (),
    with_text: bool = False,
) -> DataFrame:
    """(doc_id, carried, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept).

    ``with_text`` adds the text as it came.

    ``labels`` has doc_id and quality (0 or 1); documents with a label 1 and no
    label 0 are the trusted text.  A document is kept if it passes the base
    rules and its score reaches the threshold.  A text without n-grams scores
    0.  Without labels of both kinds the base rules alone decide.  A null text
    counts as empty; ids may be null or repeat, and every row comes back.
    Columns named in ``carry`` come back in the struct ``carried``.
    """
    spark = docs.sparkSession
    carried = F.struct(*[F.col(c) for c in carry]) if carry else F.lit(None).cast("string")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), carried.alias("carried"))
    marks = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marks = marks.agg(F.min("quality").cast("int").alias("good"))

    trusted = F.coalesce(F.col("good") == 1, F.lit(False)).alias("trusted")
    # labels grow with the corpus, so this is a sort-merge join at every size
    marked = source.select("doc_id", "text").join(marks.hint("merge"), "doc_id", "left").select("text", trusted)
    total = summed(marked.mapInArrow(_counted(n), SLICED), SLICES, 2 * BINS, np.int64)
    total = total.reshape(SLICES, 2, -1).transpose(1, 0, 2).reshape(2, BINS)
    ratios = spark.sparkContext.broadcast(log_ratios(total))

    def score(with_text: bool):
        return lambda batches: _scores(batches, ratios.value, n, with_text)

    counted = StructType([source.schema["doc_id"], source.schema["carried"]])
    for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "value"):
        counted = counted.add(name, "long")
    slim = source.mapInArrow(score(False), counted)
    if with_text:
        counted = counted.add("text", "string")
    failed = F.expr(f"n_words < {least_words} or 100 * n_repeat_words > {repeat_percent} * n_words")
    scored = source.mapInArrow(score(with_text), counted).withColumn("base_failed", failed)

    # the threshold needs labelled scores only; scoring twice is cheaper than keeping a copy of the texts
    fair = slim.withColumn("base_failed", failed).select("doc_id", "value", "base_failed").where("not base_failed").join(marks, "doc_id").groupBy("value")
    sums = fair.agg(F.sum("good").alias("g"), F.sum(1 - F.col("good")).alias("b")).collect()
    least = int(best_threshold([(r.value, r.g, r.b) for r in sums]))
    kept = ~F.col("base_failed") & (F.col("value") >= F.lit(least))
    return scored.withColumn("score", F.col("value") / STEPS).withColumn("kept", kept).drop("value")
