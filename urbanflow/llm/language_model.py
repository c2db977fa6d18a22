"""Scoring texts with a language model: word counts as the base, causal self-attention over subword ids as the model.

Texts are spelled once.  Their ids are dealt into shards by a hash of the row
and staged, one row a shard; all that follows reads those.  How many shards
there are depends on the size of the text alone, and rows lie in them in a
fixed order, so nothing depends on how a table is partitioned.

A word is its ids, from one that begins a word to the next.  Words are counted
over shards and buckets (see blocks): a shard asks for each of its distinct
words once.  The model's weights are fitted in rounds: in each, a copy walks
over the windows of each shard, and the changes of all copies are averaged by
the windows they have seen, in whole numbers, so that order doesn't matter.
The windows of a text lie side by side, so that each of its ids is predicted
once a round, whatever its length.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .attention import SIZE, SPAN, Scorer, Trainer, Vocabulary, initial
from .blocks import SLICED, answers, cuts, dealt, sliced, summed
from .staging import parts_for, staged, text_bytes
from .tokens import encoder
from .words import mix, slices

SLICES = 16
BUCKET_BYTES = 4 << 20
#: Bytes of text in a shard, about; a copy of the model walks over one.
SHARD_BYTES = 8 << 20
#: Ids after which a shard is cut, so that many rows of equal hash never form one.
SHARD_IDS = 8 << 20
#: Bytes of text that are spelled at a time, about.
SPELLED_BYTES = 2 << 20
BATCH = 256
#: Steps of the changes that copies report, for sums in whole numbers.
GRAIN = 2.0**20
#: Share of a word's discounted count, and the discount, in the mixture with the attention model.
WEIGHT = 0.3
DISCOUNT = 0.5

SPELLED = "doc_id long, train boolean, ids binary"
SHARDS = "shard long, docs array<bigint>, train binary, sizes binary, ids binary"


def held_out(ids: Iterable[int | None], modulus: int, remainder: int) -> np.ndarray:
    """crc32 of the id as text, mod ``modulus``, is ``remainder``; a null id is an empty text."""
    return np.array([zlib.crc32(b"" if i is None else str(i).encode()) % modulus == remainder for i in ids], bool)


class Subwords:
    """Subword ids of lower-cased words, from a cache of words in two generations; a text ends with the id ``end``.

    ``starts``: which ids begin a word: those with the space before it, and the end.
    """

    ROOM = 150_000

    def __init__(self, path: str):
        self.encoder = encoder(path)
        library = self.encoder.library
        self.end = library.token_to_id(self.encoder.special[0])
        self.size = library.get_vocab_size()
        space = library.id_to_token(self.encoder.merges.encode_ordinary(" ")[0])
        self.starts = np.array([(library.id_to_token(i) or "").startswith(space) for i in range(self.size)], bool)
        self.starts[self.end] = True
        self.words: dict[bytes, bytes] = {}
        self.old_words: dict[bytes, bytes] = {}
        self.merge = self.encoder.merges._core_bpe.encode_single_piece

    def spell(self, word: bytes) -> list[int]:
        text = " " + word.decode()
        return self.merge(text.encode()) if text[1:].isalpha() else self.encoder.merges.encode_ordinary(text)

    def known(self, words: list[bytes]) -> list[bytes]:
        """The ids of words, each as two little-endian bytes."""
        found = list(map(self.words.get, words))
        missed, i = found.count(None), -1
        for _ in range(missed):
            i = found.index(None, i + 1)
            w = words[i]
            ids = self.words.get(w)
            if ids is None:
                ids = self.old_words.get(w)
                self.words[w] = ids = array("H", self.spell(w) if w else []).tobytes() if ids is None else ids
            found[i] = ids
        if len(self.words) > self.ROOM:  # the words not seen for longest go
            self.old_words, self.words = self.words, {}
        return found

    def texts(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text with its end; the cache is asked once for each distinct word."""
        whole = texts.take(pa.array(np.arange(len(texts))))  # a slice's offsets confuse ascii_lower
        words = pc.ascii_split_whitespace(pc.ascii_lower(whole))
        each = words.flatten().dictionary_encode()
        ids = pa.array(self.known(each.dictionary.cast(pa.large_binary()).to_pylist()), pa.large_binary()).take(each.indices)
        _, offsets, data = ids.buffers()
        at = np.frombuffer(offsets, np.int64)[: len(ids) + 1]
        first = np.concatenate(([0], np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False))))
        whole, end = (b"" if data is None else data.to_pybytes()), np.uint16(self.end).tobytes()
        return [whole[i:j] + end for i, j in zip(at[first[:-1]], at[first[1:]])]

    def text(self, raw: bytes) -> np.ndarray:
        """Ids of a text with its end."""
        return np.frombuffer(self.texts(pa.array([raw], pa.large_binary()).cast(pa.large_string()))[0], np.uint16)


_subwords: dict[str, Subwords] = {}


def subwords(path: str) -> Subwords:
    if path not in _subwords:
        _subwords[path] = Subwords(path)
    return _subwords[path]


def _spelled(tokenizer: str, modulus: int, remainder: int):
    def spell(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sub = subwords(tokenizer)
        for batch in slices(batches, limit=SPELLED_BYTES):
            train = ~held_out(batch.column(0).to_pylist(), modulus, remainder)
            ids = pa.array(sub.texts(batch.column(1).fill_null("")), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(train), ids], ["doc_id", "train", "ids"])

    return spell


def _gathered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of their blocks become shards, one row each."""
    block, piece, held, docs, train, parts = None, 0, 0, [], [], []

    def shard() -> pa.RecordBatch:
        sizes = np.array([len(x) // 2 for x in parts], np.int64)
        values = [[(block << 24) + piece], [docs], [np.array(train, bool).tobytes()], [sizes.tobytes()], [b"".join(parts)]]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], ["shard", "docs", "train", "sizes", "ids"])

    for batch in batches:
        for b, doc, trains, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if parts and (b != block or held + len(ids) // 2 > SHARD_IDS):
                yield shard()
                piece = piece + 1 if b == block else 0
                held, docs, train, parts = 0, [], [], []
            block, held = b, held + len(ids) // 2
            docs.append(doc)
            train.append(trains)
            parts.append(ids)
    if parts:
        yield shard()


class Shard:
    """One row of the staged shards: ids of all texts one after the other, and their words."""

    def __init__(self, rows: pa.RecordBatch | pa.Table, i: int = 0):
        get = {name: rows.column(name)[i].as_py() for name in ("shard", "docs", "train", "sizes", "ids")}
        self.name, self.docs = get["shard"], get["docs"]
        self.train, self.sizes = np.frombuffer(get["train"], bool), np.frombuffer(get["sizes"], np.int64)
        self.ids = np.frombuffer(get["ids"], np.uint16)
        self.ends = np.cumsum(self.sizes)

    def texts(self) -> Iterator[np.ndarray]:
        """Ids of the training texts."""
        for train, i, j in zip(self.train, self.ends - self.sizes, self.ends):
            if train:
                yield self.ids[i:j]

    def words(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each word begins, the end of a text counted as one, the document it is in, and a 64-bit hash of its ids."""
        first = np.flatnonzero(starts[self.ids])
        doc = np.searchsorted(self.ends, first, "right")
        if not len(first):
            return first, doc, np.zeros(0, np.uint64)
        out = np.empty(len(first), np.uint64)
        many = 1 << 16
        for i in range(0, len(first), many):  # words at a time, as hashes take four times the room of ids
            at = first[i : i + many]
            until = first[i + many] if i + many < len(first) else len(self.ids)
            length = np.diff(at, append=until)
            place = np.arange(until - at[0]) - np.repeat(at - at[0], length)
            own = mix(self.ids[at[0] : until].astype(np.uint64) + (place.astype(np.uint64) << np.uint64(16)) + np.uint64(1))
            out[i : i + many] = np.add.reduceat(own, at - at[0])
        return first, doc, mix(out)


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes in order, and which of them each one is.

    Upper bits of a hash and its place share a number, as sorting numbers is far
    faster than sorting places; should the upper bits not tell two hashes apart,
    places are sorted after all.
    """
    low = np.uint64((1 << len(hashes).bit_length()) - 1)
    key = hashes & ~low
    key |= np.arange(len(hashes), dtype=np.uint64)
    key.sort()
    order = (key & low).astype(np.int64)
    found = hashes.take(order)
    if (found[1:] < found[:-1]).any():
        return np.unique(hashes, return_inverse=True)
    first = np.ones(len(found), bool)
    np.not_equal(found[1:], found[:-1], out=first[1:])
    which = np.empty_like(order)
    which[order] = np.cumsum(first) - 1
    return found[first], which


def _shards(batches: Iterable[pa.RecordBatch]) -> Iterator[Shard]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Shard(batch, i)


def _counted(size: int):
    """Counts of all ids of all training texts."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for shard in _shards(batches):
            total += np.bincount(shard.ids[np.repeat(shard.train, shard.sizes)], minlength=size)
        yield sliced(total, SLICES)

    return count


def windows_of(ids: np.ndarray, end: int) -> np.ndarray:
    """Windows of SPAN + 1 ids that predict each id of a text once; ``end`` stands before the first, as often as the first window needs it."""
    n = -(-len(ids) // SPAN)
    padded = np.concatenate((np.full(n * SPAN + 1 - len(ids), end, np.uint16), ids))
    return np.lib.stride_tricks.sliding_window_view(padded, SPAN + 1)[::SPAN]


def _trained(model, end: int, turn: int):
    def train(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, vocabulary = model.value
        both = np.zeros(2 * SIZE + -2 * SIZE % SLICES, np.int64)
        for shard in _shards(batches):
            windows = [windows_of(ids, end) for ids in shard.texts()]
            if not windows:
                continue
            # a copy's own order of all its windows; the last step is as long as what is left for it
            mixed = np.random.default_rng([turn, shard.name & 0xFFFFFFFF, shard.name >> 32]).permutation(np.concatenate(windows))
            trainer = Trainer(flat, vocabulary)
            for i in range(0, len(mixed), BATCH):
                some = mixed[i : i + BATCH]
                trainer.step(some.astype(np.int64), len(some) / BATCH)
            delta, moved = trainer.change()
            both[:SIZE] += np.rint(delta.astype(np.float64) * (len(mixed) * GRAIN)).astype(np.int64)
            both[SIZE : 2 * SIZE] += moved * len(mixed)
        yield sliced(both, SLICES)

    return train


def fit(shards: DataFrame, sub: Subwords, rounds: int) -> tuple[np.ndarray, Vocabulary]:
    """Weights and vocabulary from all training texts of ``shards``: every round goes over all their ids."""
    size = -(-sub.size // SLICES) * SLICES
    counts = summed(shards.mapInArrow(_counted(size), SLICED), SLICES, size, np.int64)[: sub.size]
    vocabulary = Vocabulary(counts, sub.starts)
    flat = initial(vocabulary)
    for turn in range(rounds):
        model = shards.sparkSession.sparkContext.broadcast((flat, vocabulary))
        both = summed(shards.mapInArrow(_trained(model, sub.end, turn), SLICED), SLICES, 2 * SIZE + -2 * SIZE % SLICES, np.int64)
        flat = (flat + both[:SIZE] / GRAIN / np.maximum(both[SIZE : 2 * SIZE], 1)).astype(np.float32)
    return flat, vocabulary


def _asked(tokenizer: str, buckets: int):
    def report(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = subwords(tokenizer).starts
        for shard in _shards(batches):
            _, doc, hashes = shard.words(starts)
            own, which = distinct(hashes)
            count = np.bincount(which, weights=shard.train[doc], minlength=len(own)).astype(np.uint32)
            at = cuts(own, buckets)
            # every bucket is asked, if only for its totals
            arrays = [
                pa.array(range(buckets), pa.int32()),
                pa.array([shard.name] * buckets, pa.int64()),
                pa.array([own[i:j].tobytes() for i, j in zip(at[:-1], at[1:])], pa.binary()),
                pa.array([count[i:j].tobytes() for i, j in zip(at[:-1], at[1:])], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["bucket", "shard", "hashes", "counts"])

    return report


def _told(table: pa.Table) -> pa.Table:
    parts = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
    counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.uint32)
    every, which = distinct(np.concatenate(parts))
    total = np.bincount(which, weights=counts, minlength=len(every)).astype(np.int64)
    ends = np.cumsum([0, *(len(p) for p in parts)])
    reply = total[which]
    return pa.table(
        {
            "shard": table.column("shard"),
            "bucket": table.column("bucket"),
            "answer": pa.array([reply[i:j].tobytes() for i, j in zip(ends[:-1], ends[1:])], pa.binary()),
            "tokens": pa.array([int(total.sum())] * len(parts), pa.int64()),
            "kinds": pa.array([int((total > 0).sum())] * len(parts), pa.int64()),
        }
    )


def mixed_score(shard: Shard, scorer: Scorer, starts: np.ndarray, end: int, counts: np.ndarray, tokens: int, kinds: int) -> np.ndarray:
    """log10 probability of each word of a shard, ``counts`` being that of each word among ``tokens`` training tokens of ``kinds``.

    The attention model's part of a word: its ids' probabilities, the first
    one given that a word begins, times the probability that after it another
    begins (nothing follows the end).  Over all words these sum to 1, as do
    their shares of the mixture, so a text's score is a log probability.
    """
    first = np.flatnonzero(starts[shard.ids])
    logs, begins = scorer.texts(shard.ids, shard.sizes, end)
    logs, begins = logs.astype(np.float64), begins[first].astype(np.float64)
    logs[first] -= begins
    value = np.add.reduceat(logs, first) if len(first) else logs
    last = shard.ids[first] == end
    value[~last] += begins[np.flatnonzero(~last) + 1]
    share = WEIGHT if tokens else 0.0
    left = 1 - share * (1 - DISCOUNT * kinds / max(tokens, 1))
    with np.errstate(divide="ignore"):
        counted = np.log(share * np.maximum(counts - DISCOUNT, 0) / max(tokens, 1))
    return np.logaddexp(counted, np.log(left) + value) / np.log(10)


def _scored(tokenizer: str, model, buckets: int):
    kept: dict[str, Scorer] = {}

    def score(table: pa.Table, told: pa.Table) -> pa.Table:
        if not kept:
            kept[""] = Scorer(*model.value)
        sub, shard = subwords(tokenizer), Shard(table)
        _, doc, hashes = shard.words(sub.starts)
        own, which = distinct(hashes)
        c = answers(told, own, buckets, np.int64)[which]
        tokens, kinds = (int(np.sum(told.column(x).to_numpy())) for x in ("tokens", "kinds"))
        docs = len(shard.docs)
        base = np.bincount(doc, weights=np.log10((c + 1) / (tokens + kinds + 1)), minlength=docs)
        value = mixed_score(shard, kept[""], sub.starts, sub.end, c, tokens, kinds)
        return pa.table(
            {
                "doc_id": pa.array(shard.docs, pa.int64()),
                "held_out": pa.array(~shard.train),
                "n_tokens": pa.array(np.bincount(doc, minlength=docs), pa.int64()),
                "n_known": pa.array(np.bincount(doc[c > 0], minlength=docs), pa.int64()),
                "train_tokens": pa.array([tokens] * docs, pa.int64()),
                "base_score": pa.array(base),
                "score": pa.array(np.bincount(doc, weights=value, minlength=docs)),
            }
        )

    return score


def shards_of(docs: DataFrame, tokenizer: str, modulus: int, remainder: int) -> DataFrame:
    """The ids of all ``docs`` (doc_id, text), staged as shards of about SHARD_BYTES of text."""
    blocks = max(1, -(-text_bytes(docs) // SHARD_BYTES))
    spelled = docs.mapInArrow(_spelled(tokenizer, modulus, remainder), SPELLED).withColumn("tie", F.xxhash64("ids"))
    rows = dealt(spelled, blocks, ["doc_id", "tie"]).sortWithinPartitions("block", "doc_id", "tie")
    return staged(rows.select("block", "doc_id", "train", "ids").mapInArrow(_gathered, SHARDS), "shards")


def score_texts(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    modulus: int = 7,
    remainder: int = 2,
    rounds: int = 2,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``.

    Rows whose crc32(id as text) mod ``modulus`` is ``remainder`` are held out;
    all others train.  A text is its words, ASCII letters lower-cased, and one
    end.  base_score: the sum of log10((c + 1) / (N + V + 1)), c the count of
    the word in training texts, N all and V distinct training tokens; n_known
    counts tokens with c > 0.  score: the model's log10 probability of the
    text, the same however the rows are partitioned.  Each token's probability
    mixes its discounted share of the training tokens with the attention
    model's probability of its spelling in subwords of ``tokenizer`` (a
    byte-level BPE file without end-of-word mark).  A null text is empty and
    has only its end; a null id hashes as the empty text.  Ids may repeat;
    every row comes back.  Without training rows N and V are 0.  Other columns
    are ignored.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    shards = shards_of(source, tokenizer, modulus, remainder)
    model = spark.sparkContext.broadcast(fit(shards, Subwords(tokenizer), rounds))

    buckets = parts_for(spark, text_bytes(source) // 3, BUCKET_BYTES)
    asked = shards.mapInArrow(_asked(tokenizer, buckets), "bucket int, shard long, hashes binary, counts binary")
    told = asked.groupBy("bucket").applyInArrow(_told, "shard long, bucket int, answer binary, tokens long, kinds long")
    return shards.groupBy("shard").cogroup(told.groupBy("shard")).applyInArrow(
        _scored(tokenizer, model, buckets),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
