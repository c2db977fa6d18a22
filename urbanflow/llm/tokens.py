"""Token ids and counts of the byte-level BPE files of the tokenizers library, through caches of whole words.

The library needs about ten microseconds a word.  Text without odd characters
can be cut at spaces into parts that the split pattern never joins to a
neighbour, so a part has the same ids wherever it stands and a dictionary
answers for it.  New parts are merged by tiktoken from ranks read out of the
same file.  Texts that hold a special token's string or a character outside
the checked range go to the library itself.
"""

from __future__ import annotations

import json
import re
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import compress
from operator import not_

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

# Separators that are no white space for every library, and all characters past Latin Extended-B but common punctuation.
# As (first, last) code points.
_ODD = [(0, 8), (0xE, 0x1F), (0x7F, 0xA0), (0xAD, 0xAD), (0x130, 0x130), (0x250, 0x200F), (0x2028, 0x202F), (0x205F, 0x20AB), (0x20AD, 0x10FFFF)]
ODD = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in _ODD) + "]")
# White space before a space: the pattern then looks further than one part.
LOOSE = re.compile("[\t-\r ] ")
END = b"\xff"  # never a byte of UTF-8: stands for the end-of-word mark


def byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of one tokenizer file; ``suffix`` is its end-of-word mark, if it has one."""

    #: Entries of a worker's cache.  When it is full, that of counts starts anew; that of words becomes the old
    #: generation, so the words not seen for longest go.
    ROOM = 150_000

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, self.suffix = byte_letters(), spec["model"]["end_of_word_suffix"] or ""
        ranks = {}
        for token, i in spec["model"]["vocab"].items():
            ends = self.suffix and token.endswith(self.suffix)
            body = token[: -len(self.suffix)] if ends else token
            ranks[bytes(letters[c] for c in body) + END * bool(ends)] = i
        self.special = [t["content"] for t in spec["added_tokens"]]
        if self.suffix:
            pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        else:
            pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.pattern = regex.compile(pattern)
        self.merges = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.counts: dict[str, int] = {}
        self.words: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}
        self.merge = self.merges._core_bpe.encode_single_piece

    def plain(self, text: str) -> bool:
        return not (any(s in text for s in self.special) or ODD.search(text))

    # A file without end-of-word mark: a part is a space and what follows up to the next space.

    def part_tokens(self, part: str) -> int:
        n = self.counts.get(part)
        if n is None:
            if len(self.counts) >= self.ROOM:
                self.counts.clear()
            n = self.counts[part] = len(self.merges.encode_ordinary(" " + part))
        return n

    def count(self, text: str, frequent: dict[str, int]) -> int:
        """The number of tokens of a text; ``frequent`` answers first, then the worker's cache."""
        if not self.plain(text):
            return len(self.library.encode(text, add_special_tokens=False).ids)
        if LOOSE.search(text):
            return len(self.merges.encode_ordinary(text))
        head, *parts = text.split(" ")
        found = list(map(frequent.get, parts))
        missed = compress(parts, map(not_, found))
        return len(self.merges.encode_ordinary(head)) + sum(filter(None, found)) + sum(map(self.part_tokens, missed))

    # A file with end-of-word mark: lower case, white space only separates.

    def word_ids(self, word: str) -> bytes:
        low = word.lower()
        if low.isalpha():  # one piece
            return array("I", self.merge(low.encode() + END)).tobytes()
        return array("I", [i for piece in self.pattern.findall(low) for i in self.merge(piece.encode() + END)]).tobytes()

    def ids(self, text: str) -> bytes:
        """The ids of a text, each as four little-endian bytes."""
        if not self.plain(text):
            return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        words = text.split()
        found = list(map(self.words.get, words))
        missed, i = found.count(None), -1
        for _ in range(missed):
            i = found.index(None, i + 1)
            w = words[i]
            ids = self.words.get(w)
            if ids is None:
                ids = self.old_words.get(w)
                self.words[w] = ids = self.word_ids(w) if ids is None else ids
            found[i] = ids
        if len(self.words) > self.ROOM:
            self.old_words, self.words = self.words, {}
        return b"".join(found)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a file, with its caches."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _strings(column: pa.Array) -> list[str]:
    return ["" if x is None else x for x in column.to_pylist()]


def _heads(most: int, room: int):
    def report(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for text in _strings(batch.column(0)):
                seen.update(text.split(" ")[1:])
                if len(seen) > room:
                    seen = Counter(dict(seen.most_common(room // 2)))
        top = [(p, n) for p, n in seen.most_common(most) if p and len(p) < 64]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["part", "n"]
        )

    return report


def frequent_parts(docs: DataFrame, text_col: str, size: int, most: int = 8192, room: int = 200_000) -> list[str]:
    """About the ``size`` most frequent parts of all texts.

    Each task reports its own ``most`` most frequent ones, so what moves is
    bounded by the number of tasks.  The list only decides what is looked up
    first, never a result.
    """
    heads = docs.select(text_col).mapInArrow(_heads(most, room), "part string, n long")
    top = heads.groupBy("part").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "part").limit(size)
    return [r.part for r in top.collect()]


def pack_table(parts: list[str], lengths: list[int]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """A table of part lengths as one binary, offsets and lengths."""
    raw = [p.encode() for p in parts]
    return b"".join(raw), np.cumsum([0, *map(len, raw)], dtype=np.int32), np.array(lengths, np.uint16)


def unpack_table(table: tuple[bytes, np.ndarray, np.ndarray]) -> dict[str, int]:
    blob, at, lengths = table
    return {blob[i:j].decode(): n for i, j, n in zip(at[:-1].tolist(), at[1:].tolist(), lengths.tolist())}


_tables: dict[str, dict[str, int]] = {}


def token_counts(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512, table_size: int = 32768
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs``.

    Tokens are those of the tokenizers library for the whole text, nothing
    added; ``tokenizer`` is the path of a byte-level BPE file without
    end-of-word mark.  over_limit: n_tokens > limit.  A null text counts as
    empty.  Ids may be null or repeat; every row comes back.  Other columns are
    ignored.  Nothing is shuffled but the tasks' bounded reports of frequent
    parts: first a broadcast table of at most ``table_size`` parts answers,
    then the worker's cache.
    """
    local = Encoder(tokenizer)
    if local.suffix:
        raise ValueError("token_counts takes files without end-of-word mark; see packing for the others")
    parts = frequent_parts(docs, text_col, table_size)
    parts = [p for p in parts if local.plain(p) and not LOOSE.search(p)]
    packed = pack_table(parts, [local.part_tokens(p) for p in parts])
    table = docs.sparkSession.sparkContext.broadcast(packed)
    name = f"{tokenizer}:{hash(packed[0])}"

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        if name not in _tables:
            _tables.clear()
            _tables[name] = unpack_table(table.value)
        frequent = _tables[name]
        for batch in batches:
            texts = _strings(batch.column(1))
            n = pa.array([enc.count(t, frequent) for t in texts], pa.int64())
            size = pa.array([len(t) if t.isascii() else len(t.encode()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), size, n, pa.compute.greater(n, limit)],
                                             ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
