"""Encoding and decoding with SentencePiece models, on the tokenizers library.

The model file is read as a protobuf.  From it are rebuilt: the normaliser,
the white-space marker, the pieces with their scores (a unigram model, or a
BPE model whose merges follow from the scores), byte fallback, and the
decoder.  Texts are encoded by their parts: no piece has the marker after
another character, so a part, a marker and what follows up to the next one,
has the same ids wherever it stands.  Each worker encodes the new parts of a
batch together, on several threads, and has SentencePiece itself encode them
too; a text is in parity if all its parts are.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterable, Iterator
from itertools import compress
from operator import not_

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)
UNIGRAM, BPE = 1, 2


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message: whole numbers as int, everything else as bytes."""
    at = 0

    def number() -> int:
        nonlocal at
        shift = value = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(kind)
        if size is None:
            size = number()
        yield key >> 3, data[at : at + size]
        at += size


class Model:
    """What a model file says: pieces (text, score, kind), model type and normaliser settings."""

    def __init__(self, data: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        self.kind, self.charsmap = UNIGRAM, b""
        self.prefix = self.squeeze = self.escape = True
        for number, value in fields(data):
            if number == 1:
                piece = dict(fields(value))
                score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                self.pieces.append((piece[1].decode(), score, piece.get(3, NORMAL)))
            elif number == 2:
                self.kind = dict(fields(value)).get(3, UNIGRAM)
            elif number == 3:
                spec = dict(fields(value))
                self.charsmap = spec.get(2, b"")
                self.prefix, self.squeeze, self.escape = (bool(spec.get(n, 1)) for n in (3, 4, 5))
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models can be rebuilt")
        self.unknown = next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)
        self.bytes = any(p[2] == BYTE for p in self.pieces)

    def merges(self) -> list[tuple[str, str]]:
        """Every way to make a piece of two, best score first."""
        plain = {text: score for text, score, kind in self.pieces if kind in (NORMAL, USER)}
        pairs = [
            (-score, len(text), i, text)
            for text, score in plain.items()
            for i in range(1, len(text))
            if text[:i] in plain and text[i:] in plain
        ]
        return [(text[:i], text[i:]) for _, _, i, text in sorted(pairs)]

    def separable(self) -> bool:
        """Whether a marker can only begin a piece or follow a marker, so that texts may be cut before it."""
        return self.prefix and self.escape and not self.squeeze and not self.charsmap and not any(
            MARK in text.lstrip(MARK) for text, _, kind in self.pieces if kind in (NORMAL, USER)
        )

    def tokenizer(self):
        from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

        if self.kind == BPE:
            vocab = {text: i for i, (text, _, _) in enumerate(self.pieces)}
            unknown = self.pieces[self.unknown][0]
            model = models.BPE(vocab=vocab, merges=self.merges(), unk_token=unknown, fuse_unk=True, byte_fallback=self.bytes)
        else:
            scores = [(text, score) for text, score, _ in self.pieces]
            model = models.Unigram(scores, self.unknown, self.bytes)
        out = Tokenizer(model)
        steps = [normalizers.Precompiled(self.charsmap)] if self.charsmap else []
        if self.squeeze:
            steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
        if self.prefix:
            steps.append(normalizers.Prepend(" "))
        if self.escape:
            steps.append(normalizers.Replace(" ", MARK))
        out.normalizer = normalizers.Sequence(steps)
        end = [decoders.Strip(" ", 1, 0)] if self.prefix else []
        out.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *end])
        users = [AddedToken(text, normalized=False) for text, _, kind in self.pieces if kind == USER]
        if users:
            out.add_tokens(users)
        return out


# Printable ASCII and the letters of Latin-1: no normaliser changes them.
PLAIN = re.compile("[!-~\u00c0-\u00ff]+")


class Recent(dict):
    """What was worked out lately, in two generations: a full one becomes the old one, so the entries not used for longest go."""

    def __init__(self, room: int):
        super().__init__()
        self.room, self.old = room, {}

    def missing(self, keys: Iterable) -> list:
        """The keys that nobody has worked out; those of the old generation move to the new one."""
        if len(self) > self.room:
            self.old = dict(self)
            self.clear()
        out = []
        for key in set(keys).difference(self):
            found = self.old.get(key)
            if found is None:
                out.append(key)
            else:
                self[key] = found
        return out


class Codec:
    """A model in a worker, with the ids of the parts it has met and the parts on which the libraries disagree."""

    ROOM = 250_000

    def __init__(self, path: str, threads: int = 2):
        import sentencepiece

        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        with open(path, "rb") as f:
            data = f.read()
        self.model = Model(data)
        self.tokenizer = self.model.tokenizer()
        self.reference = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.cut = self.model.separable()
        self.threads = threads
        self.parts: dict[str, bytes] = Recent(self.ROOM)
        self.differ: set[str] = set()  # parts on which the libraries disagree
        # ids whose piece begins with the space mark
        self.opens = np.array([text[:1] == MARK for text, _, _ in self.model.pieces])

    def whole(self, texts: list[str]) -> list[tuple[bytes, bool]]:
        """Ids of whole texts, and parity; where the libraries differ SentencePiece's own ids count."""
        ours = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        theirs = self.reference.encode(texts, num_threads=self.threads)
        return [(np.array(b, np.uint32).tobytes(), a == b) for a, b in zip(ours, theirs)]

    def lines(self, parts: list[str], each: int = 256) -> list[tuple[bytes, bool]]:
        """Ids and parity of parts, encoded many to a line with spaces between them, and cut again at the space marks.

        Both libraries encode each line.  A line whose marks are not as many as
        its parts is encoded part by part.
        """
        groups = [parts[a : a + each] for a in range(0, len(parts), each)]
        joined = [" ".join(g) for g in groups]
        ours = [x.ids for x in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)]
        theirs = self.reference.encode(joined, num_threads=self.threads)
        out: list[tuple[bytes, bool]] = []
        for group, pair in zip(groups, zip(ours, theirs)):
            cut = []
            for ids in pair:
                blob = np.array(ids, np.uint32)
                at = (np.flatnonzero(self.opens[blob]) * 4).tolist()
                blob = blob.tobytes()
                cut.append([blob[a:b] for a, b in zip(at, [*at[1:], len(blob)])] if at[:1] == [0] else [])
            if len(cut[0]) == len(cut[1]) == len(group):
                out += [(b, a == b) for a, b in zip(*cut)]
            else:
                out += self.whole(group)
        return out

    def encode(self, texts: list[str]) -> list[tuple[bytes, bool]]:
        out: list[tuple[bytes, bool]] = [(b"", True)] * len(texts)
        cut, odd = [], []
        for i, text in enumerate(texts):
            # runs of spaces and literal markers depend on what surrounds them
            plain = self.cut and "  " not in text and text[:1] != " " and text[-1:] != " " and MARK not in text and "\0" not in text
            (cut if plain and text else odd if text else []).append(i)
        for i, got in zip(odd, self.whole([texts[i] for i in odd]) if odd else []):
            out[i] = got
        split = [texts[i].split(" ") for i in cut]
        found = [list(map(self.parts.get, parts)) for parts in split]
        new = self.parts.missing(p for parts, got in zip(split, found) for p in compress(parts, map(not_, got)))
        for a in range(0, len(new), 20_000):
            some = new[a : a + 20_000]
            plain = list(map(PLAIN.fullmatch, some))
            easy, hard = ([p for p, m in zip(some, plain) if bool(m) == want] for want in (True, False))
            for group, coded in ((easy, self.lines(easy)), (hard, self.whole(hard) if hard else [])):
                self.parts.update(zip(group, (ids for ids, _ in coded)))
                self.differ.update(p for p, (_, same) in zip(group, coded) if not same)
        for i, parts, got in zip(cut, split, found):
            at = -1
            for _ in range(got.count(None)):
                at = got.index(None, at + 1)
                got[at] = self.parts[parts[at]]
            out[i] = b"".join(got), self.differ.isdisjoint(parts) if self.differ else True
        return out

    def decode(self, ids: list[bytes]) -> list[str]:
        return self.tokenizer.decode_batch([np.frombuffer(x, np.uint32).tolist() for x in ids], skip_special_tokens=False)


_codecs: dict[str, Codec] = {}


def codec(path: str, threads: int) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec(path, threads)
    return _codecs[path]


def _groups(column: pa.Array, limit: int = 1 << 21) -> Iterator[tuple[int, int]]:
    sizes = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_pylist()
    i = total = 0
    for j, size in enumerate(sizes):
        if total and total + size > limit:
            yield i, j
            i, total = j, 0
        total += size
    if i < len(sizes):
        yield i, len(sizes)


def encode_texts(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", threads: int = 2) -> DataFrame:
    """(doc_id, ids, parity) for every row of ``docs``: SentencePiece ids as packed little-endian 32-bit numbers.

    ``model`` is the path of a model file.  parity says whether the rebuilt
    tokenizer and SentencePiece agree; where they don't (long runs of spaces,
    whose pieces share one score) ids are SentencePiece's.  A null or empty text has no ids.  Ids
    may be null or repeat; every row comes back.  Other columns are ignored.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model, threads)
        for batch in batches:
            for i, j in _groups(batch.column(1)):
                part = batch.slice(i, j - i)
                got = own.encode(["" if t is None else t for t in part.column(1).to_pylist()])
                arrays = [part.column(0), pa.array([g[0] for g in got], pa.binary()), pa.array([g[1] for g in got])]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "ids", "parity"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, "doc_id long, ids binary, parity boolean")


def decode_ids(encoded: DataFrame, model: str, ids_col: str = "ids", threads: int = 2) -> DataFrame:
    """``encoded`` with the column text: what its packed ids stand for.  Null ids give null, no ids the empty text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model, threads)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids_col))
            for i, j in _groups(column):
                part = batch.slice(i, j - i)
                ids = column.slice(i, j - i).to_pylist()
                texts = own.decode([x or b"" for x in ids])
                texts = pa.array([None if x is None else t for x, t in zip(ids, texts)], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, texts], [*part.schema.names, "text"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.drop("text").schema)
    return encoded.drop("text").mapInArrow(run, f"{kinds}, text string")
