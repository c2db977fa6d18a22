"""Token counts, packing and the SentencePiece codec against their libraries."""

import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

sentencepiece = pytest.importorskip("sentencepiece")
from tokenizers import Tokenizer  # noqa: E402

from urbanflow.llm.packing import fullest, minimum_slack, pack  # noqa: E402
from urbanflow.llm.queries import TOKENIZERS  # noqa: E402
from urbanflow.llm.sentencepiece_codec import Codec, Model, decode_ids, encode_texts, fields  # noqa: E402
from urbanflow.llm.tokens import Encoder, pack_table, token_counts, unpack_table  # noqa: E402

BYTE, WORD, PIECE = (f"{TOKENIZERS}/{f}" for f in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
ODD = ["", " ", "   ", "\n", "a  b", "  x", " \n x", "x \n", "tab\tx  \n\ny ", "<|endoftext|> a", "a<|startoftext|>b", "İstanbul Σίσυφος Σ",
       "naïve é é x", "don't we'll I'M 12345 ½", "x y", "x y 日本語 の", "a\r\n b", "foo.\nBar baz\n", "\x1f a", "🙂 ok", "ǅ ﬁ ß"]


@pytest.fixture(scope="module")
def byte():
    return Tokenizer.from_file(BYTE)


@pytest.fixture(scope="module")
def word():
    return Tokenizer.from_file(WORD)


def test_odd_texts(byte, word):
    a, b = Encoder(BYTE), Encoder(WORD)
    for text in ODD:
        assert a.count(text, {}) == len(byte.encode(text, add_special_tokens=False).ids), repr(text)
        assert np.frombuffer(b.ids(text), np.uint32).tolist() == word.encode(text, add_special_tokens=False).ids, repr(text)


def test_small_caches_change_nothing(byte, word, corpus):
    a, b = Encoder(BYTE), Encoder(WORD)
    a.ROOM = b.ROOM = 3
    for _, text in corpus[:30]:
        assert a.count(text, {}) == len(byte.encode(text, add_special_tokens=False).ids)
        assert np.frombuffer(b.ids(text), np.uint32).tolist() == word.encode(text, add_special_tokens=False).ids


def test_words_in_use_outlive_a_full_cache(word):
    cache, asked = Encoder(WORD), []
    one = cache.word_ids
    cache.ROOM, cache.word_ids = 10, lambda w: asked.append(w) or one(w)
    for i in range(30):
        text = f"common x{i} y{i}"
        assert np.frombuffer(cache.ids(text), np.uint32).tolist() == word.encode(text, add_special_tokens=False).ids
        assert len(cache.words) <= 12
    assert asked.count("common") == 1


def test_table_round_trip():
    parts = ["the", "naïve", "a\nb", "日"]
    assert unpack_table(pack_table(parts, [1, 3, 2, 300])) == dict(zip(parts, [1, 3, 2, 300]))


@pytest.mark.parametrize("size", [0, 50])
def test_token_counts(docs, corpus, byte, size):
    expected = []
    for i, t in corpus:
        n = len(byte.encode(t or "", add_special_tokens=False).ids)
        expected.append((str(i), len((t or "").encode()), n, n > 512))
    rows = token_counts(docs, BYTE, table_size=size).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in rows) == sorted(expected)


def test_fullest_is_optimal():
    rng = np.random.default_rng(3)
    for _ in range(60):
        counts = dict(Counter(rng.integers(1, 40, 8).tolist()))
        used = fullest(counts, 50)
        seed = max(counts)
        best = {seed}
        for n, c in counts.items():
            for _ in range(c - (n == seed)):
                best |= {s + n for s in best if s + n <= 50}
        assert sum(n * c for n, c in used.items()) == max(best)
        assert seed in used and all(c <= counts[n] for n, c in used.items())


def test_plan_uses_every_piece():
    rng = np.random.default_rng(4)
    counts = dict(Counter(rng.integers(1, 4097, 5000).tolist()))
    plan = minimum_slack(counts, 4096)
    used = Counter()
    for some, times in plan:
        assert sum(n * c for n, c in some.items()) <= 4096
        for n, c in some.items():
            used[n] += c * times
    assert used == counts
    total = sum(n * c for n, c in counts.items())
    assert sum(t for _, t in plan) <= 1.01 * total / 4096 + 1


def test_pack(docs, corpus, word):
    expected = Counter()
    for i, t in corpus:
        ids = word.encode(t or "", add_special_tokens=False).ids + [1]
        for p, at in enumerate(range(0, len(ids), 256)):
            part = np.array(ids[at : at + 256], np.uint32)
            expected[(i, p, at, len(part), zlib.crc32(part.tobytes()))] += 1
    rows = pack(docs, WORD, size=256).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert len(bins) <= sum(r.length for r in rows) / 256 * 1.02 + 1


def test_no_rows(no_docs):
    assert token_counts(no_docs, BYTE).collect() == []
    assert pack(no_docs, WORD).collect() == []
    assert encode_texts(no_docs, PIECE).collect() == []


def test_sentencepiece_parity(docs, corpus):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    texts = defaultdict(set)
    for i, t in corpus:
        texts[i].add(t)
    rows = decode_ids(encode_texts(docs, PIECE), PIECE).collect()
    assert len(rows) == len(corpus)
    for r in rows:
        ids = np.frombuffer(r.ids, np.uint32).tolist()
        assert r.parity and any(ids == library.encode(t or "") and r.text == (t or "") for t in texts[r.doc_id])


def test_odd_sentencepiece_texts():
    codec, library = Codec(PIECE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    texts = [*ODD, "▁ x", "a" + " " * 19 + "b", "<0x0A> <s>"]
    for text, (ids, _) in zip(texts, codec.encode(texts)):
        assert np.frombuffer(ids, np.uint32).tolist() == library.encode(text), repr(text)
    plain = [t for t in texts if "▁" not in t]
    assert codec.decode([i for i, _ in codec.encode(plain)]) == plain


def message(number, value):
    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def test_unigram_model():
    """A hand-written unigram model with byte fallback and squeezed spaces."""
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    pieces += [(p, s, 1) for p, s in {"▁": -3.0, "▁th": -2.5, "e": -3.1, "▁the": -2.0, "r": -4.0, "er": -3.5, "t": -4.5, "h": -4.6}.items()]
    data = b"".join(message(1, message(1, p.encode()) + message(2, s) + message(3, k)) for p, s, k in pieces)
    data += message(2, message(3, 1) + message(35, 1)) + message(3, message(1, b"identity") + message(3, 1) + message(4, 1))
    assert len([1 for n, _ in fields(data) if n == 1]) == len(pieces)
    library, ours = sentencepiece.SentencePieceProcessor(model_proto=data), Model(data).tokenizer()
    for text in ("the", "  there   the ", "ether her", "é the"):
        assert ours.encode(text, add_special_tokens=False).ids == library.encode(text), text
        assert ours.decode(library.encode(text)) == library.decode(library.encode(text))
