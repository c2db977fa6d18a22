"""Windows filled by minimum bin slack, against the tokenizers library and exhaustive search."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from urbanflow.llm.queries import TOKENIZERS
from urbanflow.llm.window_filling import Plan, WordCache, closest, fill_windows

WORD = f"{TOKENIZERS}/word_bpe_49k.json"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD)


def reachable(counts, size):
    sums = {0}
    for n, c in counts.items():
        for _ in range(c):
            sums |= {s + n for s in sums if s + n <= size}
    return sums


def test_closest_is_optimal():
    rng = np.random.default_rng(8)
    for _ in range(200):
        counts = dict(Counter(rng.integers(1, 40, rng.integers(1, 10)).tolist()))
        longest = max(counts)
        taken = closest(counts, 64)
        rest = {n: c - (n == longest) for n, c in counts.items()}
        assert taken[longest] >= 1 and all(0 < c <= counts[n] for n, c in taken.items())
        assert sum(n * c for n, c in taken.items()) == longest + max(reachable(rest, 64 - longest))


@pytest.mark.parametrize("kind", ["mixed", "long", "one", "few"])
def test_plan_pads_nothing(kind):
    rng = np.random.default_rng(9)
    lengths = {"mixed": rng.integers(1, 64, 900), "long": rng.integers(40, 64, 300), "one": np.full(500, 45), "few": np.array([5, 9])}[kind]
    counts = Counter(lengths.tolist())
    plan, windows, cut = Plan(counts, 64), defaultdict(list), 0
    for n, c in counts.items():
        for rank in range(c):
            parts = plan.places(n, rank)
            assert sum(p[0] for p in parts) == n
            cut += len(parts) - 1
            for length, window, offset in parts:
                windows[window].append((offset, length))
    short = []
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        if at < 64:
            short.append(at)
    total = int(lengths.sum())
    assert sorted(short) == [1 << b for b in range(6) if total % 64 >> b & 1]
    assert cut <= plan.whole + len(short)
    if kind == "mixed":
        assert plan.whole < plan.windows / 4  # the multisets fill most windows


def test_small_cache(library, corpus):
    cache = WordCache(WORD)
    cache.ROOM = 3
    for _, text in corpus:
        ids = np.frombuffer(cache.ids(text or ""), np.uint32).tolist()
        assert ids == library.encode(text or "", add_special_tokens=False).ids


def test_fill_windows(docs, corpus, library):
    size = 256
    expected = Counter()
    for i, t in corpus:
        expected[(i, *library.encode(t or "", add_special_tokens=False).ids, 2)] += 1
    rows = fill_windows(docs, WORD, size=size).collect()
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length > 0
        pieces[r.doc_id, r.doc_tokens].append((r.start, ids))
        windows[r.sequence_id].append((r.offset, r.length))
    # repeated documents have the same pieces' ids wherever they are cut, so each id is counted with its place
    found, wanted = Counter(), Counter()
    for (doc, n), parts in pieces.items():
        for start, ids in parts:
            found.update((doc, n, start + k, x) for k, x in enumerate(ids))
    for (doc, *ids), times in expected.items():
        for k, x in enumerate(ids):
            wanted[doc, len(ids), k, x] += times
    assert found == wanted
    filled = []
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        filled.append(at)
    total = sum(map(len, expected.elements())) - expected.total()
    assert sum(filled) == total and max(filled) == size
    assert sorted(x for x in filled if x < size) == [1 << b for b in range(8) if total % size >> b & 1]


def test_no_rows(no_docs):
    out = fill_windows(no_docs, WORD)
    assert out.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"] and out.collect() == []


def test_size(no_docs):
    with pytest.raises(ValueError):
        fill_windows(no_docs, WORD, size=1000)
