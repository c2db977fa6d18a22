"""Near duplicates and repeated passages against brute force."""

from collections import defaultdict

import numpy as np
import pytest

from urbanflow.llm.components import components
from urbanflow.llm.near_duplicates import near_duplicates
from urbanflow.llm.substring_dedup import COVERS, remove_repeats
from urbanflow.llm.superminhash import EMPTY, _draw, signatures


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()


def test_signatures_equal_the_walk_of_each_element():
    rng = np.random.default_rng(1)
    h, first, m = rng.integers(0, 2**63, 300, dtype=np.uint64), np.array([0, 0, 1, 9, 300]), 20
    expected = np.full((4, m), EMPTY, np.uint64)
    for d in range(4):
        for e in h[first[d] : first[d + 1]]:
            perm = list(range(m))
            for j in range(m):
                r, k = _draw(np.array([e], np.uint64), j, m)
                k = int(k[0])
                perm[j], perm[k] = perm[k], perm[j]
                expected[d, perm[j]] = min(expected[d, perm[j]], r[0] | np.uint64(j << 32))
    assert (signatures(h, first, m) == expected).all()


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(2)
    h = rng.integers(0, 2**63, 1200, dtype=np.uint64)
    both = np.concatenate((h[:1000], h[200:]))
    a, b = signatures(both, np.array([0, 1000, 2000]), 512)
    assert abs((a == b).mean() - 800 / 1200) < 0.08


def test_components(spark):
    chain = [(i, i + 1) for i in range(10, 60)] + [(100, 102), (102, 101), (7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "x long, y long").repartition(8)).collect()}
    assert got == {**{i: 10 for i in range(10, 61)}, 100: 100, 101: 100, 102: 100, 7: 7}


@pytest.mark.parametrize("block", [256, 2])
def test_near_duplicates(docs, corpus, block):
    texts = defaultdict(set)
    for i, t in corpus:
        if i is not None and shingles(t):
            texts[i].add(frozenset(shingles(t)))
    parent = {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in texts:
        for j in texts:
            if i < j and any(100 * len(a & b) >= 85 * len(a | b) for a in texts[i] for b in texts[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    rows = near_duplicates(docs, block=block).collect()
    expected = sorted((i is None, i or 0, len(shingles(t)), None if i is None else root(i) if i in texts else i) for i, t in corpus)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in rows) == expected
    assert all(r.kept == (None if r.doc_id is None else r.doc_id == r.component_id) for r in rows)


def test_no_rows(no_docs):
    assert near_duplicates(no_docs).collect() == []
    assert remove_repeats(no_docs).collect() == []


def test_covers():
    for v, d in COVERS.items():
        assert {(a - b) % v for a in d for b in d} == set(range(v))


@pytest.mark.parametrize("period", [1, 3, 7])
def test_remove_repeats(docs, corpus, period):
    seen = {}
    for i, t in sorted((r for r in corpus if r[0] is not None), key=lambda r: r[0]):
        w = (t or "").encode().split()
        for j in range(len(w) - 12):
            seen.setdefault(tuple(w[j : j + 13]), i)
    expected = []
    for i, t in corpus:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for j in range(len(w) - 12):
            if i is not None and seen[tuple(w[j : j + 13])] < i:
                gone[j : j + 13] = [True] * 13
        expected.append((str(i), len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode(), t is None))
    rows = remove_repeats(docs, period=period, carry=("block", "n")).collect()
    got = [(str(r.doc_id), r.n_words, r.n_removed, b" ".join((r.text or "").encode().split()).decode(), r.text is None) for r in rows]
    assert sorted(got) == sorted(expected)
    assert all(tuple(r.carried) == ("x", 1) for r in rows)
    assert sum(r.n_removed for r in rows) > 1000


def test_untouched_texts_stay_as_they_are(docs, corpus):
    texts = dict(corpus)
    for r in remove_repeats(docs).where("doc_id is not null and n_removed = 0").collect():
        assert r.text == texts[r.doc_id]
