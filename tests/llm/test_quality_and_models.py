"""Quality rules, language model and vector search against brute force and held-out accuracy."""

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from urbanflow.llm import attention, language_model
from urbanflow.llm.language_model import score_texts
from urbanflow.llm.quality import BINS, best_threshold, gram_bins, log_ratios, quality
from urbanflow.llm.queries import TOKENIZERS
from urbanflow.llm.vector_search import Approximation, search, top_k

BYTE = f"{TOKENIZERS}/byte_bpe_50k.json"
NO_LABELS = "doc_id long, quality int, toxic int"


def base(text):
    t = text or ""
    w = t.encode().split()
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    hit = [False] * len(w)
    for i in range(len(w) - 7):
        if seen[tuple(w[i : i + 8])] > 1:
            hit[i : i + 8] = [True] * 8
    failed = len(w) < 20 or 100 * sum(hit) > 30 * len(w)
    return len(w), sum(len(x.decode()) for x in w), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), sum(hit), failed


def test_base_rules(spark, docs, corpus):
    lines = [(300, "a b\na b\n\n \nc # | x\na b"), (301, "é & ü < " * 30)]
    more = docs.select("doc_id", "text", "block").union(spark.createDataFrame(lines, "doc_id long, text string").selectExpr("*", "'x'"))
    rows = quality(more, spark.createDataFrame([], NO_LABELS), carry=("block",)).collect()
    got = [(str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows]
    assert sorted(got) == sorted((str(i), *base(t)) for i, t in [*corpus, *lines])
    assert all(r.kept != r.base_failed and r.carried.block == "x" for r in rows)  # no labels: the base rules decide


def test_held_out_accuracy(spark, words):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(400):
        w = words(rng.randint(30, 120), 3000)
        good = i % 3 > 0
        if not good:
            w = [x.upper() + "!!" for x in w] if i % 2 else [x + rng.choice(["###", "$$$", "|"]) for x in w]
        rows.append((i, " ".join(w)))
        if i < 200:
            labels.append((i, int(good), 0))
    labels += [(None, 1, 0), (5, None, 0), (7, 1, 1)]
    got = quality(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, NO_LABELS)).collect()
    assert all(r.kept == (r.doc_id % 3 > 0) for r in got if r.doc_id >= 200)


def test_scores_do_not_depend_on_the_deal(spark, docs, corpus):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(100)], NO_LABELS)
    one, many = (sorted(map(str, quality(docs.repartition(n), labels).collect())) for n in (1, 7))
    assert one == many


def test_threshold():
    assert best_threshold([(1, 0, 5), (2, 0, 1), (8, 3, 0), (9, 4, 0)]) == 5
    assert best_threshold([(3, 2, 0)]) == np.iinfo(np.int64).min
    assert not log_ratios(np.zeros((2, BINS), np.int64)).any()


def test_gram_bins():
    import pyarrow as pa

    bins, first = gram_bins(pa.array(["abcdef", None, "ab", "", "abcd"]), 4)
    assert first.tolist() == [0, 3, 3, 3, 3, 4] and bins[0] == bins[3] and len(set(bins.tolist())) == 3


def dot(rows, k, picks):
    vectors = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in {i: v for i, v in vectors if picks(i)}.items():
        scored = sorted((-sum(x * y for x, y in zip(a, v)), i) for i, v in vectors if i != q and len(v) == len(a))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_top_k(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(0, 0.2, 12).tolist()) for i in range(600)]
    rows += [(600 + i, rows[0][1]) for i in range(40)]  # ties
    rows += [(700, None), (701, [None] * 12), (702, [math.nan] * 12), (703, [math.inf] * 12), (None, rows[1][1])]
    rows += [(710, [1.0] * 3), (720, [2.0] * 3), (740, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as part", "2 as dim", "3 as ids")
    for block in (4096, 50):
        got = top_k(df, df.where("vec_id % 20 = 0"), k=7, block=block, query_block=9).collect()
        assert sorted(map(tuple, got)) == dot(rows, 7, lambda i: i % 20 == 0)
    none = df.where("vec_id < 0")
    assert top_k(none, none).collect() == [] and top_k(df, none).collect() == [] and top_k(none, df).collect() == []


def test_blocks_of_wide_numbers(spark):
    """Numbers of one to eight bytes, some beyond 32-bit and 64-bit floats, in blocks of their own and together."""
    rng = np.random.default_rng(14)
    rows = [(i, (rng.normal(0, 1, 4) * 10.0 ** (i % 6 * 1.5)).tolist()) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for block in (4096, 20):
        got = top_k(df, df.where("vec_id % 10 = 0"), k=5, block=block, query_block=6).collect()
        assert sorted(map(tuple, got)) == dot(rows, 5, lambda i: i % 10 == 0)


@pytest.mark.parametrize("turn", [False, True])
def test_repeated_query_ids(spark, turn):
    """A null or non-finite twin hides no query; of several usable vectors the least one asks."""
    twins = [(20, None), (20, [0.5, 0.5]), (20, [None, 1.0]), (20, [math.nan, 1.0]), (40, [2.0, 0.0]), (40, [1.0, 9.0])]
    rows = (twins[::-1] if turn else twins) + [(1, [1.0, 0.0]), (2, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    got = {(r.query_id, r.vec_id): r.score for r in top_k(df, df.where("vec_id >= 20"), k=20).where("vec_id < 20").collect()}
    assert got == {(20, 1): 32 * 64, (20, 2): 32 * 64, (40, 1): 64 * 64, (40, 2): 9 * 64 * 64}


def test_large_components():
    exact = np.array([[2**40, 1], [-(2**40), 3], [2**62, 2**62]])
    (scores, ids), = search(np.array([[2**40, 5]]), np.array([7]), exact, np.array([1, 2, 3]), 3)
    assert ids.tolist() == [3, 1, 2] and scores.tolist() == [2**63 - 1, 2**63 - 1, -(2**63)] or scores[1] == 2**63 - 1


def test_bounds_hold():
    rng = np.random.default_rng(10)
    exact, q = rng.integers(-50, 50, (200, 8)), rng.integers(-50, 50, (5, 8)).astype(float)
    corner, more, less = Approximation(exact).bounds(q)
    true = q @ exact.T
    assert (true <= corner + more[:, None]).all() and (true >= corner + less[:, None]).all()


def vocabulary():
    return attention.Vocabulary((1e6 / np.arange(1, 3001) ** 1.3).astype(np.int64), np.arange(3000) % 3 == 0)


def test_attention_sums_to_one():
    voc = vocabulary()
    scorer = attention.Scorer(attention.initial(voc), voc)
    ids = np.arange(3000)
    x = np.tile(np.arange(attention.SPAN) * 37 % 3000, (3000, 1))
    y = np.tile(np.arange(attention.STEP), (3000, 1))
    y[:, 5] = ids
    found, begins = (np.exp(v[:, 5].astype(np.float64)) for v in scorer.windows(x, y))
    assert abs(found.sum() - 1) < 1e-3
    assert np.allclose(begins, found[ids % 3 == 0].sum(), atol=1e-3)


def slow(flat, voc, ids, edge):
    """Log probabilities of a text's ids and of words' beginnings, one id after the other from the formulas."""
    p = {k: v.astype(np.float64) for k, v in attention.unpack(flat).items()}
    d, out = attention.DIM, []
    for t in range(len(ids)):
        begin = t // attention.STEP * attention.STEP - attention.LEAD - 1
        context = [edge if i < 0 else ids[i] for i in range(begin, t)]
        e = p["own"][voc.row[context]]
        q, k, v = np.split(e @ p["asks"], 3, axis=1)
        logits = np.array([q[-1] @ k[i] / d**0.5 + p["far"][len(context) - 1 - i] for i in range(len(context))])
        a = np.exp(logits) / np.exp(logits).sum()
        z = e[-1] + a @ v
        top = np.exp(z @ p["top"] + p["top_bias"])
        g = voc.group[ids[t]]
        log = np.log(top[g] / top.sum())
        if g < attention.GROUPS:
            own = np.exp(z @ p["out"][g] + p["out_bias"][g])
            log += np.log(own[voc.place[ids[t]]] / own.sum())
        else:
            log += voc.inner[ids[t]]
        out.append((log, np.log(top @ voc.opens / top.sum())))
    return np.array(out).T


def test_attention_against_its_formulas():
    voc = vocabulary()
    flat = attention.initial(voc, 3)
    rng = np.random.default_rng(13)
    texts = [rng.integers(0, 3000, n) for n in (1, 24, 70)]
    got = attention.Scorer(flat, voc).texts(np.concatenate(texts), np.array([len(x) for x in texts]), 0, batch=2)
    assert np.allclose(got, np.concatenate([slow(flat, voc, x, 0) for x in texts], axis=1), atol=2e-4)
    # logits far out of a float's range
    wild = attention.Scorer(flat * 40, voc).texts(texts[2], np.array([70]), 0)
    assert np.isfinite(wild).all()


def test_words_sum_to_one():
    """Over all words of three beginnings (0 is the end) and two ids that go on, up to a length, nothing is left but longer words."""
    starts = np.array([True, True, True, False, False])
    voc = attention.Vocabulary(np.array([30, 60, 50, 8, 5]), starts)
    scorer = attention.Scorer(attention.initial(voc, 4), voc)
    words = [[0]] + [[b, *more] for b in (1, 2) for n in range(9) for more in itertools.product((3, 4), repeat=n)]
    known = {(0,): 30, (1,): 20, (2, 3): 10, (1, 4): 1, (2, 3, 3): 4}
    for context in ([], [1], [2, 3, 1, 1, 4, 2] * 6):
        texts = [np.array(context + w + [0] * (w != [0]), np.uint16) for w in words]
        shard = SimpleNamespace(ids=np.concatenate(texts), sizes=np.array([len(t) for t in texts]))
        first = np.flatnonzero(starts[shard.ids])
        at = np.searchsorted(first, np.cumsum(shard.sizes) - shard.sizes + len(context))
        for tokens, kinds in ((0, 0), (sum(known.values()), len(known))):
            counts = np.zeros(len(first), np.int64)
            if tokens:
                counts[at] = [known.get(tuple(w), 0) for w in words]
            total = (10 ** language_model.mixed_score(shard, scorer, starts, 0, counts, tokens, kinds)[at]).sum()
            assert 0.995 < total < 1 + 1e-4


def test_attention_is_causal_and_scores_each_id_once():
    voc = vocabulary()
    scorer = attention.Scorer(attention.initial(voc), voc)
    rng = np.random.default_rng(11)
    ids = [rng.integers(0, 3000, n) for n in (1, 23, 24, 25, 100)]

    def texts(some, batch=512):
        return scorer.texts(np.concatenate(some), np.array([len(x) for x in some]), 0, batch)[0]

    got = texts(ids, 3)
    assert len(got) == sum(map(len, ids))
    changed = ids[4].copy()
    changed[60:] = 5
    assert np.allclose(texts(ids[4:])[:60], texts([changed])[:60], atol=1e-5)
    assert np.allclose(got[-100:], texts(ids[4:]), atol=1e-4)


def test_gradients():
    """Moves along single parameters change the loss as the gradients say."""
    voc = vocabulary()
    flat = attention.initial(voc)
    rng = np.random.default_rng(12)
    windows = np.minimum(rng.zipf(1.4, (8, attention.SPAN + 1)), 2999)

    class Spy(attention.Trainer):
        def _move(self, name, rows, g):
            self.seen[name] = (rows, g)

    spy = Spy(flat, voc)
    spy.seen = {}
    spy.step(windows)
    for name in attention.SHAPES:
        rows, g = spy.seen[name]
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        where = (rows[at[0]], *at[1:]) if isinstance(rows, np.ndarray) else at
        losses = []
        for h in (-2e-2, 2e-2):
            moved = flat.copy()
            attention.unpack(moved)[name][where] += h
            other = Spy(moved, voc)
            other.seen = {}
            losses.append(other.step(windows) * attention.SPAN)  # the gradient is of the sum over a window
        assert (losses[1] - losses[0]) / 4e-2 == pytest.approx(g[at], rel=0.05, abs=1e-3), name


def test_score_texts(docs, corpus):
    train = Counter()
    tokens = defaultdict(list)
    for i, t in corpus:
        w = (t or "").encode().lower().split() + [None]
        tokens[i].append(w)
        if zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2:
            train.update(w)
    n, v = sum(train.values()), len(train)
    rows = score_texts(docs, BYTE).collect()
    assert len(rows) == len(corpus)
    for r in rows:
        assert r.held_out == (zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 7 == 2) and r.train_tokens == n
        options = [(len(w), sum(train[x] > 0 for x in w), sum(math.log10((train[x] + 1) / (n + v + 1)) for x in w)) for w in tokens[r.doc_id]]
        assert any((r.n_tokens, r.n_known) == o[:2] and r.base_score == pytest.approx(o[2]) for o in options)
        assert math.isfinite(r.score) and r.score < 0


class Steps(attention.Trainer):
    """Keeps the windows of all steps."""

    seen: list = []

    def step(self, windows, *share):
        Steps.seen.append(windows)
        return super().step(windows, *share)


def shards(texts):
    """The shards that tasks make of training texts."""
    ids = [language_model.subwords(BYTE).text(t.encode()).tobytes() for t in texts]
    rows = [[7] * len(ids), list(range(len(ids))), [True] * len(ids), ids]
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in rows], ["block", "doc_id", "train", "ids"])
    return list(language_model._gathered([batch]))


def trained(monkeypatch, texts):
    """The windows that a task trains on, and its change of the weights."""
    monkeypatch.setattr(language_model, "Trainer", Steps)
    Steps.seen = []
    sub, made = language_model.subwords(BYTE), shards(texts)
    counts = sum(np.bincount(language_model.Shard(b).ids, minlength=50_257) for b in made)
    voc = attention.Vocabulary(counts, sub.starts)
    model = SimpleNamespace(value=(attention.initial(voc), voc))
    return Steps.seen, list(language_model._trained(model, sub.end, 0)(made))


def test_training_takes_every_id_of_every_text(monkeypatch, words):
    end = language_model.subwords(BYTE).end
    for texts in ([" ".join(words(30_000, 9_000))], *([" ".join(words(n)) for n in (k, 2 * k)] for k in (1, 300, 3_000))):
        ids = np.concatenate([language_model.subwords(BYTE).text(t.encode()) for t in texts])
        seen, out = trained(monkeypatch, texts)
        found = np.concatenate(seen)[:, 1:].reshape(-1)
        assert Counter(found[found != end].tolist()) == Counter(ids[ids != end].tolist())
        assert any(np.frombuffer(x, np.int64).any() for x in out[0].column(1).to_pylist())


def test_a_block_too_large_for_a_shard_is_cut(monkeypatch, words):
    monkeypatch.setattr(language_model, "SHARD_IDS", 500)
    texts = [" ".join(words(50)) for _ in range(40)]
    made = [language_model.Shard(b) for b in shards(texts)]
    assert len(made) > 5 and len({s.name for s in made}) == len(made)
    assert [i for s in made for i in s.docs] == list(range(40))


def test_words_of_a_shard(words):
    texts = ["", "a\u00a0b \u3000 x\u2009", "Straße 日本 don't ½ <|endoftext|>", " ".join(words(80_000, 500))]
    (batch,) = shards(texts)
    shard, sub = language_model.Shard(batch), language_model.subwords(BYTE)
    _, doc, hashes = shard.words(sub.starts)
    expected = [(d, w) for d, t in enumerate(texts) for w in [*t.encode().split(), None]]
    assert doc.tolist() == [d for d, _ in expected]
    pairs = set(zip(hashes.tolist(), (w if w is None else w.lower() for _, w in expected)))
    assert len(pairs) == len({h for h, _ in pairs}) == len({w for _, w in pairs})


def test_scores_do_not_depend_on_the_layout(spark, docs, monkeypatch):
    """Several shards, each with null and repeated ids: the same scores to the bit from one partition and from seven."""
    monkeypatch.setattr(language_model, "SHARD_BYTES", 40_000)
    found = []
    for parts in (1, 7):
        rows = score_texts(docs.select("doc_id", "text").repartition(parts), BYTE, rounds=1).collect()
        found.append(sorted((str(r.doc_id), r.n_tokens, r.score) for r in rows))
    assert found[0] == found[1]


def test_windows_predict_each_id_once():
    for n in (1, 31, 32, 33, 500):
        windows = language_model.windows_of(np.arange(1, n + 1, dtype=np.uint16), 0)
        found = windows[:, 1:].reshape(-1)
        assert found[found > 0].tolist() == list(range(1, n + 1)) and windows[0, 0] == 0


def test_no_rows(spark, no_docs):
    assert quality(no_docs, spark.createDataFrame([], NO_LABELS)).collect() == []
    assert score_texts(no_docs, BYTE, rounds=1).collect() == []
    only_held_out = spark.createDataFrame([(i, "a b") for i in range(20) if zlib.crc32(str(i).encode()) % 7 == 2], "doc_id long, text string")
    rows = score_texts(only_held_out, BYTE, rounds=1).collect()
    assert rows and all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in rows)


def test_words_in_use_outlive_a_full_cache():
    cache, asked = language_model.Subwords(BYTE), []
    one = cache.spell
    cache.ROOM, cache.spell = 10, lambda w: asked.append(w) or one(w)
    for i in range(30):
        text = f"common x{i} it's"
        assert cache.text(text.encode()).tolist() == cache.encoder.merges.encode_ordinary(f" {text}") + [cache.end]
        assert len(cache.words) <= 13
    assert asked.count(b"common") == 1


def test_batches_ask_once_for_each_word(words):
    """Texts of a batch, also of a slice of one, have the ids of each alone, and no word is looked up twice."""
    cache, asked = language_model.Subwords(BYTE), []
    known = cache.known
    cache.known = lambda some: asked.append(some) or known(some)
    odd = ["", " ", "  A  b ", "a\x0bb\x0cc\x1cd\x85e\u2003f\u00a0x", "STRASSE Straße ÀÉ İ don't ½ <|endoftext|> x.", "a\n\n\ta", "日本 日本"]
    texts = pa.array([*odd, *(" ".join(words(200)) for _ in range(30))])
    expected = []
    for t in texts.to_pylist():
        ids = [i for w in t.encode().lower().split() for i in cache.encoder.merges.encode_ordinary(" " + w.decode())]
        expected.append([*ids, cache.end])
    for first in (0, 3):
        found = cache.texts(texts.slice(first))
        assert [np.frombuffer(x, np.uint16).tolist() for x in found] == expected[first:]
    assert all(len(some) == len(set(some)) for some in asked)
    assert cache.texts(texts.slice(0, 0)) == []


def test_distinct_hashes():
    rng = np.random.default_rng(15)
    some = rng.integers(0, 2**64, 300, dtype=np.uint64)
    alike = (some[:150, None] & ~np.uint64(1023)) + np.arange(3, dtype=np.uint64)  # upper bits in common
    for values in (some, alike.reshape(-1), some[:1], some[:0], np.array([0, 2**64 - 1], np.uint64)):
        hashes = rng.choice(values, 3 * len(values)) if len(values) else values
        for got, right in zip(language_model.distinct(hashes), np.unique(hashes, return_inverse=True)):
            assert got.tolist() == right.tolist()
