"""Collocations against counting all phrases in plain Python."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from urbanflow.llm.phrase_mining import _counted, collocations, packed, steps

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, longest, top):
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    often = {p: c for p, c in f.items() if len(p[1]) > 1 and c >= least}
    inside = defaultdict(int)
    for (lang, p), c in often.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                inside[lang, p[i : i + k]] = max(inside[lang, p[i : i + k]], c)
    found = defaultdict(list)
    for (lang, p), a in often.items():
        if inside[lang, p] >= a:
            continue
        cuts = [(1000 * a * total[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        found[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    out = []
    for lang, some in found.items():
        for rank, (score, a, p, left, right) in enumerate(sorted(some)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def texts(seed, n=300):
    rng = random.Random(seed)
    pool = ["a", "b", "C", "der", "Ärger", "naïve", "日本", "x", "y", "z", "the", "of", "'s", "-"]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 40)):
            words.append(rng.choice(pool[: rng.randint(2, len(pool))]))
            if rng.random() < 0.2:
                words += ["New", "York", "city", "hall"][: rng.randint(2, 4)]
            if rng.random() < 0.1:
                words.append(rng.choice([".", ", ", "!?", "\n", "\r\n", "\x0b", "\t", "  ", ";:"]))
        rows.append((rng.choice(["en", "en", "en", "de", None, "und", ""]), " ".join(words)))
    rows += [("en", None), (None, None), ("en", ""), ("de", " \t"), ("en", "..."), ("en", "a a a a a a a a a a a a")]
    rows += [("en", "one two three four five six seven\x1f eight\xa0nine")] * 30  # copies
    rows += [("en", " ".join(rng.choice(pool) for _ in range(20_000)))]  # a long piece
    return rows


@pytest.mark.parametrize("least, longest, top, block, bucket", [(5, 5, 2000, 8 << 20, 16 << 20), (3, 4, 7, 500, 300), (1, 2, 50, 3000, 40)])
def test_collocations(spark, least, longest, top, block, bucket):
    rows = texts(least, 60 if least == 1 else 300)
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "lang string, text string, block int")
    df = df.selectExpr("*", "'q' as phrase", "1 as n", "2 as bucket", "3 as i", "4 as f", "5 as kind").repartition(3)
    out = collocations(df, least=least, longest=longest, top=top, block_bytes=block, bucket_bytes=bucket)
    assert out.columns == COLUMNS
    assert sorted(map(tuple, out.collect())) == brute(rows, least, longest, top)


def test_buckets_take_large_ids():
    """Ids beyond 32 bits, reported by one block in four bytes each and by another in eight."""
    big = 1 << 40
    rows = []
    for block, pairs in ((1, [(3, 4, 2), (5, 6, 1)]), (2, [(3, 4, 2), (big, 6, 9)])):
        first, last, n = (pa.array(c).to_numpy() for c in zip(*pairs))
        rows.append({"block": block, "bucket": 7, "start": 10 * block, "n": 2, "x": packed(steps(first)), "y": packed(last), "z": packed(n)})
    out = _counted(100, 4)(pa.Table.from_pylist(rows)).to_pylist()
    groups = {(r["first"], r["last"]): (r["id"], r["f"]) for r in out if r["id"] is not None}
    assert groups == {(3, 4): (107, 4), (big, 6): (7, 9)}
    assert [(r["block"], r["start"]) for r in out if r["block"]] == [(1, 10), (2, 20)]


def test_exact_beyond_64_bits(spark):
    """1000 a n passes 64 bits; the score is still the floor of the exact quotient."""
    from urbanflow.llm import phrase_mining

    def fake(*_):
        rows = [(1, "en", "x", 10**11 + 7), (1, "en", "y", 3 * 10**11), (2, "en", "x y", 10**11 + 1)]
        return spark.createDataFrame(rows, "k int, lang string, phrase string, f long"), spark.createDataFrame([("en", 10**13 + 3)], "lang string, n long")

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(phrase_mining, "frequent_phrases", fake)
        row = collocations(spark.range(1)).first()
    assert row.score == 1000 * (10**11 + 1) * (10**13 + 3) // ((10**11 + 7) * 3 * 10**11)


def test_no_rows(spark):
    out = collocations(spark.createDataFrame([], "text string, lang string"))
    assert out.columns == COLUMNS and out.collect() == []
    assert collocations(spark.createDataFrame([(None, None), ("a b", "en")], "text string, lang string")).collect() == []
