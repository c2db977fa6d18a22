"""The pipeline's stages, and their rows at the smallest size."""

import itertools
import os
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from urbanflow.llm.quality import quality
from urbanflow.llm.queries import ORACLES, QUERIES, TOKENIZERS

SF = "/root/testdata/sf0.001"


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "substring_dedup", "packing"]
    assert {int(q.split("_")[0][2:]) for q in QUERIES} == set(range(1, 14)) and set(ORACLES) <= set(QUERIES)


def test_stages_on_odd_rows(spark, docs, tmp_path):
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = docs.selectExpr("doc_id", "text", "'en' as lang", "'s' as source", "cast(length(text) as long) as n_chars")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in rows.select("doc_id").collect()}
        rows = stage(spark, rows, str(tmp_path)).cache()
        assert rows.columns == list(corpus_pipeline.COLUMNS)
        assert {r.doc_id for r in rows.select("doc_id").collect()} <= before
        assert rows.where("n_chars <> length(text)").count() == 0
        assert corpus_pipeline.packing(spark, rows.limit(0), str(tmp_path)).collect() == []
    kept = {r.doc_id for r in rows.collect()}
    assert {0, None} <= kept and not {200, 201, 202, 203, 207, 208} & kept


def test_near_dedup_at_four_fifths(spark, tmp_path):
    """Pairs of 100 shingles: 89 of 111 in common (0.802) are near duplicates, 88 of 112 (0.786) are not."""
    rows = []
    for i in range(0, 400, 2):
        w = [f"w{i}x{j}" for j in range(104)]
        common = 89 if i % 4 == 0 else 88  # the first common + 4 words make so many shingles
        rows += [(i, " ".join(w)), (i + 1, " ".join(w[: common + 4] + [f"v{i}x{j}" for j in range(100 - common)]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' as lang", "'s' as source", "length(text) as n_chars")
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, str(tmp_path)).collect()}
    assert kept == {i for i in range(400) if i % 4 != 1}


def words(text, lower=False):
    raw = (text or "").encode()
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in raw) if lower else raw
    return re.findall(rb"[^\x20\x09-\x0D]+", raw)


def base_failed(text):
    w = words(text)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    often = Counter(windows)
    covered = {i + j for i, x in enumerate(windows) if often[x] > 1 for j in range(8)}
    return len(w) < 20 or 100 * len(covered) > 30 * len(w)


def least_of_group(docs):
    """The least id of each group of documents linked at a similarity of 0.8, by comparing all pairs."""
    sets = {}
    for i, text in docs.items():
        w = words(text, lower=True)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    group = {i: i for i in docs}

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for a, b in itertools.combinations(sorted(docs), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((top(a), top(b)))
            group[y] = x
    return {i for i in docs if top(i) == i}


def without_repeats(docs):
    """Texts without words of 13-word windows that start in a document of a smaller id too."""
    first = {}
    for i in sorted(docs):
        w = words(docs[i])
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k : k + 13]), i)
    out = {}
    for i, text in docs.items():
        w = words(text)
        gone = {k + j for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for j in range(13)}
        out[i] = [x for k, x in enumerate(w) if k not in gone]
    return {i: kept for i, kept in out.items() if kept or not words(docs[i])}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_stages_against_brute_force(spark):
    """Every stage on what its predecessor kept, its ids and texts against plain Python; the model's verdicts alone are taken as given."""
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    verdict = {r.doc_id: r.kept for r in quality(documents, labels).collect()}
    steps, rows = {}, documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, SF).cache()
        steps[name] = {r.doc_id: r.text for r in rows.collect()}
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert steps["quality_rules"] == {i: t for i, t in texts.items() if verdict[i]}
    assert not any(base_failed(t) for t in steps["quality_rules"].values()) and any(map(base_failed, texts.values()))
    assert set(steps["near_dedup"]) == least_of_group(steps["quality_rules"])
    assert all(t == texts[i] for i, t in steps["near_dedup"].items())
    expected = without_repeats(steps["near_dedup"])
    assert {i: words(t) for i, t in steps["substring_dedup"].items()} == expected

    library = Tokenizer.from_file(f"{TOKENIZERS}/word_bpe_49k.json")
    pieces = Counter()
    for i, text in steps["substring_dedup"].items():
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[at : at + 4096], np.uint32)
            pieces[i, k, at, len(part), zlib.crc32(part.tobytes())] += 1
    packed = corpus_pipeline.packing(spark, rows, SF).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == pieces


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and len({r.doc_id for r in rows}) <= spark.read.parquet(f"{SF}/documents.parquet").count()
