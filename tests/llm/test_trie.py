"""The conversation trie against sets of whole prefixes in plain Python."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from urbanflow.llm.prefix_trie import numbered, prefix_trie, rebuilt, trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def ordered(rows):
    """Sequences of (role, text) by conversation; equal turns by the digest the docstring names."""

    def key(row):
        _, turn, role, text = row
        sha = hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).hexdigest()[:32]
        return (turn is not None, turn or 0, sha)

    out = defaultdict(list)
    for row in sorted((r for r in rows if r[0] is not None), key=key):
        out[row[0]].append((row[2] or "", row[3] or ""))
    return out


def regrown(seqs):
    out = {}
    for c, own in seqs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = seqs.get(base, [])[:h] + own[h:]
    return out


def brute(seqs):
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, convs in members.items():
        value = (len(convs) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += value
    rows = []
    for p, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(seqs[c]) == len(p))
        above = min(members[p[:-1]]) if p else None
        rows.append((min(convs), len(p), above, len(convs), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(rows)


def conversations(seed):
    """Shared beginnings at every depth, a long conversation and its copies, odd ids, nulls, ties and repeated rows."""
    rng = random.Random(seed)
    rows = []
    for c in [*range(-12, 40), 10**12, 10**12 + 3]:
        for t in range(rng.randint(0, 12)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["", "a", "bé", "日本", None, "long " * 50])))
    body = [("user", f"turn {t % 7}") for t in range(150)]
    for c, n in ((101, 150), (102, 150), (103, 97), (104, 33), (105, 32), (106, 64), (107, 65), (108, 150)):
        rows += [(c, t, r, x + "!" * (c == 108 and t == 100)) for t, (r, x) in enumerate(body[:n])]
    rows += [(200, None, "user", "first"), (200, 1, "user", "x"), (200, 1, "assistant", "x"), (200, 1, "user", "x"), (200, 5, None, None)]
    rows += [(None, 0, "user", "no id"), (201, None, None, None), (201, None, None, None), (207, 0, "user", "alone")]
    rng.shuffle(rows)
    return rows


KINDS = "conv_id long, turn long, role string, text string"


def frame(spark, rows):
    df = spark.createDataFrame(rows, KINDS)
    return df.selectExpr("*", "1 as pos", "2 as conv", "'x' as x", "3 as b", "'n' as name", "4 as size").repartition(5)


@pytest.mark.parametrize("height", [1, 4, 32])
def test_prefix_trie(spark, height):
    rows = conversations(height)
    found = prefix_trie(frame(spark, rows), height=height)
    assert found.columns == COLUMNS
    assert Counter(map(tuple, found.collect())) == brute(ordered(rows))


def test_rebuilt(spark):
    rows = conversations(77)
    found = trie(*rebuilt(numbered(frame(spark, rows))), height=4)
    expected = regrown(ordered(rows))
    assert any(not s for s in expected.values())  # some have no turns left
    assert Counter(map(tuple, found.collect())) == brute(expected)


def test_numbered_across_parts(spark, monkeypatch):
    """One conversation over many parts, with null and equal turns, keeps counting."""
    monkeypatch.setattr("urbanflow.llm.prefix_trie.PART_BYTES", 512)
    rows = [(7, t // 3 if t % 5 else None, "u", str(t % 11)) for t in range(400)] + [(c, 0, "u", "x") for c in range(30)]
    got = defaultdict(list)
    for r in numbered(frame(spark, rows)).collect():
        got[r.conv].append((r.pos, r.size, r.x))
    want = ordered(rows)
    assert set(got) == set(want)
    for c, turns in got.items():
        assert [p for p, _, _ in sorted(turns)] == list(range(1, len(want[c]) + 1))
        assert [s for _, s, _ in sorted(turns)] == [len(t.encode()) for _, t in want[c]]


def test_long_ends(spark, monkeypatch):
    """A node where very many conversations end is hashed from many chunks."""
    monkeypatch.setattr("urbanflow.llm.prefix_trie.CHUNK", 10)  # read by the driver
    rows = [(c, 0, "user", "same") for c in range(3000)]
    found = prefix_trie(spark.createDataFrame(rows, KINDS))
    assert Counter(map(tuple, found.collect())) == brute(ordered(rows))


def test_no_rows(spark):
    out = prefix_trie(spark.createDataFrame([], KINDS))
    assert out.columns == COLUMNS and out.collect() == []
    assert trie(*rebuilt(numbered(spark.createDataFrame([(None, 1, "a", "b")], KINDS)))).collect() == []
