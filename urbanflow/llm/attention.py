"""A small causal self-attention model over subword ids, in numpy.

One head of width ``DIM`` over windows of ``SPAN`` ids, with a learned weight for
each distance.  The next id is predicted in two steps: its group, then its
place in the group; groups are ``WIDE`` ids next to each other in the order of
their corpus counts, and all rare ids share a group by their counts.  So
probabilities sum to one, and an id costs a few dozen exponentials.

A group holds either ids that begin a word or ids that go on with one.  So the
probability that the next id begins a word is a sum over groups, known at no
cost, and the probability of a whole word is exact: that of its ids, its first
one given that a word begins, times that of another word beginning after it.
"""

from __future__ import annotations

import numpy as np

DIM = 16
SPAN = 32
#: Ids of a window that only give context; the next window scores on from there.
LEAD = 8
STEP = SPAN - LEAD
GROUPS = 16
WIDE = 64
#: Groups with a table of their own, then those of rare ids: that begin a word, that go on.
ALL_GROUPS = GROUPS + 2
OWN_VECTORS = 2048


class Vocabulary:
    """Groups of ids by corpus counts, log probabilities of rare ids within theirs, and a vector row for frequent ids.

    ``starts``: whether an id begins a word.
    """

    def __init__(self, counts: np.ndarray, starts: np.ndarray):
        size = len(counts)
        order = np.lexsort((np.arange(size), -counts))
        # of the groups with a table, words' beginnings get their share among the most frequent ids
        share = starts[order[: GROUPS * WIDE]].mean() if size else 0
        own = int(np.clip(round(GROUPS * share), 1, GROUPS - 1))
        self.opens = np.zeros(ALL_GROUPS, np.float32)
        self.opens[:own] = self.opens[GROUPS] = 1
        self.group, self.place = np.zeros(size, np.int16), np.zeros(size, np.int16)
        for kind, first, many, rare in ((starts, 0, own, GROUPS), (~starts, own, GROUPS - own, GROUPS + 1)):
            ids = order[kind[order]]
            rank = np.arange(len(ids))
            self.group[ids] = np.where(rank < many * WIDE, first + rank // WIDE, rare)
            self.place[ids] = rank % WIDE
        smooth = counts + 0.5
        total = np.bincount(self.group, weights=smooth, minlength=ALL_GROUPS)
        self.inner = np.log(smooth / total[self.group]).astype(np.float32)
        self.first = np.log((total + 1e-9) / (total.sum() + 1e-9)).astype(np.float32)
        self.within = np.full((GROUPS, WIDE), -100, np.float32)
        some = self.group < GROUPS
        self.within[self.group[some], self.place[some]] = self.inner[some]
        self.row = np.empty(size, np.int16)  # the last row stands for all rare ids
        self.row[order] = np.minimum(np.arange(size), OWN_VECTORS)


SHAPES = {
    "own": (OWN_VECTORS + 1, DIM), "asks": (DIM, 3 * DIM), "far": (SPAN,),
    "top": (DIM, ALL_GROUPS), "top_bias": (ALL_GROUPS,), "out": (GROUPS, DIM, WIDE), "out_bias": (GROUPS, WIDE),
}
SIZE = sum(int(np.prod(s)) for s in SHAPES.values())
SCALE = np.float32(DIM**-0.5)
_BACK = np.maximum(np.arange(SPAN)[:, None] - np.arange(SPAN)[None, :], 0)
_PAST = np.arange(SPAN)[:, None] >= np.arange(SPAN)[None, :]


def unpack(flat: np.ndarray) -> dict[str, np.ndarray]:
    """Views of the parts; ``asks`` holds the weights of query, key and value side by side."""
    out, at = {}, 0
    for name, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[name] = flat[at : at + n].reshape(shape)
        at += n
    return out


def initial(vocabulary: Vocabulary, seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    flat = (rng.standard_normal(SIZE) * 0.2).astype(np.float32)
    parts = unpack(flat)
    parts["far"][:] = -0.3 * np.arange(SPAN)
    parts["top"][:] *= 0.5
    parts["out"][:] *= 0.5
    parts["top_bias"][:] = vocabulary.first
    parts["out_bias"][:] = vocabulary.within
    return flat


def _logits(z: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    out = z @ weights
    out += bias
    return out


def _exponentials(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exponentials in place and their sums; rows are shifted by their maximum only where a sum would not be finite or 0."""
    ones = np.ones(logits.shape[-1], np.float32)
    least, most = float(logits.min(initial=0)), float(logits.max(initial=0))
    if most > 60 or least < -60:
        logits -= logits.max(-1, keepdims=True)
    np.exp(logits, out=logits)
    return logits, logits @ ones  # a product sums faster


def _attend(scores: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Softmax over the past; what lies ahead weighs nothing."""
    scores += far
    if float(np.abs(scores).max(initial=0)) > 60:
        scores -= np.where(_PAST[-scores.shape[1] :], scores, -np.inf).max(2, keepdims=True)
        np.minimum(scores, 0, out=scores)  # what lies ahead may be larger
    np.exp(scores, out=scores)
    scores *= _PAST[-scores.shape[1] :]
    scores /= (scores @ np.ones(SPAN, np.float32))[:, :, None]
    return scores


def _by_group(group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by groups, and where each of them begins in it."""
    order = np.argsort(group.astype(np.uint8), kind="stable")  # a radix sort
    return order, np.concatenate(([0], np.cumsum(np.bincount(group, minlength=ALL_GROUPS))))


class Trainer:
    """Adagrad on batches of windows; every shard of the corpus has one of these."""

    def __init__(self, flat: np.ndarray, vocabulary: Vocabulary, rate: float = 0.2):
        self.flat, self.start, self.rate, self.vocabulary = flat.copy(), flat, rate, vocabulary
        self.pace = rate
        self.parts = unpack(self.flat)
        self.square = {name: np.full_like(x, 1e-3) for name, x in self.parts.items()}

    def step(self, windows: np.ndarray, share: float = 1.0) -> float:
        """One batch of windows of SPAN + 1 ids; the mean loss in nats.  ``share``: of the length of a whole step."""
        self.pace = self.rate * share
        p, voc, many = self.parts, self.vocabulary, np.float32(1 / len(windows))  # a step's size is set per window
        row, y = voc.row.take(windows[:, :-1]), windows[:, 1:].reshape(-1)
        e = p["own"].take(row, 0)
        flat_e = e.reshape(-1, DIM)
        asked = (flat_e @ p["asks"]).reshape(len(windows), SPAN, 3 * DIM)
        q, k, v = asked[:, :, :DIM] * SCALE, asked[:, :, DIM : 2 * DIM], asked[:, :, 2 * DIM :]
        a = _attend(np.matmul(q, k.transpose(0, 2, 1)), p["far"][_BACK])
        seen = np.matmul(a, v)
        z = (e + seen).reshape(-1, DIM)
        # in the order of groups, so that each group is one slice
        group = voc.group.take(y)
        order, ends = _by_group(group)
        z, place = z.take(order, 0), voc.place.take(y.take(order))
        d, total = _exponentials(_logits(z, p["top"], p["top_bias"]))
        d /= total[:, None]
        at = np.arange(len(y)), group.take(order)
        loss = -float(np.log(d[at] + 1e-30).sum())
        d[at] -= 1
        d *= many
        grad = {"top": z.T @ d, "top_bias": d.sum(0)}
        dz = d @ p["top"].T
        grad["out"], grad["out_bias"] = np.zeros_like(p["out"]), np.zeros_like(p["out_bias"])
        for g in range(GROUPS):
            i, j = ends[g], ends[g + 1]
            if i < j:
                own = z[i:j]
                d, total = _exponentials(_logits(own, p["out"][g], p["out_bias"][g]))
                d /= total[:, None]
                at = np.arange(j - i), place[i:j]
                loss -= float(np.log(d[at] + 1e-30).sum())
                d[at] -= 1
                d *= many
                dz[i:j] += d @ p["out"][g].T
                grad["out"][g], grad["out_bias"][g] = own.T @ d, np.ones(j - i, np.float32) @ d
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        back = dz.take(place, 0)
        dz = back.reshape(e.shape)
        ds = np.matmul(dz, v.transpose(0, 2, 1))
        moved = np.empty_like(asked)  # the gradients of query, key and value
        np.matmul(a.transpose(0, 2, 1), dz, out=moved[:, :, 2 * DIM :])
        ds -= ((dz * seen) @ np.ones(DIM, np.float32))[:, :, None]
        ds *= a
        grad["far"] = np.bincount(_BACK.reshape(-1), weights=(ds.sum(0) * _PAST).reshape(-1), minlength=SPAN)
        np.matmul(ds, k * SCALE, out=moved[:, :, :DIM])
        np.matmul(ds.transpose(0, 2, 1), q, out=moved[:, :, DIM : 2 * DIM])
        moved = moved.reshape(-1, 3 * DIM)
        grad["asks"] = flat_e.T @ moved
        de = moved @ p["asks"].T
        de += back
        for name, g in grad.items():
            self._move(name, slice(None), g.astype(np.float32, copy=False))
        index = row.reshape(-1)
        order = np.argsort(index, kind="stable")  # of two bytes: a radix sort
        index = index.take(order)
        first = np.flatnonzero(np.diff(index, prepend=-1))
        self._move("own", index[first], np.add.reduceat(de.take(order, 0), first))
        return loss / len(y)

    def _move(self, name: str, rows, g: np.ndarray) -> None:
        square = self.square[name][rows] + g * g
        self.square[name][rows] = square
        self.parts[name][rows] -= self.pace * g / np.sqrt(square)

    def change(self) -> tuple[np.ndarray, np.ndarray]:
        """What training changed, and whether it did."""
        delta = self.flat - self.start
        return delta, delta != 0


class Scorer:
    """Log probabilities of many id sequences; tables of all vector rows are made once."""

    def __init__(self, flat: np.ndarray, vocabulary: Vocabulary):
        self.p = p = unpack(flat)
        self.voc = vocabulary
        e = p["own"]
        asked = e @ p["asks"]
        # rows of embedding and query for the ids that are scored from, of key and value for all
        self.asks = np.ascontiguousarray(np.concatenate([e, asked[:, :DIM] * SCALE], 1), np.float32)
        self.tells = np.ascontiguousarray(asked[:, DIM:], np.float32)
        self.far = p["far"][_BACK][LEAD:]

    def windows(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log probability of the STEP ids ``y`` that end each window, given the ids ``x`` of the window; and that of any id that begins a word."""
        p, voc, row = self.p, self.voc, self.voc.row.take(x)
        ask, tell = self.asks.take(row[:, LEAD:], 0), self.tells.take(row, 0)
        a = _attend(np.matmul(ask[:, :, DIM:], tell[:, :, :DIM].transpose(0, 2, 1)), self.far)
        z = np.matmul(a, tell[:, :, DIM:])
        z += ask[:, :, :DIM]
        # in the order of groups, so that each group is one product
        target = y.reshape(-1)
        group = voc.group.take(target)
        order, ends = _by_group(group)
        target, z = target.take(order), z.reshape(-1, DIM).take(order, 0)
        group, place = group.take(order), voc.place.take(target)
        top, total = _exponentials(_logits(z, p["top"], p["top_bias"]))
        found = np.log(top[np.arange(len(target)), group] / total + 1e-30)
        begins = np.log(top @ voc.opens / total + 1e-30)
        for g in range(GROUPS):
            i, j = ends[g], ends[g + 1]
            if i < j:
                own, total = _exponentials(_logits(z[i:j], p["out"][g], p["out_bias"][g]))
                found[i:j] += np.log(own[np.arange(j - i), place[i:j]] / total + 1e-30)
        found[ends[GROUPS] :] += voc.inner[target[ends[GROUPS] :]]
        out = np.empty((2, len(found)), np.float32)
        out[0, order], out[1, order] = found, begins
        return out[0].reshape(y.shape), out[1].reshape(y.shape)

    def texts(self, ids: np.ndarray, sizes: np.ndarray, edge: int, batch: int = 512) -> tuple[np.ndarray, np.ndarray]:
        """Natural log probability of every id of sequences that lie one after the other, and of any id there that begins a word.

        Every id is scored once, in a window with LEAD ids or more before it;
        ``edge`` stands before the first id, as often as the window needs it.
        """
        steps = -(-sizes // STEP)
        first = np.concatenate(([0], np.cumsum(steps)))
        real = np.arange(len(ids)) + np.repeat(first[:-1] * STEP - (np.cumsum(sizes) - sizes), sizes)
        target = np.full(first[-1] * STEP, edge, np.int64)
        target[real] = ids
        start = np.repeat(first[:-1] * STEP, steps)
        y = target.reshape(-1, STEP)
        out, begins = np.empty(y.shape, np.float32), np.empty(y.shape, np.float32)
        back = np.arange(-LEAD - 1, STEP - 1)
        for i in range(0, len(y), batch):
            some = np.arange(i, min(i + batch, len(y)))
            at = (some * STEP)[:, None] + back
            x = np.where(at >= start[some][:, None], target.take(np.maximum(at, 0)), edge)
            out[some], begins[some] = self.windows(x, y[some])
        return out.reshape(-1)[real], begins.reshape(-1)[real]
