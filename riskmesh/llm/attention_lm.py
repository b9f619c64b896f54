"""A causal self-attention language model over subword ids, trained in numpy.

One attention layer over a window of begin / text tokens predicts the class of
the next subword; within its class a subword has the share its count over all
training documents gives it (plus half a count), so probabilities sum to 1 over
the whole vocabulary. Classes are the most frequent subwords by themselves and
groups of the others that stand in similar contexts. How often a class follows an
input is counted over the whole training corpus; attention over the longer context
is added to the logarithm of that share.

A text is scored in overlapping windows: each window carries ``context`` tokens
of left context and scores the ``stride`` tokens behind them, so every token is
scored once, by batched masked attention. Its matrices are multiplied before they
meet a window (queries with keys, values with the output), so that a window needs
two small matrix products of the embeddings themselves.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

PRIOR = 8.0     # transitions that the classes' overall shares stand for


@dataclass
class Model:
    context: int
    stride: int
    begin: int              # id that fills the context before a text and ends it
    inputs: np.ndarray      # subword id -> input row
    classes: np.ndarray     # subword id -> class
    within: np.ndarray      # subword id -> ln share within its class
    p: dict[str, np.ndarray]

    def tables(self) -> dict[str, np.ndarray]:
        p = self.p
        both = p["Wq"] @ p["Wk"].T / np.sqrt(p["E"].shape[1])
        span = self.context + self.stride
        last = np.arange(self.stride)[:, None] + self.context
        return {
            "q": (p["E"] @ both).astype(np.float32), "qp": (p["P"] @ both)[self.context:].astype(np.float32), "VU": p["Wv"] @ p["U"],
            "T": np.clip(p["T"], -60, 40), "mask": (np.arange(span)[None, :] <= last).astype(np.float32),
        }


def layout(ids: np.ndarray, first: np.ndarray, context: int, stride: int, begin: int):
    """The texts ids[first[i]:first[i+1]] laid out for windows: (inputs, targets
    (-1: none), start of each window, text of each window). A window's input at
    offset context + t predicts the target there."""
    length = np.diff(first)
    per = -(-length // stride)
    size = per * stride + context
    place = np.cumsum(size) - size
    text = np.repeat(np.arange(len(length)), per)
    start = place[text] + (np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)) * stride
    at = np.arange(len(ids)) + np.repeat(place + context - first[:-1], length)
    targets = np.full(size.sum() + 1, -1, dtype=np.int32)
    targets[at] = ids
    inputs = np.full(size.sum() + 1, begin, dtype=np.int32)
    inputs[at + 1] = ids
    inputs[place] = begin  # what ran over from the text before
    return inputs[:-1], targets[:-1], start, text


def forward(m: Model, t: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
    """Unnormalised ln class probabilities (B * stride, classes) of input rows (B, context + stride)."""
    last = rows[:, m.context:]
    x = m.p["E"].take(rows, axis=0)
    x += m.p["P"]
    q = t["q"].take(last, axis=0)
    q += t["qp"]
    a = np.matmul(q, x.transpose(0, 2, 1))
    np.clip(a, -30, 30, out=a)
    np.exp(a, out=a)
    a *= t["mask"]
    z = np.matmul(a, x)
    z /= (a.reshape(-1, a.shape[2]) @ np.ones(a.shape[2], dtype=np.float32)).reshape(*z.shape[:2], 1)
    logits = z.reshape(-1, z.shape[2]) @ t["VU"]
    logits += t["T"].take(last.reshape(-1), axis=0)
    return logits


def score(m: Model, t: dict[str, np.ndarray], ids: np.ndarray, first: np.ndarray, batch: int = 128) -> np.ndarray:
    """ln probability of every text ids[first[i]:first[i+1]]."""
    if len(first) < 2:
        return np.zeros(0)
    inputs, targets, start, text = layout(ids, first, m.context, m.stride, m.begin)
    rows, goals = m.inputs[inputs], m.classes[targets]
    ln = np.zeros((len(text), m.stride), dtype=np.float32)
    span = np.arange(m.context + m.stride, dtype=np.int64)
    n_classes = m.p["U"].shape[1]
    ones = np.ones(n_classes, dtype=np.float32)
    for i in range(0, len(text), batch):
        at = start[i: i + batch, None] + span
        logits = forward(m, t, rows.take(at))
        goal = goals.take(at[:, m.context:]).reshape(-1)
        own = logits.reshape(-1).take(np.arange(len(logits)) * n_classes + goal)
        np.exp(logits, out=logits)  # ln shares plus a bounded correction: no overflow
        ln[i: i + batch] = (own - np.log(logits @ ones)).reshape(-1, m.stride)
    goal = targets[(start[:, None] + span[m.context:])]
    ln = np.where(goal >= 0, ln + m.within[goal], 0).sum(axis=1, dtype=np.float64)
    return np.bincount(text, weights=ln, minlength=len(first) - 1)


def _group(ids: np.ndarray, first: np.ndarray, counts: np.ndarray, alone: int, groups: int, seed: int, neighbours=None) -> np.ndarray:
    """Class of every subword: the ``alone`` most frequent ones by themselves,
    the others by k-means over the frequent neighbours they have (in the whole
    corpus by ``neighbours``, else in ``ids``); the last group takes those that are
    hardly known."""
    n = len(counts)
    order = np.argsort(-counts, kind="stable")
    classes = np.full(n, alone + groups - 1)
    classes[order[:alone]] = np.arange(alone)
    code = np.minimum(classes, alone)
    if neighbours is None:
        near = np.zeros((n, 2 * (alone + 1)), dtype=np.float32)
        inside = np.ones(len(ids) - 1, dtype=bool)
        inside[first[1:-1] - 1] = False
        left, right = ids[:-1][inside], ids[1:][inside]
        np.add.at(near, (right, code[left]), 1)
        np.add.at(near, (left, alone + 1 + code[right]), 1)
        seen = np.bincount(ids, minlength=n)
    else:
        near, seen = neighbours(code, alone + 1), counts
    rest = np.flatnonzero((classes >= alone) & (seen >= 4) & (near.sum(axis=1) > 0))
    if len(rest) > groups:
        x = np.sqrt(near[rest] / near[rest].sum(axis=1, keepdims=True))
        centre = x[np.random.default_rng(seed).choice(len(rest), groups - 1, replace=False)]
        for _ in range(8):
            best = np.argmax(x @ centre.T, axis=1)
            for c in range(groups - 1):
                if (best == c).any():
                    centre[c] = x[best == c].mean(axis=0)
                    centre[c] /= np.linalg.norm(centre[c]) + 1e-9
        classes[rest] = alone + best
    return classes


def train(ids: np.ndarray, first: np.ndarray, counts: np.ndarray, begin: int, context: int = 8, stride: int = 24, width: int = 16,
          alone: int = 40, groups: int = 24, own_inputs: int = 4096, steps: int = 300, batch: int = 160, rate: float = 0.02,
          seed: int = 7, gather=None, neighbours=None) -> Model:
    """Fit by Adam on the sample ``ids`` / ``first``; ``counts`` (per subword
    id, over the whole training corpus) give classes, inputs and shares.
    ``gather(inputs, classes, rows, n_classes)`` counts over the whole training
    corpus how often each class follows each input row; these transitions are then
    the table that the attention's output is added to, and the sample fits the
    attention alone. Without it the sample fits that table too.
    ``neighbours(code, n_codes)`` counts over the whole training corpus the codes before
    and behind every subword, from which the classes come."""
    rng = np.random.default_rng(seed)
    n = len(counts)
    # without a sample or neighbours (empty corpus) all subwords share one group and nothing is fitted
    classes = _group(ids, first, counts, alone, groups, seed, neighbours) if len(ids) > 1 or neighbours else np.full(n, alone + groups - 1)
    n_classes = alone + groups
    smooth = counts + 0.5
    within = np.log(smooth / np.bincount(classes, weights=smooth, minlength=n_classes)[classes])
    empty = np.bincount(classes, minlength=n_classes) == 0
    inputs = own_inputs + classes
    inputs[np.argsort(-counts, kind="stable")[:own_inputs]] = np.arange(min(own_inputs, n))
    span, rows = context + stride, own_inputs + n_classes
    f = lambda *shape, s: (rng.standard_normal(shape) * s).astype(np.float32)
    p = {"E": f(rows, width, s=0.5), "P": f(span, width, s=0.1), "Wq": f(width, width, s=0.3), "Wk": f(width, width, s=0.3),
         "Wv": f(width, width, s=0.3), "U": f(width, n_classes, s=0.1), "T": np.zeros((rows, n_classes), dtype=np.float32)}
    share = np.log((np.bincount(classes, weights=smooth, minlength=n_classes) + 1e-9) / smooth.sum())
    share[empty] = -1e9  # a class without subwords has no probability
    p["T"] += np.maximum(share, -1e9).astype(np.float32)
    if gather is not None:
        cells = gather(inputs.astype(np.int32), classes.astype(np.int32), rows, n_classes).reshape(rows, n_classes)
        flat_share = np.where(empty, 0, np.exp(np.maximum(share, -60)))
        mixed = (cells + PRIOR * flat_share) / (cells.sum(axis=1, keepdims=True) + PRIOR)
        p["T"] = np.where(empty, -1e9, np.log(np.maximum(mixed, 1e-12))).astype(np.float32)
    m = Model(context, stride, begin, inputs.astype(np.int32), classes.astype(np.int32), within.astype(np.float32), p)
    if len(ids) < 2:
        return m
    flat, wanted, start, _ = layout(ids, first, context, stride, begin)
    seen = flat[start[:, None] + np.arange(span)]
    goals = wanted[start[:, None] + np.arange(context, span)]
    mask, adam = m.tables()["mask"], Adam(p)
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(seen), min(batch, len(seen)))
        g = gradients(p, inputs[seen[pick]], classes[goals[pick]], goals[pick] >= 0, context, mask, gather is None)
        adam.step(g, rate * min(1, step / 20) * (1 - 0.9 * step / steps))
    return m


class Adam:
    """Both moments are kept without their constant factors (0.1 and 0.01), which the rate carries."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p, self.steps = p, 0
        self.first = {k: np.zeros_like(v) for k, v in p.items()}
        self.second = {k: np.zeros_like(v) for k, v in p.items()}
        self.room = {k: np.empty_like(v) for k, v in p.items()}

    def step(self, g: dict[str, np.ndarray], rate: float) -> None:
        """In place; ``g`` is used up."""
        self.steps += 1
        far = 10 * math.sqrt(1 - 0.99**self.steps)          # plain numbers: numpy's own would be 64 bits wide
        near, least = 0.1 * rate / (1 - 0.9**self.steps) * far, 1e-8 * far
        for name, grad in g.items():
            first, second, room = self.first[name], self.second[name], self.room[name]
            first *= 0.9
            first += grad
            grad *= grad
            second *= 0.99
            second += grad
            np.sqrt(second, out=room)
            room += least
            np.divide(first, room, out=room)
            room *= near
            self.p[name] -= room


def _added(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """(n, width): ``values`` added up by row, a column at a time."""
    rows, columns = rows.astype(np.int64), values.T.astype(np.float64, order="C")
    out = np.empty((len(columns), n), dtype=np.float32)
    for own, column in zip(out, columns):
        own[:] = np.bincount(rows, weights=column, minlength=n)
    return np.ascontiguousarray(out.T)


def gradients(p: dict[str, np.ndarray], row: np.ndarray, goal: np.ndarray, ok: np.ndarray, context: int, mask: np.ndarray,
              table: bool) -> dict[str, np.ndarray]:
    """Gradients of the mean loss over windows: input rows ``row``, classes ``goal``
    that are to be predicted where ``ok``. The table takes part if asked for.
    Queries and keys, values and output enter by their products, so keys and values
    are never laid out; the factors' gradients follow from those of the products."""
    n, span = row.shape
    d, stride = p["E"].shape[1], span - context
    scale = np.float32(1 / np.sqrt(d))
    flat = lambda t: t.reshape(-1, t.shape[-1])
    ones = lambda k: np.ones(k, dtype=np.float32)
    last = row[:, context:].reshape(-1)
    qk, vu = p["Wq"] @ p["Wk"].T * scale, p["Wv"] @ p["U"]
    x = p["E"].take(row, axis=0)
    x += p["P"]
    turned = x.transpose(0, 2, 1)
    late = flat(np.ascontiguousarray(x[:, context:]))
    q = (late @ qk).reshape(n, stride, d)
    a = np.matmul(q, turned)
    np.clip(a, -30, 30, out=a)
    np.exp(a, out=a)
    a *= mask
    part = (1 / (flat(a) @ ones(span)))[:, None]            # a's rows are shares only with it
    z = flat(np.matmul(a, x))
    z *= part
    y = z @ vu
    y += p["T"].take(last, axis=0)
    np.clip(y, -80, 80, out=y)          # ln shares plus a bounded correction: no overflow
    np.exp(y, out=y)
    total = y @ ones(y.shape[1])
    at = np.flatnonzero(ok)
    y.reshape(-1)[at * y.shape[1] + goal.reshape(-1)[at]] -= total[at]
    weight = (ok.reshape(-1) / (total * max(len(at), 1))).astype(np.float32)[:, None]    # y's rows are gradients only with it
    dz = y @ vu.T
    dz *= weight * part
    dvu = (y.T @ (z * weight)).T
    by = (dz * z) @ ones(d)             # the same as ds summed up by a, from fewer numbers
    dz = dz.reshape(n, stride, d)
    ds = np.matmul(dz, turned)
    ds -= by.reshape(n, stride, 1)
    ds *= a
    dq = flat(np.matmul(ds, x))
    # both sums over queries that make the gradient of x, in one product
    dx = np.matmul(np.concatenate([ds, a], axis=1).transpose(0, 2, 1), np.concatenate([q, dz], axis=1))
    dx[:, context:] += (dq @ qk.T).reshape(n, stride, d)
    dqk = late.T @ dq * scale
    g = {"U": p["Wv"].T @ dvu, "Wv": dvu @ p["U"].T, "Wq": dqk @ p["Wk"], "Wk": dqk.T @ p["Wq"], "P": (ones(n) @ dx.reshape(n, -1)).reshape(span, d),
         "E": _added(row.reshape(-1), flat(dx), len(p["E"]))}
    if table:
        g["T"] = _added(last, y * weight, len(p["T"]))
    return g


FITTED = ("E", "P", "Wq", "Wk", "Wv", "U")     # the table T is counted


class Fit:
    """One task's part of the fit over the whole corpus: every window of its texts
    is in one step of its own copy of the weights. Copies that began alike are
    averaged by their windows."""

    def __init__(self, m: Model, rate: float = 0.004, batch: int = 160):
        self.m, self.rate, self.batch, self.windows = m, rate, batch, 0
        self.p = {k: v if k == "T" else v.copy() for k, v in m.p.items()}
        self.adam, self.mask = Adam({k: self.p[k] for k in FITTED}), m.tables()["mask"]

    def texts(self, ids: np.ndarray, first: np.ndarray) -> None:
        m = self.m
        flat, wanted, start, _ = layout(ids, first, m.context, m.stride, m.begin)
        rows, goals, ok = m.inputs.take(flat), m.classes.take(wanted), wanted >= 0
        span = np.arange(m.context + m.stride)
        order = np.random.default_rng(len(start)).permutation(start)
        for own in np.array_split(order, -(-len(order) // self.batch)) if len(order) else []:
            at = own[:, None] + span
            ahead = at[:, m.context:]
            g = gradients(self.p, rows.take(at), goals.take(ahead), ok.take(ahead), m.context, self.mask, False)
            self.adam.step(g, self.rate * min(1, (self.adam.steps + 1) / 50))
        self.windows += len(start)

    def weights(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in FITTED]).astype(np.float64)


def with_weights(m: Model, flat: np.ndarray) -> Model:
    """``m`` with the fitted weights of ``Fit.weights``."""
    p, at = dict(m.p), 0
    for k in FITTED:
        p[k] = flat[at: at + p[k].size].reshape(p[k].shape).astype(np.float32)
        at += p[k].size
    return Model(m.context, m.stride, m.begin, m.inputs, m.classes, m.within, p)
