"""A small causal self-attention model over subword classes, with its gradients, in numpy.

A subword id has an input class (ids in order of their reversed bytes, cut into classes of equal
corpus mass, so a class knows how a token ends) and an output class (in order of their bytes, so a
class knows how a token begins). The model gives p(output class | last input classes); inside its
class an id has its smoothed corpus frequency after the last input class. The product is a proper
distribution over all ids.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

WINDOW, STRIDE = 32, 24
WIDTH, INPUTS, OUTPUTS = 16, 128, 64
BATCH = 64
TRAIN_BATCH = 64  # larger ones leave the cache and cost twice as much a place
PRIOR = 20.0
F = np.float32
SHAPES = {"e": (INPUTS + 1, WIDTH), "p": (WINDOW, WIDTH), "q": (WIDTH, WIDTH), "k": (WIDTH, WIDTH), "v": (WIDTH, WIDTH),
          "o": (WIDTH, WIDTH), "u": (WIDTH, OUTPUTS), "b": (OUTPUTS,)}
SKIP = WINDOW - STRIDE   # places of a later window that only give context
CLIP = F(60)             # attention scores and logits stay below, so that exp needs no maximum
_SEEN = np.tril(np.ones((WINDOW, WINDOW), F))


@dataclass
class Classes:
    """Classes of ids 0 .. n-1 (the last one ends a text) and their share of their output class,
    by the input class before (the last one starts a text)."""

    inputs: np.ndarray
    outputs: np.ndarray
    log_share: np.ndarray  # float32 [INPUTS + 1, ids]


def classes(counts: np.ndarray, names: list[bytes]) -> Classes:
    mass = counts + 0.5

    def cut(keys: list[bytes], n: int) -> np.ndarray:
        order = np.array(sorted(range(len(keys)), key=lambda i: (keys[i], i)))
        before = np.cumsum(mass[order]) - mass[order]
        out = np.zeros(len(keys), np.int64)
        out[order] = np.minimum(n - 1, (n * before / mass.sum()).astype(np.int64))
        return out

    outputs = cut(names, OUTPUTS)
    total = np.bincount(outputs, mass, OUTPUTS)
    share = np.log(mass / total[outputs]).astype(F)
    return Classes(cut([x[::-1] for x in names], INPUTS), outputs, np.tile(share, (INPUTS + 1, 1)))


def sequences(ids: np.ndarray, off: np.ndarray, inputs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Input class before each place and id there, for all places of texts with their end sign."""
    size = np.diff(off)
    at = np.arange(len(ids)) + np.repeat(np.arange(len(size)), size)
    given, target = np.full(len(ids) + len(size), INPUTS, np.int64), np.full(len(ids) + len(size), len(inputs) - 1, np.int64)
    target[at] = ids
    given[at + 1] = inputs[ids]
    return given, target


def given_last(c: Classes, last: np.ndarray, ids: np.ndarray, n: np.ndarray) -> Classes:
    """Shares that also know the input class before an id, from counts n of (last, id). The plain
    share stands for PRIOR further observations after each class."""
    counts = np.zeros(c.log_share.shape)
    counts[last, ids] = n
    share = np.exp(c.log_share[0].astype(float))
    out = np.empty_like(c.log_share)
    for k, row in enumerate(counts):
        out[k] = np.log((row + PRIOR * share) / (np.bincount(c.outputs, row, OUTPUTS) + PRIOR)[c.outputs])
    return Classes(c.inputs, c.outputs, out)


def initial(c: Classes, counts: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    out = {k: (rng.normal(size=s) * (0.3 if k in "ep" else WIDTH ** -0.5)).astype(F) for k, s in SHAPES.items()}
    out["u"] *= F(0.1)
    out["b"] = np.log(np.bincount(c.outputs, counts + 0.5, OUTPUTS) + 1e-9).astype(F)
    out["b"] -= out["b"].max()
    return out


class Places:
    """The places of texts, padded so that every window is whole.

    A text of n ids has n + 1 places: the first is predicted from the start sign, the last is the
    end sign. Window k starts at place k * stride and scores the places no earlier window scored.
    """

    def __init__(self, ids: np.ndarray, off: np.ndarray, c: Classes, stride: int = STRIDE):
        size = np.diff(off) + 1
        n = 1 + -(-np.maximum(size - WINDOW, 0) // stride)
        first = np.cumsum(WINDOW + (n - 1) * stride)
        room = first[-1] if len(first) else 0
        first = first - (WINDOW + (n - 1) * stride)
        self.given, self.target = np.zeros(room, np.int32), np.full(room, -1, np.int32)
        at = np.repeat(first - off[:-1], np.diff(off)) + np.arange(len(ids))
        self.target[at] = ids
        self.target[first + size - 1] = len(c.inputs) - 1
        self.given[at + 1] = c.inputs[ids]
        self.given[first] = INPUTS
        self.text = np.repeat(np.arange(len(size)), n)
        k = np.arange(len(self.text)) - (np.cumsum(n) - n)[self.text]
        self.start = first[self.text] + k * stride
        self.first = k == 0

    def take(self, rows: np.ndarray, begin: int = 0, end: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
        at = self.start[rows][:, None] + np.arange(begin, end)
        return self.given[at], self.target[at]


def windows(ids: np.ndarray, off: np.ndarray, c: Classes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows: input classes, target ids (-1: not scored here) and text index."""
    p = Places(ids, off, c)
    x, y = p.take(np.arange(len(p.start)))
    y[~p.first, :SKIP] = -1
    return x, y, p.text


def _attend(w: dict[str, np.ndarray], x: np.ndarray, begin: int = 0):
    """Output rows of the places from ``begin`` on, each seeing all places up to itself."""
    h = w["e"][x] + w["p"][: x.shape[1]]
    q, k, v = h[:, begin:] @ (w["q"] * F(WIDTH ** -0.5)), h @ w["k"], h @ w["v"]
    s = q @ k.transpose(0, 2, 1)
    np.minimum(s, CLIP, out=s)
    a = np.exp(s, out=s)
    a *= _SEEN[begin: x.shape[1], : x.shape[1]]
    total = a @ np.ones((a.shape[-1], 1), F)
    z = (a @ v) / total
    return h, q, k, v, a, total, z, h[:, begin:] + z @ w["o"]


def _places(w: dict[str, np.ndarray], c: Classes, x: np.ndarray, y: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray]:
    """Log-probabilities of the targets from ``begin`` on, and which of them count."""
    out = _attend(w, x, begin)[-1]
    given, target = x[:, begin:].ravel(), y[:, begin:].ravel()
    logits = out.reshape(-1, WIDTH) @ w["u"] + w["b"]
    np.minimum(logits, CLIP, out=logits)
    hit = logits[np.arange(len(target)), c.outputs[target]]
    np.exp(logits, out=logits)
    return hit - np.log(logits @ np.ones(OUTPUTS, F)) + c.log_share[given, target], target >= 0


def log_prob(w: dict[str, np.ndarray], c: Classes, ids: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Natural log-probability of each text with its end sign; every place is scored once."""
    p = Places(ids, off, c)
    total = np.zeros(len(off) - 1)
    # every window scores its last STRIDE places, a text's first one the places before as well
    for begin, end, which in ((SKIP, WINDOW, np.arange(len(p.start))), (0, SKIP, np.flatnonzero(p.first))):
        for i in range(0, len(which), BATCH):
            rows = which[i: i + BATCH]
            lp, ok = _places(w, c, *p.take(rows, 0, end), begin)
            sums = np.where(ok, lp, 0).reshape(len(rows), -1).sum(1, dtype=np.float64)
            total += np.bincount(p.text[rows], sums, len(total))
    return total


def gradients(w: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> tuple[dict[str, np.ndarray], float]:
    """Mean cross-entropy of output classes ``y`` (-1: none) and its gradients."""
    h, q, k, v, a, total, z, out = _attend(w, x)
    a /= total
    flat = lambda m: m.reshape(-1, m.shape[-1])
    p = flat(out) @ w["u"] + w["b"]
    np.exp(np.minimum(p, CLIP, out=p), out=p)
    p /= p @ np.ones((OUTPUTS, 1), F)
    y = y.ravel()
    rows = np.flatnonzero(y >= 0)
    n = max(len(rows), 1)
    hit = p[rows, y[rows]]
    loss = -float(np.log(hit + F(1e-30)).sum()) / n
    p[rows, y[rows]] = hit - 1
    if len(rows) < len(y):
        p[y < 0] = 0
    p *= F(1 / n)
    g = {"u": flat(out).T @ p, "b": np.ones(len(p), F) @ p}
    d_out = (p @ w["u"].T).reshape(out.shape)
    g["o"] = flat(z).T @ flat(d_out)
    d_z = (flat(d_out) @ w["o"].T).reshape(out.shape)
    d_s, d_v = d_z @ v.transpose(0, 2, 1), a.transpose(0, 2, 1) @ d_z
    # the mean of d_a under the attention is what the place has put out times its gradient
    d_s -= np.einsum("bij,bij->bi", d_z, z)[:, :, None]
    d_s *= a
    d_q, d_k = d_s @ k * F(WIDTH ** -0.5), d_s.transpose(0, 2, 1) @ q  # q already holds the scale
    d_h = flat(d_out).copy()
    for name, d in (("q", flat(d_q)), ("k", flat(d_k)), ("v", flat(d_v))):
        g[name] = flat(h).T @ d
        d_h += d @ w[name].T
    g["p"] = np.zeros(SHAPES["p"], F)
    g["p"][: x.shape[1]] = d_h.reshape(h.shape).sum(0)
    g["e"] = np.zeros(SHAPES["e"], F)
    at = x.ravel().astype(np.int16)
    order = np.argsort(at, kind="stable")
    first = np.flatnonzero(np.diff(at[order], prepend=-1))
    g["e"][at[order[first]]] = np.add.reduceat(d_h[order], first, axis=0)
    return g, loss


def train_local(w: dict[str, np.ndarray], c: Classes, batches, rate: float, seed: int) -> tuple[dict[str, np.ndarray], int]:
    """Adam over the places of the given (ids, offsets) batches; returns weights and places seen.

    Windows for training do not overlap, so that each place is computed once."""
    flat = pack(w)
    w = unpack(flat)
    m, s = np.zeros_like(flat), np.zeros_like(flat)
    rng, step, seen = np.random.default_rng(seed), 0, 0
    for ids, off in batches:
        p = Places(ids, off, c, WINDOW)
        order = rng.permutation(len(p.start))
        for i in range(0, len(order), TRAIN_BATCH):
            x, y = p.take(order[i: i + TRAIN_BATCH])
            g, _ = gradients(w, x, np.where(y >= 0, c.outputs[y], -1))
            step += 1
            seen += int((y >= 0).sum())
            grad = pack(g)
            m += F(0.1) * (grad - m)
            s += F(0.01) * (grad * grad - s)
            flat -= F(rate / (1 - 0.9 ** step)) * m / (np.sqrt(s * F(1 / (1 - 0.99 ** step))) + F(1e-8))
    return {k: v.copy() for k, v in w.items()}, seen


def pack(w: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w[k].ravel() for k in SHAPES])


def unpack(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[k] = flat[at: at + n].reshape(shape).astype(F, copy=False)
        at += n
    return out
