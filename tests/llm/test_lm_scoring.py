import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
from pyspark.sql import functions as F

from cases import WORD, docs, empty, odd_rows, random_texts
from stockflow.llm import attention as at
from stockflow.llm import lm_scoring as lm

PATH = P.path("byte_bpe_50k.tiktoken")


def low_words(t):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in WORD.findall(t or "")]


def test_base_scores_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 40)  # so that many words take the join
    rows = odd_rows() + [(300 + i, t, "en", "s", 1) for i, t in enumerate(random_texts(80, 5))]
    df = docs(spark, rows).withColumn("held_out", lm.held_out(F.col("doc_id"), 5)).withColumnRenamed("source", "SCORE").withColumnRenamed("n_chars", "_row")
    model = lm.fit(df.where(~F.col("held_out")), PATH, P.PATTERN, lm.Settings(share=2))
    got = lm.score(df, model, PATH, P.PATTERN).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    c = Counter()
    for r in rows:
        if not held(r[0]):
            c.update(low_words(r[1]) + ["<end>"])
    n, v = sum(c.values()), len(c)
    assert len(got) == len(rows) and model.tokens == n and model.distinct == v
    for r in got:
        own = low_words(r.text) + ["<end>"]
        assert r.held_out == held(r.doc_id)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(c[w] > 0 for w in own), n)
        want = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        assert abs(r.base_score - want) < 1e-6 * max(1, abs(want))
        assert r._row in (1, 3, None) and r.score < 0 and math.isfinite(r.score)


def toy(n=50, seed=0):
    rng = np.random.default_rng(seed)
    counts = rng.integers(0, 30, n + 1).astype(float)
    names = [bytes([97 + i % 26, 97 + i // 26]) for i in range(n)] + [b""]
    c = at.classes(counts, names)
    w = {k: v + rng.normal(size=v.shape).astype(np.float32) * 0.2 for k, v in at.initial(c, counts).items()}
    return c, w, rng


def test_each_place_is_scored_once_by_its_window():
    c, w, rng = toy()
    size = np.array([0, 1, 30, 31, 32, 33, 55, 56, 57, 200])
    off = np.concatenate([[0], np.cumsum(size)])
    ids = rng.integers(0, 50, off[-1])
    x, y, text = at.windows(ids, off, c)
    for i, n in enumerate(size.tolist()):
        own = np.concatenate([y[k][y[k] >= 0] for k in np.flatnonzero(text == i)])
        assert own.tolist() == [*ids[off[i]: off[i + 1]].tolist(), 50]
    # brute force: place by place, attending to the places of its window up to itself
    got = at.log_prob(w, c, ids, off)
    for i in (0, 1, 4, 9):
        own = ids[off[i]: off[i + 1]]
        given = np.concatenate([[at.INPUTS], c.inputs[own]]).astype(int)
        target = np.concatenate([own, [50]])
        total = 0.0
        for t in range(len(target)):
            k = 0 if t < at.WINDOW else 1 + (t - at.WINDOW) // at.STRIDE
            s = k * at.STRIDE
            h = (w["e"][given[s: t + 1]] + w["p"][: t + 1 - s]).astype(float)
            a = (h[-1] @ w["q"]) @ (h @ w["k"]).T / at.WIDTH ** 0.5
            a = np.exp(a - a.max())
            out = h[-1] + (a / a.sum()) @ (h @ w["v"]) @ w["o"]
            logits = out @ w["u"] + w["b"]
            total += logits[c.outputs[target[t]]] - logits.max() - np.log(np.exp(logits - logits.max()).sum()) + c.log_share[given[t], target[t]]
        assert abs(total - got[i]) < 1e-3 * max(1, abs(total))


def test_distribution_sums_to_one():
    c, w, rng = toy()
    c = at.given_last(c, rng.integers(0, at.INPUTS, 300), rng.integers(0, 51, 300), rng.integers(1, 9, 300))
    for start in ([], [3], [3, 7, 7]):
        text = lambda ids: at.log_prob(w, c, np.array([*start, *ids], int), np.array([0, len(start) + len(ids)]))[0]
        x, y, _ = at.windows(np.array([*start, 0]), np.array([0, len(start) + 1]), c)
        h = at._attend(w, x)[-1][0, len(start)]
        logits = h @ w["u"] + w["b"]
        p = np.exp(logits - logits.max())
        p /= p.sum()
        every = p[c.outputs] * np.exp(c.log_share[x[0, len(start)]])
        assert abs(every[np.isin(c.outputs, c.outputs)].sum() + p[~np.isin(np.arange(at.OUTPUTS), c.outputs)].sum() - 1) < 1e-4
        assert abs(text([]) - (np.log(every[50]) + _prefix(w, c, start))) < 1e-3


def _prefix(w, c, start):
    """Log-probability of a prefix, place by place."""
    total = 0.0
    for t, i in enumerate(start):
        x, _, _ = at.windows(np.array(start[:t] + [0], int), np.array([0, t + 1]), c)
        logits = at._attend(w, x)[-1][0, t] @ w["u"] + w["b"]
        total += logits[c.outputs[i]] - logits.max() - np.log(np.exp(logits - logits.max()).sum()) + c.log_share[x[0, t], i]
    return total


def test_shares_after_a_class_by_brute_force():
    c, _, rng = toy()
    last, ids, n = rng.integers(0, at.INPUTS, 40), np.arange(40), rng.integers(1, 9, 40)
    new = at.given_last(c, last, ids, n)
    for k, i in zip(last.tolist(), ids.tolist()):
        own = {j: m for q, j, m in zip(last.tolist(), ids.tolist(), n.tolist()) if q == k and c.outputs[j] == c.outputs[i]}
        want = (own[i] + at.PRIOR * math.exp(c.log_share[0, i])) / (sum(own.values()) + at.PRIOR)
        assert abs(math.exp(new.log_share[k, i]) - want) < 1e-5


def test_gradients_by_differences():
    c, w, rng = toy()
    ids = rng.integers(0, 50, 70)
    x, y, _ = at.windows(ids, np.array([0, 70]), c)
    yy = np.where(y >= 0, c.outputs[y], -1)
    g, _ = at.gradients(w, x, yy)
    for name in at.SHAPES:
        k = int(np.abs(g[name]).argmax())
        eps = 1e-2
        up, down = ({n: v.copy() for n, v in w.items()} for _ in range(2))
        up[name].ravel()[k] += eps
        down[name].ravel()[k] -= eps
        num = (at.gradients(up, x, yy)[1] - at.gradients(down, x, yy)[1]) / (2 * eps)
        assert abs(num - g[name].ravel()[k]) < 2e-2 * max(0.05, abs(num)), name


def test_training_lowers_the_loss():
    c, w, rng = toy()
    ids = np.tile(np.arange(10), 400)
    off = np.array([0, len(ids)])
    trained, seen = at.train_local(w, c, [(ids, off)] * 6, 0.02, 1)
    assert seen == 6 * (len(ids) + 1)
    assert at.log_prob(trained, c, ids, off)[0] > at.log_prob(w, c, ids, off)[0] + 500


def test_nothing_to_learn_and_empty_table(spark):
    df = docs(spark, odd_rows())
    model = lm.fit(empty(spark), PATH, P.PATTERN)
    got = lm.score(df, model, PATH, P.PATTERN).collect()
    assert len(got) == len(odd_rows()) and all(r.n_known == 0 and r.train_tokens == 0 for r in got)
    assert lm.score(empty(spark), model, PATH, P.PATTERN).count() == 0
