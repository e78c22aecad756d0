import math

import numpy as np
import pytest

from conftest import SF0001
from stockflow.operators import unconstrain as un
from stockflow.sources import fixtures as fx


def keys(seed=1, n=40):
    rng = np.random.default_rng(seed)
    out = []
    for k in range(n):
        m = int(rng.integers(3, 300))
        x = np.round(rng.normal(8, 3, m), 1) if k % 2 else rng.poisson(1.5, m).astype(float)
        c = rng.random(m) < rng.choice([0.05, 0.4, 0.8])
        c[: 2] = False
        out.append((x, c, rng.integers(1, 5, m).astype(float)))
    out += [(np.zeros(5), np.array([0, 0, 1, 1, 0], bool), np.ones(5)), (np.array([1.0, 2.0]), np.ones(2, bool), np.ones(2)),
            (np.array([4.0, 6.0, 5.0]), np.zeros(3, bool), np.ones(3))]
    return out


def together(all_keys):
    row = np.repeat(np.arange(len(all_keys)), [len(k[0]) for k in all_keys])
    return (*[np.concatenate([k[i] for k in all_keys]) for i in range(3)], row, len(all_keys))


@pytest.mark.parametrize("solve", [lambda *o: un.censored_normal(*o, 50), lambda *o: un.censored_normal(*o, 3000, 1e-10), un.censored_likelihood,
                                   lambda *o: (un.projection_detruncation(*o, 0.5, 20),) * 3])
def test_a_key_is_the_same_alone_and_in_any_batch(solve):
    every = keys()
    many = solve(*together(every))
    at = 0
    for i, k in enumerate(every):
        one = solve(*together([k]))
        two = solve(*together([every[(i + 7) % len(every)], k]))
        size = len(k[0])
        assert np.array_equal(many[2][at: at + size], one[2], equal_nan=True)
        assert np.array_equal(two[2][-size:], one[2], equal_nan=True)
        if many[0] is not many[2]:
            assert np.array_equal([many[0][i], many[1][i]], [one[0][0], one[1][0]], equal_nan=True)
        at += size


def log_likelihood(mu, sd, x, c, w):
    z = (x - mu) / sd
    tail = np.array([math.log(max(0.5 * math.erfc(v / math.sqrt(2)), 1e-300)) for v in z])
    return float((w * np.where(c, tail, -math.log(sd) - z * z / 2)).sum())


def test_likelihood_reaches_the_maximum_of_a_grid():
    for x, c, w in keys(3, 24):
        mu, sd, filled = un.censored_likelihood(x, c, w, np.zeros(len(x), int), 1)
        if np.isnan(mu[0]) or len(np.unique(x[~c])) < 2:
            continue
        best = log_likelihood(mu[0], sd[0], x, c, w)
        grid = max(log_likelihood(mu[0] + a * sd[0], sd[0] * b, x, c, w) for a in np.linspace(-1, 1, 41) for b in np.exp(np.linspace(-1, 1, 41)))
        assert best >= grid - 1e-9 * abs(grid)
        for a, b in ((1e-3, 1), (-1e-3, 1), (0, 1.001), (0, 0.999)):
            assert log_likelihood(mu[0] + a * sd[0], sd[0] * b, x, c, w) <= best + 1e-9 * abs(best)
        assert (filled >= x).all() and (filled[~c] == x[~c]).all()
        # EM goes to the same place, slowly
        em, em_sd, _ = un.censored_normal(x, c, w, np.zeros(len(x), int), 1, 200_000, 1e-13)
        assert abs(em[0] - mu[0]) < 1e-4 * max(1, abs(mu[0])) and abs(em_sd[0] - sd[0]) < 1e-4 * max(1, sd[0])


def test_heavy_censoring_recovers_the_mean():
    rng = np.random.default_rng(5)
    d = rng.normal(20, 5, 20_000)
    cap = np.full(20_000, 18.0)
    mu, sd, filled = un.censored_likelihood(np.minimum(d, cap), d > cap, np.ones(20_000), np.zeros(20_000, int), 1)
    assert abs(mu[0] - 20) < 0.3 and abs(sd[0] - 5) < 0.3 and abs(filled.mean() - 20) < 0.3


def test_rates_by_the_day():
    rng = np.random.default_rng(2)
    n = [0, 1, 5, 40]
    off = np.concatenate([[0], np.cumsum(n)])
    sales, out, gap = rng.integers(0, 9, sum(n)).astype(float), rng.random(sum(n)) < 0.3, rng.integers(0, 6, sum(n))
    got = un.smoothed_rates(sales, out, gap, off, 0.2)
    for i in range(len(n)):
        level = None
        for k in range(off[i], off[i + 1]):
            for v in ([] if out[k] else [sales[k]]) + [0.0] * int(gap[k]):
                level = v if level is None else level + 0.2 * (v - level)
        assert (level is None and np.isnan(got[i])) or abs(got[i] - level) < 1e-12


def test_fits_do_not_depend_on_the_partitioning(spark):
    mov = fx.movements(spark, SF0001)
    key = lambda r: (r.company, r.item_code, r.warehouse)
    whole = sorted(un.unconstrain_fits(mov).collect(), key=key)
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    for n in (1, 13):
        spark.conf.set(name, str(n))
        try:
            assert len(whole) > 500 and sorted(un.unconstrain_fits(mov).collect(), key=key) == whole
        finally:
            spark.conf.set(name, before)
    assert {r.demand_pd is None for r in un.unconstrain_fits(mov, with_pd=False).collect()} == {True}
