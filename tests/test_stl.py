import numpy as np
from pyspark.sql import functions as F

from conftest import SF0001
from stockflow.operators import demand as dm
from stockflow.operators import stl as sm
from stockflow.sources import fixtures as fx


def plain_loess(x, y, w, q, at):
    """One local linear fit, by the textbook."""
    d = np.abs(x - at)
    near = np.argsort(d, kind="stable")[:q]
    h = d[near].max() + max(q - len(x), 0) // 2
    r = d[near] / max(h, 1)
    k = np.where(r <= 0.001, 1, np.where(r < 0.999, (1 - r ** 3) ** 3, 0)) * w[near]
    if k.sum() == 0:
        return None
    m = np.column_stack([np.ones(len(near)), x[near] - at])
    a = m.T @ (k[:, None] * m)
    if np.linalg.det(a) < 1e-9 * a[0, 0] * max(a[1, 1], 1e-300):
        return (k * y[near]).sum() / k.sum()
    return np.linalg.solve(a, m.T @ (k * y[near]))[0]


def test_loess_by_the_textbook():
    rng = np.random.default_rng(1)
    size = np.array([40, 17, 9, 2, 1])
    y, w = rng.normal(size=(5, 40)), rng.random((5, 40)) + 0.1
    for q in (5, 7, 13):
        got = sm.loess(y, w, size, q, -1, 1)
        for i, n in enumerate(size):
            for at in range(-1, n + 1):
                want = plain_loess(np.arange(n).astype(float), y[i, :n], w[i, :n], q, at)
                # between two windows equally near the end the fit may take either: only inner places have one
                if (q - 1) // 2 <= at <= n - 1 - (q - 1) // 2 or n <= q:
                    assert abs(got[i, at + 1] - want) < 1e-9, (q, n, at)


def planted(n=130, period=13, seed=3):
    rng = np.random.default_rng(seed)
    t = np.arange(n)
    trend = 100 + 0.5 * t + 10 * np.sin(t / 40)
    shape = rng.normal(0, 20, period)
    season = (shape - shape.mean())[t % period]
    return trend, season, rng.normal(0, 1, n)


def test_recovers_a_planted_trend_and_season():
    trend, season, noise = planted()
    y = (trend + season + noise)[None]
    level, cyc, _ = sm.stl_matrix(y, np.array([130]), 13)
    assert np.abs(level[0] - trend).max() < 2.5 and np.abs(cyc[0] - season).max() < 3
    assert np.abs(level[0] - trend).mean() < 0.7 and np.abs(cyc[0] - season).mean() < 1


def test_outliers_move_neither_trend_nor_season():
    trend, season, noise = planted(seed=5)
    y = trend + season + noise
    at = [20, 47, 80, 101]
    y[at] += [300, -250, 400, 280]
    robust, cyc, weight = sm.stl_matrix(y[None], np.array([130]), 13)
    plain, cyc0, _ = sm.stl_matrix(y[None], np.array([130]), 13, outer=0)
    assert (weight[0, at] < 0.01).all() and np.median(weight) > 0.8
    assert np.abs(robust[0] - trend).max() < 4 < np.abs(plain[0] - trend).max()
    assert np.abs(cyc[0] - season).max() < 6 < np.abs(cyc0[0] - season).max()


def test_alone_and_in_a_batch_the_same():
    rng = np.random.default_rng(7)
    size = np.array([130, 60, 26, 25, 5, 1])
    y = np.zeros((6, 130))
    for i, n in enumerate(size):
        y[i, :n] = rng.poisson(4, n)
    both = sm.stl_matrix(y, size, 13)
    for i, n in enumerate(size):
        one = sm.stl_matrix(y[i: i + 1, :n], size[i: i + 1], 13)
        for a, b in zip(both, one):
            assert np.allclose(a[i, :n], b[0], atol=1e-9)
    assert (both[1][3:] == 0).all()  # fewer than two cycles: no season
    assert np.allclose(sm.stl_matrix(np.full((1, 40), 7.0), np.array([40]), 13)[0], 7)


def test_operator(spark):
    arrays = dm.demand_arrays(fx.movements(spark, SF0001), grain_days=28)
    out = sm.stl(arrays, 13)
    series = dm.demand_series(fx.movements(spark, SF0001), grain_days=28)
    assert out.count() == series.count() == out.join(series.withColumnRenamed("qty", "y"), ["company", "item_code", "p"]).where("y = qty").count()
    assert out.where(F.abs(F.col("trend") + F.col("seasonal") + F.col("remainder") - F.col("qty")) > 1e-9).count() == 0
    assert out.where("weight < 0 or weight > 1 or trend is null or isnan(trend)").count() == 0
    none = spark.createDataFrame([("HR", "a", 1, None), ("HR", "b", 1, [])], "company string, item_code string, first_p int, q array<double>")
    assert sm.stl(none).count() == 0
