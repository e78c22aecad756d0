import math

import numpy as np
import pytest

from conftest import SF0001
from stockflow.operators import demand as dm
from stockflow.operators import forecast as fc
from stockflow.sources import fixtures as fx

ARRAYS = "company string, item_code string, first_p int, q array<double>"


def _close(a, b):
    return (a is None and math.isnan(b)) or (a is not None and abs(a - b) <= 1e-9 * max(1, abs(b)))


@pytest.mark.parametrize("m", [4, 13])
def test_holt_winters_folds_equal_the_loop(spark, m):
    rng = np.random.default_rng(1)
    rows = [("HR", str(i), 0, y.tolist()) for i, y in enumerate(
        [rng.poisson(5, n).astype(float) for n in (1, 2 * m - 1, 2 * m, 2 * m + 1, 90)] + [np.zeros(40), np.r_[np.zeros(m), np.ones(30)],
         rng.poisson(0.3, 60).astype(float), -rng.random(40), np.zeros(0)])]
    got = {r.item_code: r for r in fc.holt_winters(spark.createDataFrame(rows, ARRAYS), m=m).collect()}
    assert len(got) == len(rows)
    for _, code, _, q in rows:
        y, r = np.array(q), got[code]
        level, trend, ahead, sse = fc._holt_winters_np(y, m, 0.3, 0.05, 0.2)
        *_, mul, sse_mul = fc._holt_winters_np(y, m, 0.3, 0.05, 0.2, True)
        for a, b in zip((r.level, r.trend, r.forecast_next, r.sse, r.forecast_next_mul, r.sse_mul), (level, trend, ahead, sse, mul, sse_mul)):
            assert _close(a, b), (code, r)


def test_holt_winters_steps_join_no_arrays(spark):
    plan = fc.holt_winters(spark.createDataFrame([], ARRAYS), m=13)._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" in plan and "concat(" not in plan


def test_holt_winters_of_a_series_equals_that_of_its_array(spark):
    mov = fx.movements(spark, SF0001)
    key = lambda r: (r.company, r.item_code)
    a = sorted(fc.holt_winters(dm.demand_arrays(mov, grain_days=28), m=13).collect(), key=key)
    b = sorted(fc.holt_winters(dm.demand_series(mov, grain_days=28), m=13).collect(), key=key)
    assert len(a) == len(b) > 100 and a == b


def test_regression_equals_least_squares(spark):
    rng = np.random.default_rng(2)
    rows, want = [], {}
    for i, n in enumerate((7, 30, 60, 150, 340)):
        p = np.arange(-1700, -1700 + n)
        y = rng.poisson(6, n).astype(float)
        rows += [("HR", str(i), int(a), float(b)) for a, b in zip(p, y)]
        x = np.column_stack([np.ones(n), p - p[0], *[f(2 * math.pi * j * p / 52) for j in (1, 2) for f in (np.sin, np.cos)]])
        coef = np.linalg.lstsq(x, y, rcond=None)[0]
        rest = y - x @ coef
        ahead = np.array([1, n, *[f(2 * math.pi * j * (p[-1] + 1) / 52) for j in (1, 2) for f in (np.sin, np.cos)]]) @ coef
        want[str(i)] = (coef, ahead, 1 - (rest ** 2).sum() / ((y - y.mean()) ** 2).sum(), n, np.linalg.cond(x))
    rows += [("HR", "short", -5, 1.0), ("HR", "short", -4, 2.0)] + [("HR", "flat", -p, 3.0) for p in range(1, 200)]
    got = {r.item_code: r for r in fc.fourier_regression(spark.createDataFrame(rows, "company string, item_code string, p int, qty double")).collect()}
    for code, (coef, ahead, r2, n, cond) in want.items():
        r = got[code]
        assert r.n == n
        if cond < 1e4:
            assert np.allclose([r.intercept, r.slope, *r.harmonics, r.forecast_next, r.r2], [*coef, ahead, r2], atol=1e-6, rtol=1e-6), code
    assert got["short"].intercept is None and got["short"].harmonics is None and got["short"].n == 2
    assert abs(got["flat"].intercept - 3) < 1e-9 and got["flat"].r2 is None


def test_plans_hold_no_python(spark):
    mov = fx.movements(spark, SF0001)
    for df in (fc.holt_winters(dm.demand_arrays(mov)), fc.fourier_regression(dm.demand_series(mov))):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan
