import numpy as np
from pyspark.sql import functions as F

from conftest import SF0001, SF001
from stockflow.functions import calendar as cal
from stockflow.operators import demand as dm
from stockflow.operators import forecast as fc
from stockflow.operators import replenish as rp
from stockflow.operators import unconstrain as un
from stockflow.sources import fixtures as fx


def test_demand_classes_match_fixture_counts(spark):
    mov = fx.movements(spark, SF001)
    got = {r["demand_class"]: r["count"] for r in dm.adi_cv2(dm.demand_series(mov)).groupBy("demand_class").count().collect()}
    assert got == {"intermittent": 1752, "lumpy": 248}


def _np_croston(y, a):
    z = x = None
    q = 1.0
    for v in y:
        if v > 0:
            if z is None:
                z, x = v, q
            else:
                z, x = z + a * (v - z), x + a * (q - x)
            q = 1.0
        else:
            q += 1
    return z / x


def _np_ses(y, a):
    lvl = None
    for v in y:
        lvl = v if lvl is None else lvl + a * (v - lvl)
    return lvl


def test_folds_match_numpy(spark):
    series = dm.demand_series(fx.movements(spark, SF0001))
    pdf = series.toPandas()
    cro = {(r["company"], r["item_code"]): r for r in fc.croston_family(series).collect()}
    ses = {(r["company"], r["item_code"]): r for r in fc.ses_holt(series).collect()}
    for (c, i), g in list(pdf.groupby(["company", "item_code"]))[:200]:
        y = g.sort_values("p")["qty"].to_numpy(float)
        assert abs(cro[(c, i)]["croston"] - round(_np_croston(y, 0.1), 6)) < 1e-6
        assert abs(ses[(c, i)]["ses"] - round(_np_ses(y, 0.3), 6)) < 1e-6


def test_stockout_spine_matches_brute_force(spark):
    from datetime import date, timedelta
    mov = fx.movements(spark, SF0001)
    start, end = date(1996, 1, 1), date(1996, 3, 31)
    spine = dm.stockout_spine(mov, start, end)
    got = {(r["company"], r["item_code"], r["warehouse"], r["day"]): r["on_hand"] for r in spine.collect()}
    daily = mov.groupBy("company", "item_code", "warehouse", "doc_date").agg(
        F.sum(F.col("in_qty") - F.col("out_qty")).alias("n")).toPandas()
    exp = {}
    for (c, i, w), g in daily.groupby(["company", "item_code", "warehouse"]):
        g = g.sort_values("doc_date")
        first = g["doc_date"].iloc[0]
        d = max(first, start)
        while d <= end:
            exp[(c, i, w, d)] = float(g[g["doc_date"] <= d]["n"].sum())
            d += timedelta(days=1)
    assert got == exp


def test_stockout_counts_equal_spine(spark):
    from datetime import date
    mov = fx.movements(spark, SF0001)
    end = date(1998, 12, 31)
    counts = dm.stockout_days(mov, end)
    spine = dm.stockout_spine(mov, date(1990, 1, 1), end).groupBy("company", "item_code", "warehouse").agg(
        F.count(F.lit(1)).alias("days"), F.count_if("stockout").alias("stockout_days"))
    a = sorted(map(tuple, counts.select("company", "item_code", "warehouse", "days", "stockout_days").collect()))
    b = sorted(map(tuple, spine.select("company", "item_code", "warehouse", "days", "stockout_days").collect()))
    assert a == b


def test_em_recovers_mean():
    rng = np.random.default_rng(1)
    d = rng.normal(20, 5, 4000)
    cap = 22.0
    x, out = np.minimum(d, cap), d > cap
    row, one = np.zeros(4000, int), np.ones(4000)
    mu, sd, filled = un.censored_normal(x, out, one, row, 1, 200)
    assert abs(mu[0] - 20) < 0.5 and abs(sd[0] - 5) < 0.5 and (filled >= x - 1e-9).all()
    pd_ = un.projection_detruncation(x, out, one, row, 1, 0.5, 50)
    assert (pd_ >= x - 1e-9).all() and pd_[out].mean() > cap and (pd_[~out] == x[~out]).all()


def test_em_of_many_keys_and_weights_equals_one_by_one():
    rng = np.random.default_rng(2)
    keys = [(rng.poisson(3, n).astype(float), rng.random(n) < 0.3) for n in (5, 40, 1, 12)]
    row = np.repeat(np.arange(4), [len(x) for x, _ in keys])
    x, out = np.concatenate([k[0] for k in keys]), np.concatenate([k[1] for k in keys])
    mu, sd, _ = un.censored_normal(x, out, np.ones(len(x)), row, 4, 50)
    for i, (xi, ci) in enumerate(keys):
        m1, s1, _ = un.censored_normal(xi, ci, np.ones(len(xi)), np.zeros(len(xi), int), 1, 50)
        assert np.allclose([mu[i], sd[i]], [m1[0], s1[0]], equal_nan=True)
        values, inverse, n = np.unique(np.column_stack([xi, ci]), axis=0, return_inverse=True, return_counts=True)
        m2, s2, _ = un.censored_normal(values[:, 0], values[:, 1] > 0, n.astype(float), np.zeros(len(values), int), 1, 50)
        assert np.allclose([m1[0], s1[0]], [m2[0], s2[0]], equal_nan=True)


def test_fits_follow_the_method_rule(spark):
    f = un.unconstrain_fits(fx.movements(spark, SF0001))
    days = un.unconstrain_periods(fx.movements(spark, SF0001)).groupBy(*un.KEY).agg(
        F.sum("days").alias("d"), F.sum("stockout_days").alias("o"), F.sum("demand_leave").alias("s"))
    rows = f.join(days, un.KEY).collect()
    assert len(rows) == f.count() > 0
    for r in rows:
        assert r.in_stock_days + r.stockout_days == r.d and r.stockout_days == r.o and r.sales == r.s
        share = r.o / r.d
        want = "smoothing" if r.in_stock_days < 180 or share > 0.9 else "mle" if share > 0.5 else "em"
        assert r.method == want
        assert r.demand_em >= r.sales - 1e-6 and r.demand_pd >= r.sales - 1e-6
    assert {"em", "smoothing"} <= {r.method for r in rows}


def test_smoothed_rate_counts_gap_days_as_zeros():
    e = lambda s, out, gap, gap_out: {"sales": s, "stockout": out, "gap_days": gap, "gap_out": gap_out}
    got = un.smoothed_rate([[e(4.0, False, 2, False), e(8.0, False, 5, True)], [e(1.0, True, 3, True)], []], 0.5)
    assert got[0] == (4 * 0.25) + 0.5 * (8 - 1) and np.isnan(got[1:]).all()


def test_unconstrained_periods_by_brute_force(spark):
    from collections import defaultdict
    from datetime import timedelta

    mov = fx.movements(spark, SF0001).filter("item_code < '0000020'")
    end = mov.agg(F.max("doc_date")).first()[0]
    hist = sorted(dm.sales_history(mov).collect(), key=lambda r: (r.company, r.item_code, r.warehouse, r.doc_date))
    cal_rows = spark.range(12000).select(F.date_add(F.lit("1990-01-01").cast("date"), F.col("id").cast("int")).alias("d")).select(
        "d", cal.retail_date("d").alias("r")).collect()
    place = {r.d: (r.r.year, r.r.period, r.r.day_of_week) for r in cal_rows}
    days = defaultdict(list)
    for k, r in enumerate(hist):
        key = (r.company, r.item_code, r.warehouse)
        last = k + 1 == len(hist) or (hist[k + 1].company, hist[k + 1].item_code, hist[k + 1].warehouse) != key
        until = end if last else hist[k + 1].doc_date - timedelta(days=1)
        days[key].append((r.doc_date, r.sales, r.stockout))
        d = r.doc_date + timedelta(days=1)
        while d <= until:
            days[key].append((d, 0.0, r.on_hand <= 0))
            d += timedelta(days=1)
    want = {}
    for key, own in days.items():
        rate = defaultdict(lambda: [0.0, 0])
        for d, sale, out in own:
            if not out:
                _, p, w = place[d]
                for cell in ((p, w), p, None):
                    rate[cell][0] += sale
                    rate[cell][1] += 1
        for d, sale, out in own:
            y, p, w = place[d]
            imputed = sale
            if out:
                imputed = next((rate[c][0] / rate[c][1] for c in ((p, w), p, None) if rate[c][1]), sale)
            t = want.setdefault((*key, y, p), [0, 0, 0.0, 0.0, 0.0])
            for i, v in enumerate((1, out, sale, 0.0 if out else sale, imputed)):
                t[i] += v
    got = {tuple(r)[:5]: tuple(r)[5:] for r in un.unconstrain_periods(mov).collect()}
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert np.allclose(got[k], v, atol=1e-5), k


def test_long_item_codes_stay_apart(spark):
    from stockflow.functions.movement_fields import item_code

    rows = spark.createDataFrame([(12345678,), (12345679,), (42,)], "k bigint").select(item_code("k")).collect()
    assert [r[0] for r in rows] == ["12345678", "12345679", "0000042"]


def test_lead_time_demand_for_any_lead_time(spark):
    arrays = spark.createDataFrame([("HR", "a", 10, [1.0, 0.0, 2.0, 5.0]), ("HR", "b", 0, [3.0] * 9)],
                                   "company string, item_code string, first_p int, q array<double>")
    for n in (1, 2, 4, 8):
        priors = spark.createDataFrame([("a", n), ("b", n)], "item_code string, lt_weeks int")
        got = {(r.item_code, r.p): r.ltd for r in rp.leadtime_demand(arrays, priors).collect()}
        want = {(i, f + k): sum(q[k: k + n]) for _, i, f, q in [tuple(r) for r in arrays.collect()] for k in range(len(q) - n + 1)}
        assert got == want


def test_values_by_buckets_equal_plain_windows(spark):
    from pyspark.sql.window import Window

    from stockflow.operators.sequence import exact_percentile, running_by_value

    rows = [(i % 3, i, float(v)) for i, v in enumerate(np.random.default_rng(3).normal(0, 1000, 400).round(1).tolist() + [0.0, -0.0, 5.0, 5.0])]
    df = spark.createDataFrame(rows, "g int, id int, v double")
    w = Window.partitionBy("g").orderBy(F.desc("v"), "id").rowsBetween(Window.unboundedPreceding, 0)
    got = running_by_value(df, ["g"], "v", ["id"], "v", "cum", "total").select("id", F.round("cum", 4), F.round("total", 4))
    want = df.select("id", F.round(F.sum("v").over(w), 4), F.round(F.sum("v").over(Window.partitionBy("g")), 4))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    for q in (0.0, 0.5, 0.95, 1.0):
        a = sorted(map(tuple, exact_percentile(df, ["g"], "v", q, "p").collect()))
        b = sorted(map(tuple, df.groupBy("g").agg(F.percentile("v", q)).collect()))
        assert np.allclose(a, b)


def test_multiplicative_holt_winters_follows_a_seasonal_series():
    y = np.array([(100 + 2 * t) * (1.5 if t % 4 == 0 else 0.8) for t in range(40)])
    *_, add, sse_add = fc._holt_winters_np(y, 4, 0.3, 0.05, 0.2)
    *_, mul, sse_mul = fc._holt_winters_np(y, 4, 0.3, 0.05, 0.2, True)
    assert sse_mul < sse_add and abs(mul - 180 * 1.5) < 15


def test_fourier_coefficients_and_forecast(spark):
    import math
    t = list(range(150))
    y = [10 + 0.1 * k + 3 * math.sin(2 * math.pi * k / 52) for k in t]
    s = spark.createDataFrame([("HR", "a", k, v) for k, v in zip(t, y)], "company string, item_code string, p int, qty double")
    r = fc.fourier_regression(s).first()
    assert np.allclose([r.intercept, r.slope, *r.harmonics], [10, 0.1, 3, 0, 0, 0], atol=1e-6)
    assert abs(r.forecast_next - (10 + 15 + 3 * math.sin(2 * math.pi * 150 / 52))) < 1e-6


def test_adi_cv2_from_sales_equals_spine_path(spark):
    mov = fx.movements(spark, SF0001)
    for grain in (7, 91):
        spine = dm.adi_cv2(dm.demand_series(mov, grain_days=grain))
        sparse = dm.adi_cv2_from_sales(mov, grain_days=grain)
        assert [(f.name, f.dataType) for f in spine.schema] == [(f.name, f.dataType) for f in sparse.schema]
        assert sorted(spine.collect()) == sorted(sparse.collect())
