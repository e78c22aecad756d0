"""Forecasting.

Recursive smoothers (Croston, SBA, TSB, SES, Holt) are native folds: the item's series is
gathered as an array sorted by period (its length is the number of periods in the time span,
independent of data volume) and reduced with the ``aggregate`` higher-order function, which
runs in the JVM; so are Holt-Winters and the equations of the Fourier regression. Only the KDE
quantiles run in Python, batched over items.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.operators.demand import ITEM


def _series_array(series: DataFrame, by=ITEM, value: str = "qty") -> DataFrame:
    return series.groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct(F.col("p"), F.col(value).cast("double").alias("y")))).alias("s"))


def _arrays(demand: DataFrame, by) -> DataFrame:
    """``first_p`` and ``q`` of each item: demand arrays as they are, a series (``p, qty``) gathered. Items
    of which no period is known have no series."""
    if "q" in demand.columns:
        return demand.filter("q is not null")
    return _series_array(demand, by).select(*by, F.col("s")[0]["p"].alias("first_p"), F.col("s.p").alias("ps"), F.col("s.y").alias("q"))


def _d(x) -> Column:
    return F.lit(x).cast("double") if not isinstance(x, Column) else x.cast("double")


def croston_family(demand: DataFrame, alpha: float = 0.1, beta: float = 0.1, by=ITEM) -> DataFrame:
    """Croston and SBA (update only on positive demand) and TSB (demand probability
    updated every period). Returns the next-period forecasts per item, and the hybrid that
    switches from SBA to TSB once no demand has come for twice the smoothed interval. Takes demand
    arrays (``q``), which are folded where they stand, or a series (``p, qty``)."""
    init = F.struct(_d(None).alias("z"), _d(None).alias("x"), _d(1).alias("q"), _d(None).alias("d"),
                    _d(None).alias("tz"))

    def step(acc, y):
        pos = y > 0
        z_new = F.when(pos, F.when(acc["z"].isNull(), y).otherwise(acc["z"] + alpha * (y - acc["z"]))).otherwise(acc["z"])
        x_new = F.when(pos, F.when(acc["x"].isNull(), acc["q"]).otherwise(acc["x"] + alpha * (acc["q"] - acc["x"]))) \
                 .otherwise(acc["x"])
        q_new = F.when(pos, _d(1)).otherwise(acc["q"] + 1)
        ind = F.when(pos, _d(1)).otherwise(_d(0))
        d_new = F.when(acc["d"].isNull(), ind).otherwise(acc["d"] + beta * (ind - acc["d"]))
        tz_new = F.when(pos, F.when(acc["tz"].isNull(), y).otherwise(acc["tz"] + alpha * (y - acc["tz"]))) \
                  .otherwise(acc["tz"])
        return F.struct(z_new.alias("z"), x_new.alias("x"), q_new.alias("q"), d_new.alias("d"), tz_new.alias("tz"))

    a = _arrays(demand, by)
    st = F.aggregate("q", init, step)
    out = a.select(*by, st.alias("st"))
    cro = F.col("st.z") / F.col("st.x")
    sba, tsb = cro * (1 - alpha / 2), F.col("st.d") * F.coalesce(F.col("st.tz"), _d(0))
    obsolete = F.col("st.q") - 1 > 2 * F.col("st.x")  # periods since the last demand
    return out.select(*by, F.round(cro, 6).alias("croston"), F.round(sba, 6).alias("sba"), F.round(tsb, 6).alias("tsb"),
                      obsolete.alias("obsolete"), F.round(F.when(obsolete, tsb).otherwise(sba), 6).alias("hybrid"))


def ses_holt(demand: DataFrame, alpha: float = 0.3, beta: float = 0.1, by=ITEM) -> DataFrame:
    """Simple exponential smoothing and Holt's linear trend; next-period forecasts and
    the one-step-ahead forecast array (for error measures), which has a fold of its own, so that it
    costs nothing where it is not asked for. Takes demand arrays (``q``) or a series (``p, qty``)."""
    init = F.struct(_d(None).alias("l"), _d(None).alias("hl"), _d(None).alias("hb"))

    def step(acc, y):
        first = acc["l"].isNull()
        l_new = F.when(first, y).otherwise(acc["l"] + alpha * (y - acc["l"]))
        hl_new = F.when(first, y).otherwise(alpha * y + (1 - alpha) * (acc["hl"] + acc["hb"]))
        hb_new = F.when(first, _d(0)).otherwise(beta * (hl_new - acc["hl"]) + (1 - beta) * acc["hb"])
        return F.struct(l_new.alias("l"), hl_new.alias("hl"), hb_new.alias("hb"))

    def ahead(acc, y):
        level = F.when(acc["l"].isNull(), y).otherwise(acc["l"] + alpha * (y - acc["l"]))
        return F.struct(level.alias("l"), F.concat(acc["f"], F.array(acc["l"])).alias("f"))

    a = _arrays(demand, by)
    periods = F.col("ps") if "ps" in a.columns else F.sequence(F.col("first_p"), F.col("first_p") + F.size("q") - 1)
    before = F.struct(_d(None).alias("l"), F.array().cast("array<double>").alias("f"))
    return a.select(*by, F.aggregate("q", init, step).alias("st"), periods.alias("periods"), F.aggregate("q", before, ahead)["f"].alias("f")).select(
        *by, F.round("st.l", 6).alias("ses"), F.round(F.col("st.hl") + F.col("st.hb"), 6).alias("holt"),
        "periods", F.col("f").alias("ses_one_step"))


# ---------------------------------------------------------------- seasonal models as folds

def _holt_winters_np(y: np.ndarray, m: int, alpha: float, beta: float, gamma: float, multiplicative: bool = False):
    """The plain loop that ``holt_winters`` folds, for the tests: level, trend, next forecast and
    squared error; nan for the multiplicative form of a series whose first level is not positive."""
    nan = float("nan")
    if len(y) < 2 * m:
        lvl = float(np.mean(y)) if len(y) else 0.0
        return lvl, 0.0, lvl, nan
    lvl = y[:m].mean()
    if multiplicative and lvl <= 0:
        return nan, nan, nan, nan
    trend = (y[m:2 * m].mean() - y[:m].mean()) / m
    season = list(y[:m] / lvl if multiplicative else y[:m] - lvl)
    sse = 0.0
    for t in range(len(y)):
        s, base = season[t % m], lvl + trend
        sse += (y[t] - (base * s if multiplicative else base + s)) ** 2
        free = (y[t] / s if s > 0 else base) if multiplicative else y[t] - s
        new_lvl = alpha * free + (1 - alpha) * base
        trend = beta * (new_lvl - lvl) + (1 - beta) * trend
        own = (y[t] / new_lvl if new_lvl > 0 else s) if multiplicative else y[t] - new_lvl
        season[t % m] = gamma * own + (1 - gamma) * s
        lvl = new_lvl
    s = season[len(y) % m]
    return float(lvl), float(trend), float((lvl + trend) * s if multiplicative else lvl + trend + s), float(sse)


def _sum(array) -> Column:
    return F.aggregate(array, _d(0), lambda acc, x: acc + x)


def holt_winters(demand: DataFrame, m: int = 12, alpha: float = 0.3, beta: float = 0.05, gamma: float = 0.2, by=ITEM) -> DataFrame:
    """Additive and multiplicative Holt-Winters per item (season length ``m``), folded in the JVM
    over the demand arrays (column ``q``) or over a series (``p, qty``). The season is ``m`` fields, the first of which is the current
    place; each step moves them on and puts the new value last (an array would be cut and joined anew).

    A series shorter than two seasons has its mean as level and forecast; the multiplicative form needs
    a positive first level. What has no value is null."""
    q = F.col("q")
    long = F.size(q) >= 2 * m
    first = _sum(F.slice(q, 1, m)) / m
    places = [f"s{i}" for i in range(m)]
    slope = (_sum(F.slice(q, m + 1, m)) / m - first) / m

    def fold(mul: bool):
        # the first level is bound by a one-entry array, so that it is computed once
        start = F.transform(F.array(first), lambda f: F.struct(f.alias("l"), slope.alias("b"), _d(0).alias("e"),
                                                               *[(F.get(q, F.lit(i)) / f if mul else F.get(q, F.lit(i)) - f).alias(c) for i, c in enumerate(places)]))[0]

        def step(a, y):
            s, base = a["s0"], a["l"] + a["b"]
            miss = y - (base * s if mul else base + s)
            level = alpha * (F.when(s > 0, y / s).otherwise(base) if mul else y - s) + (1 - alpha) * base
            # level is used three times: bound by a one-entry array, so that it is computed once
            return F.transform(F.array(level), lambda v: F.struct(
                v.alias("l"), (beta * (v - a["l"]) + (1 - beta) * a["b"]).alias("b"),
                (a["e"] + miss * miss).alias("e"), *[a[c].alias(to) for to, c in zip(places, places[1:])],
                (gamma * (F.when(v > 0, y / v).otherwise(s) if mul else y - v) + (1 - gamma) * s).alias(places[-1])))[0]

        return F.aggregate(q, start, step)

    arrays = demand if "q" in demand.columns else _series_array(demand, by).select(*by, F.col("s.y").alias("q"))
    x = arrays.select(*by, "q", first.alias("_first"), F.when(long, fold(False)).alias("a"), F.when(long & (first > 0), fold(True)).alias("x"))
    mean = F.coalesce(F.try_divide(_sum(q), F.size(q)), _d(0))
    ahead = lambda c, f: F.when(F.col(c).isNotNull(), f(F.col(c)["l"] + F.col(c)["b"], F.col(c)["s0"]))
    return x.select(*by, F.coalesce(F.col("a.l"), mean).alias("level"), F.coalesce(F.col("a.b"), _d(0)).alias("trend"),
                    F.coalesce(ahead("a", lambda base, s: base + s), mean).alias("forecast_next"), F.col("a.e").alias("sse"),
                    F.when(long, ahead("x", lambda base, s: base * s)).otherwise(mean).alias("forecast_next_mul"), F.col("x.e").alias("sse_mul"))


def _solve(matrix: Column, n: int) -> Column:
    """Solution of n linear equations with a symmetric positive matrix, by Gauss-Jordan steps over the
    array of its rows with the right-hand side behind each; null where a pivot all but vanishes."""
    width = n + 1

    def eliminate(m, k):
        pivot = F.get(m, k * width + k)

        def cell(v, i):
            row, col = F.floor(i / width).cast("int"), F.pmod(i, F.lit(width))
            top = F.get(m, k * width + col) / pivot
            return F.when(row == k, top).otherwise(v - F.get(m, row * width + k) * top)

        return F.when(pivot > F.get(matrix, k * width + k) * 1e-9, F.transform(m, cell))

    done = F.aggregate(F.sequence(F.lit(0), F.lit(n - 1)), matrix, eliminate)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.get(done, i * width + n))


def fourier_regression(series: DataFrame, k: int = 2, period: int = 52, by=ITEM) -> DataFrame:
    """Least squares on [1, t, sin/cos(2 pi j w / 52), j = 1..k] per item: intercept, slope,
    the harmonic coefficients (sin, cos for each j), the forecast of the next period and r2.

    One aggregate sums the cross products of the columns with each other and with the demand (map side
    first, whatever the item's length); the equations are solved by a fold in the JVM. t runs from the
    end of the data while summing. An item whose columns are not independent (fewer periods than
    columns, or too few to tell the harmonics apart) has null coefficients."""
    t = (F.col("p") - series.agg(F.max("p")).scalar()).cast("double") / period  # in cycles, so that columns are of like size
    columns = [_d(1), t]
    for j in range(1, k + 1):
        angle = 2 * math.pi * j / period * F.col("p")
        columns += [F.sin(angle), F.cos(angle)]
    n = len(columns)
    x = series.select(*by, "p", F.col("qty").cast("double").alias("y"), *[c.alias(f"x{i}") for i, c in enumerate(columns)])
    pairs = [(i, j) for i in range(n) for j in range(i, n)]
    g = x.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min("p").alias("first"), F.max("p").alias("last"), F.max(F.col("p") - F.col("x1") * period).alias("_end"),
                           F.sum("y").alias("sy"), F.sum(F.col("y") * F.col("y")).alias("syy"),
                           *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}_{j}") for i, j in pairs],
                           *[F.sum(F.col(f"x{i}") * F.col("y")).alias(f"t{i}") for i in range(n)])
    matrix = F.array(*[F.col(f"s{min(i, j)}_{max(i, j)}") if j < n else F.col(f"t{i}") for i in range(n) for j in range(n + 1)])
    g = g.select(*by, "n", "first", "last", "_end", "sy", "syy", *[f"t{i}" for i in range(n)], matrix.alias("m"))
    g = g.withColumn("c", F.when(F.col("n") >= n, _solve(F.col("m"), n)))
    c = [F.get("c", F.lit(i)) for i in range(n)]
    ahead = F.col("last") + 1
    at = [_d(1), (ahead - F.col("_end")) / period]
    for j in range(1, k + 1):
        angle = 2 * math.pi * j / period * ahead
        at += [F.sin(angle), F.cos(angle)]
    total = F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    explained = sum(a * F.col(f"t{i}") for i, a in enumerate(c)) - F.col("sy") * F.col("sy") / F.col("n")
    return g.select(*by, (c[0] + c[1] * (F.col("first") - F.col("_end")) / period).alias("intercept"), (c[1] / period).alias("slope"),
                    F.slice("c", 3, 2 * k).alias("harmonics"), sum(a * b for a, b in zip(c, at)).alias("forecast_next"),
                    F.when(total > 1e-9 * F.col("syy"), F.try_divide(explained, total)).alias("r2"), "n")


_erfc = np.frompyfunc(math.erfc, 1, 1)


def kde_quantiles(x: np.ndarray, weight: np.ndarray, row: np.ndarray, n: int, tau: float) -> np.ndarray:
    """The tau-quantile of a Gaussian kernel density of each of n weighted samples (values ``x`` of the
    rows ``row``), by halving; bandwidth 1.06 sd n^-1/5 (1 where all values are equal). nan without
    values. A sample's result does not depend on the others."""
    add = lambda v: np.bincount(row, v, n)
    total = add(weight)
    safe = np.maximum(total, 1e-300)
    mean = add(weight * x) / safe
    sd = np.sqrt(np.maximum(add(weight * (x - mean[row]) ** 2) / safe, 0))
    width = np.where(sd > 1e-12, 1.06 * sd * safe ** -0.2, 1.0)
    low, high = np.full(n, np.inf), np.full(n, -np.inf)
    np.minimum.at(low, row, x)
    np.maximum.at(high, row, x)
    low, high = np.where(total > 0, low - 8 * width, 0), np.where(total > 0, high + 8 * width, 0)
    for _ in range(60):
        mid = (low + high) / 2
        below = add(weight * 0.5 * _erfc((x - mid[row]) / (width[row] * math.sqrt(2))).astype(float)) / safe
        up = below < tau
        low, high = np.where(up, mid, low), np.where(up, high, mid)
    return np.where(total > 0, (low + high) / 2, np.nan)


def kde_safety_stock(ltd: DataFrame, tau: float = 0.95, by=ITEM) -> DataFrame:
    """Safety stock from a Gaussian-kernel density of lead-time demand errors, and the average of
    the empirical, normal and kernel estimates.

    Mean, deviation and empirical quantile are aggregates; the densities see each item's distinct values
    with their counts, and a task works on all items of an Arrow batch at once."""
    from statistics import NormalDist
    z = NormalDist().inv_cdf(tau)
    stats = ltd.groupBy(*by).agg(F.avg("ltd").alias("m"), F.stddev_pop("ltd").alias("sd"), F.percentile("ltd", tau).alias("q"))
    values = (ltd.filter("ltd is not null").groupBy(*by, F.col("ltd").cast("double").alias("v")).agg(F.count("*").alias("c"))
              .groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("v", "c"))).alias("s")))
    schema = T.StructType([*[values.schema[c] for c in by], T.StructField("k", T.DoubleType())])

    def run(batches):
        for b in batches:
            col = b.column("s")
            row = np.repeat(np.arange(b.num_rows), np.asarray(pc.list_value_length(col), np.int64))
            v, c = (np.asarray(pc.struct_field(col.flatten(), f), float) for f in ("v", "c"))
            k = kde_quantiles(v, c, row, b.num_rows, tau)
            yield pa.RecordBatch.from_arrays([*[b.column(x) for x in by], pa.array(k, from_pandas=True)], schema.names)

    # the densities cost CPU, not bytes: an explicit number of partitions, which AQE does not merge
    n = int(ltd.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = stats.join(values.repartition(n, *by).mapInArrow(run, schema), by)
    kde = F.col("k") - F.col("m")
    return x.select(*by, kde.alias("ss_kde"), ((kde + F.col("q") - F.col("m") + F.col("sd") * z) / 3).alias("ss_average"))
