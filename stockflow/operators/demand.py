"""Demand analytics on the movement journal.

Every series here is per item (or per key) and per day / retail week / retail period. Windows
are partitioned by item and ordered by time, after the movements are collapsed to one row per
item and period: a group holds at most (time span / grain) rows however skewed the item is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from stockflow.functions import calendar as cal
from stockflow.functions.calendar import fdiv
from stockflow.functions.movement_fields import item_code
from stockflow.operators.sequence import exact_percentiles, running_by_value
from stockflow.session import materialize

KEY = ["company", "item_code", "warehouse"]
ITEM = ["company", "item_code"]
# fixed values: document types that are sales and customer returns, class cut-offs
SALE_TYPES = (13, 15)
RETURN_TYPES = (14, 16)
ADI_CUTOFF, CV2_CUTOFF = 1.32, 0.49


def _unbounded(key, order):
    return Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def period_index(date_col="doc_date", grain_days: int = 7) -> Column:
    """Global period number: floor(days since the calendar anchor / grain)."""
    return fdiv(cal.days_from_anchor(date_col), grain_days).cast("int")


def sales_history(mov: DataFrame, threshold: float = 0.0, key=KEY) -> DataFrame:
    """H1: per key and day: sales (Delivery 15 + standalone Invoice 13 with out_qty > 0),
    returns (16, 14), net sales, stock before the day and the stock-out flag. One aggregate
    and one per-key running window; no join."""
    tt = F.col("trans_type")
    d = mov.groupBy(*key, "doc_date").agg(
        F.sum(F.when((tt == 15) | ((tt == 13) & (F.col("out_qty") > 0)), F.col("out_qty")).otherwise(0.0)).alias("sales"),
        F.sum(F.when(tt.isin(*RETURN_TYPES), F.col("in_qty")).otherwise(0.0)).alias("returns"),
        F.sum(F.col("in_qty") - F.col("out_qty")).alias("net_qty"))
    on_hand = F.sum("net_qty").over(_unbounded(key, ["doc_date"]))
    return (d.withColumn("on_hand", on_hand)
             .withColumn("on_hand_before", F.col("on_hand") - F.col("net_qty"))
             .withColumn("net_sales", F.col("sales") - F.col("returns"))
             .withColumn("stockout", F.col("on_hand_before") <= threshold))


def stock_intervals(mov: DataFrame, end_date=None, key=KEY) -> DataFrame:
    """On-hand validity intervals: each movement day's end-of-day stock holds until the day
    before the key's next movement day (the last one until ``end_date``, by default the last day
    of the journal)."""
    end = F.lit(end_date).cast("date") if end_date is not None else mov.agg(F.max("doc_date")).scalar()
    d = mov.groupBy(*key, "doc_date").agg(F.sum(F.col("in_qty") - F.col("out_qty")).alias("net_qty"))
    w = Window.partitionBy(*key).orderBy("doc_date")
    return (d.withColumn("on_hand", F.sum("net_qty").over(_unbounded(key, ["doc_date"])))
             .withColumn("valid_to", F.least(F.coalesce(F.date_sub(F.lead("doc_date").over(w), 1), end), end))
             .withColumnRenamed("doc_date", "valid_from")
             .filter(F.col("valid_from") <= F.col("valid_to")))


def stockout_days(mov: DataFrame, end_date=None, threshold: float = 0.0, key=KEY) -> DataFrame:
    """H2 (counts): stock-out days per key from the first movement to ``end_date``; interval
    lengths are summed, nothing is exploded."""
    iv = stock_intervals(mov, end_date, key)
    n = F.datediff("valid_to", "valid_from") + 1
    return iv.groupBy(*key).agg(F.sum(n).alias("days"),
                                F.sum(F.when(F.col("on_hand") <= threshold, n).otherwise(0)).alias("stockout_days"))


def stockout_spine(mov: DataFrame, start_date, end_date, threshold: float = 0.0, key=KEY) -> DataFrame:
    """H2 (dense): one row per key and day in ``[start_date, end_date]`` from the key's first
    movement on, stock carried forward. Each interval explodes only its own days (clipped),
    so there is no keys x calendar cross join."""
    iv = stock_intervals(mov, end_date, key)
    lo = F.greatest(F.col("valid_from"), F.lit(start_date).cast("date"))
    hi = F.least(F.col("valid_to"), F.lit(end_date).cast("date"))
    return (iv.filter(lo <= hi).select(*key, "on_hand", F.explode(F.sequence(lo, hi)).alias("day"))
              .withColumn("stockout", F.col("on_hand") <= threshold))


def stockout_episodes(mov: DataFrame, end_date=None, threshold: float = 0.0, key=KEY) -> DataFrame:
    """H3: consecutive stock-out days grouped (gaps and islands over validity intervals)."""
    iv = stock_intervals(mov, end_date, key).withColumn("out", F.col("on_hand") <= threshold)
    w = Window.partitionBy(*key).orderBy("valid_from")
    iv = iv.withColumn("island", F.sum(F.when(F.col("out"), 0).otherwise(1)).over(
        w.rowsBetween(Window.unboundedPreceding, 0)))
    ep = iv.filter("out").groupBy(*key, "island").agg(F.min("valid_from").alias("start"),
                                                     F.max("valid_to").alias("end"))
    return ep.select(*key, "start", "end", (F.datediff("end", "start") + 1).alias("length"))


def weekly_sales(mov: DataFrame, by=ITEM, grain_days: int = 7) -> DataFrame:
    s = mov.filter(F.col("trans_type").isin(*SALE_TYPES))
    return s.groupBy(*by, period_index("doc_date", grain_days).alias("p")).agg(F.sum("out_qty").alias("qty"))


def demand_arrays(mov: DataFrame, by=ITEM, grain_days: int = 7) -> DataFrame:
    """Per item: ``first_p`` and the zero-filled demand ``q`` of every period from the item's first
    sale to the last period of the data. The sparse period sales are aggregated once and the gaps
    are filled inside the item's array (as long as the calendar), without a spine to join.

    The sparse arrays are written down, so that the journal is put together once, whatever is done with
    the series; the data's last period is read from them."""
    s = weekly_sales(mov, by, grain_days)
    g = materialize(s.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("p", "qty"))).alias("s")), "demand")
    g = g.withColumn("last_p", g.agg(F.max(F.element_at("s", -1)["p"])).scalar())

    def with_gap(e, i):
        until = F.coalesce(F.get(F.col("s"), i + 1)["p"], F.col("last_p") + 1)
        return F.concat(F.array(e["qty"]), F.array_repeat(F.lit(0.0), until - e["p"] - 1))

    return g.select(*by, F.col("s")[0]["p"].alias("first_p"), F.flatten(F.transform("s", with_gap)).alias("q"))


def demand_series(mov: DataFrame, by=ITEM, grain_days: int = 7) -> DataFrame:
    """H5: zero-filled demand per item and period, from the item's first sale to the last
    period of the data."""
    a = demand_arrays(mov, by, grain_days)
    return (a.select(*by, "first_p", F.posexplode("q").alias("_i", "qty"))
             .select(*by, (F.col("first_p") + F.col("_i")).alias("p"), "qty"))


def adi_cv2(series: DataFrame, by=ITEM, digits: int = 6) -> DataFrame:
    """H6: ADI = periods / non-zero periods, CV2 = (sd / mean)^2 of non-zero sizes
    (population sd); smooth / intermittent / erratic / lumpy at 1.32 and 0.49."""
    nz = F.when(F.col("qty") > 0, F.col("qty"))
    # CV2 = var / mean^2 = (n * sum(x^2) - sum(x)^2) / sum(x)^2: with integral quantities both
    # sums are exact, so the ratio is one correctly rounded division in any engine.
    g = series.groupBy(*by).agg(F.count(F.lit(1)).alias("periods"), F.count(nz).alias("nonzero"),
                                F.sum(nz * nz).alias("s2"), F.sum(nz).alias("s1"))
    return _classify_adi_cv2(g, by)


def adi_cv2_from_sales(mov: DataFrame, by=ITEM, grain_days: int = 7) -> DataFrame:
    """H6 straight from the sparse period sales, equal to ``adi_cv2(demand_series(mov))``.

    Zero-filled periods add nothing to the sums, so the spine is never built: an item's period
    count is its span ``last_p - first_p + 1`` (``last_p``: the data's last period)."""
    s = weekly_sales(mov, by, grain_days)
    last_p = s.agg(F.max("p")).scalar()
    nz = F.when(F.col("qty") > 0, F.col("qty"))
    g = s.groupBy(*by).agg(F.min("p").alias("first_p"), F.count(nz).alias("nonzero"),
                           F.sum(nz * nz).alias("s2"), F.sum(nz).alias("s1"))
    g = g.withColumn("periods", (last_p - F.col("first_p") + 1).cast("bigint"))
    return _classify_adi_cv2(g, by)


def _classify_adi_cv2(g: DataFrame, by) -> DataFrame:
    g = g.withColumn("adi", F.col("periods") / F.col("nonzero")) \
         .withColumn("cv2", (F.col("nonzero") * F.col("s2") - F.col("s1") * F.col("s1")) / (F.col("s1") * F.col("s1")))
    cls = (F.when((F.col("adi") < ADI_CUTOFF) & (F.col("cv2") < CV2_CUTOFF), "smooth")
            .when(F.col("cv2") < CV2_CUTOFF, "intermittent")
            .when(F.col("adi") < ADI_CUTOFF, "erratic").otherwise("lumpy"))
    return g.select(*by, "periods", "nonzero", "adi", "cv2", cls.alias("demand_class"))


def lifecycle_stage(series: DataFrame, by=ITEM, new_periods: int = 8, window: int = 13,
                    growth: float = 1.2, decline: float = 0.8) -> DataFrame:
    """H7: new / growth / mature / decline from the age of the series and the ratio of the
    last ``window`` periods to the ``window`` before them (parameterised rules)."""
    s = series.withColumn("last_p", series.agg(F.max("p")).scalar())
    g = s.groupBy(*by).agg(
        (F.max("last_p") - F.min("p") + 1).alias("age"),
        F.sum(F.when(F.col("p") > F.col("last_p") - window, F.col("qty")).otherwise(0.0)).alias("recent"),
        F.sum(F.when((F.col("p") <= F.col("last_p") - window) & (F.col("p") > F.col("last_p") - 2 * window),
                     F.col("qty")).otherwise(0.0)).alias("prior"))
    ratio = F.when(F.col("prior") > 0, F.col("recent") / F.col("prior"))
    stage = (F.when(F.col("age") < new_periods, "new")
              .when(ratio.isNull() & (F.col("recent") > 0), "growth")
              .when(ratio > growth, "growth").when(ratio < decline, "decline").otherwise("mature"))
    return g.select(*by, "age", "recent", "prior", F.round(ratio, 6).alias("trend_ratio"), stage.alias("stage"))


def _abc(share, own, a: float, b: float) -> Column:
    before = F.round(share, 6) - F.round(own, 6)
    return F.when(before < a, "A").when(before < b, "B").otherwise("C")


def abc_by_period(mov: DataFrame, a: float = 0.8, b: float = 0.95, digits: int = 2, weights=(0.6, 0.25, 0.15)) -> DataFrame:
    """H8: per retail period, items ranked by sales value; cumulative share -> A / B / C.

    ``abc_multi`` ranks by several criteria: the weighted mean of the item's shares of the period's
    sales value, units and sales days. Shares run over value buckets, so a period with all items is
    not sorted in one task."""
    s = mov.filter(F.col("trans_type").isin(*SALE_TYPES)).select(
        "company", "item_code", F.abs("trans_value").alias("v"), "out_qty", "doc_date",
        cal.retail_year("doc_date").alias("r_year"), cal.period_of_week(cal.retail_week("doc_date")).alias("r_period"))
    period, ties = ["r_year", "r_period"], ["company", "item_code"]
    g = s.groupBy(*period, *ties).agg(F.round(F.sum("v"), digits).alias("value"), F.sum("out_qty").alias("units"),
                                      F.count_distinct("doc_date").alias("sales_days"))
    g = running_by_value(g, period, "value", ties, "value", "cum", "total")
    whole = g.groupBy(*period).agg(F.sum("units").alias("_units"), F.sum("sales_days").alias("_days"))  # one row a period
    g = g.join(whole, period)
    score = sum(w * F.coalesce(F.try_divide(F.col(c).cast("double"), F.col(t)), F.lit(0.0)) for w, c, t in zip(
        weights, ("value", "units", "sales_days"), ("total", "_units", "_days")))
    # scores are scaled to millions so that the value buckets tell them apart
    g = running_by_value(g.withColumn("score", F.round(score * 1e6, 3)), period, "score", ties, "score", "score_cum", "score_total")
    share = lambda x, t: F.try_divide(F.col(x), F.col(t))
    return g.select(*period, *ties, "value", F.round(share("cum", "total"), 6).alias("cum_share"),
                    _abc(share("cum", "total"), share("value", "total"), a, b).alias("abc"),
                    F.col("score"), _abc(share("score_cum", "score_total"), share("score", "score_total"), a, b).alias("abc_multi"))


class _Flat:
    """Lists of numbers of an Arrow column end to end (null: nan): values, their list and place in it."""

    def __init__(self, col):
        self.size = np.asarray(pc.fill_null(pc.list_value_length(col), 0), np.int64)
        self.v = col.flatten().to_numpy(zero_copy_only=False).astype(float)
        self.row = np.repeat(np.arange(len(col)), self.size)
        self.at = np.arange(len(self.v)) - (np.cumsum(self.size) - self.size)[self.row]

    def near(self, k: int) -> np.ndarray:
        """The value k places on in the same list, nan beyond its ends."""
        out = np.full(len(self.v), np.nan)
        if abs(k) < len(self.v):
            out[max(-k, 0): len(self.v) - max(k, 0)] = self.v[max(k, 0): len(self.v) - max(-k, 0)]
        return np.where((self.at + k >= 0) & (self.at + k < self.size[self.row]), out, np.nan)

    def add(self, x: np.ndarray):
        """Sum and number of the known values of x in each list."""
        return np.bincount(self.row, np.where(np.isnan(x), 0.0, x), len(self.size)), np.bincount(self.row, ~np.isnan(x), len(self.size))


def _over_arrays(df: DataFrame, keep, ddl: str, work) -> DataFrame:
    """``work(batch) -> places of the kept columns, new columns`` over Arrow batches of demand arrays."""
    added = T.StructType.fromDDL(ddl)
    schema = T.StructType([df.schema[c] for c in keep] + added.fields)

    def run(batches):
        for whole in batches:
            for i in range(0, whole.num_rows, 2000):
                b = whole.slice(i, 2000)
                at, columns = work(b)
                kept = [b.column(c) if at is None else b.column(c).take(pa.array(at)) for c in keep]
                yield pa.RecordBatch.from_arrays([*kept, *columns], schema.names)

    return df.mapInArrow(run, schema)


def _null_nan(x, kind=pa.float64()):
    return pa.array(x, kind, from_pandas=True)


def moving_average_forecast(series: DataFrame, by=ITEM, k: int = 4) -> DataFrame:
    """Baseline forecast: mean of the previous ``k`` periods (null for the first period). Demand arrays
    (``q``) get an array ``forecast`` beside them, a series (``p, qty``) a column."""
    if "q" not in series.columns:
        w = Window.partitionBy(*by).orderBy("p").rowsBetween(-k, -1)
        return series.withColumn("forecast", F.avg("qty").over(w))

    def work(b):
        x = _Flat(b.column("q"))
        before = np.stack([x.near(-j) for j in range(k, 0, -1)])
        known = ~np.isnan(before)
        with np.errstate(invalid="ignore"):
            mean = np.where(known, before, 0.0).sum(0) / known.sum(0)
        return None, [pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(x.size)), pa.int32()), _null_nan(mean))]

    return _over_arrays(series.filter("q is not null").select(*by, "first_p", "q"), [*by, "first_p", "q"], "forecast array<double>", work)


def forecast_error(fc: DataFrame, by=ITEM, digits: int = 6) -> DataFrame:
    """Bias, MAPE (over non-zero actuals), WMAPE and MASE (vs the naive lag-1 error), of a series
    or of demand arrays with their forecasts."""
    names = ("bias", "mape", "wmape", "mase")
    if "q" in fc.columns:
        def work(b):
            x, f = _Flat(b.column("q")), _Flat(b.column("forecast")).v
            y = np.where(np.isnan(f), np.nan, x.v)
            e, naive = f - y, np.where(np.isnan(f), np.nan, np.abs(x.v - x.near(-1)))
            with np.errstate(divide="ignore", invalid="ignore"):
                mean = lambda v: np.divide(*x.add(v))
                total = lambda v: np.where(x.add(v)[1] > 0, x.add(v)[0], np.nan)
                over = lambda u, v: np.where(v != 0, u / v, np.nan)
                out = [mean(e), mean(np.where(y > 0, np.abs(e) / y, np.nan)), over(total(np.abs(e)), total(y)), over(mean(np.abs(e)), mean(naive))]
            some = np.flatnonzero(np.bincount(x.row, ~np.isnan(f), len(x.size)) > 0)  # items of one period have no forecast
            return some, [_null_nan(v[some]) for v in out]

        g = _over_arrays(fc, by, ", ".join(f"{c} double" for c in names), work)
    else:
        w = Window.partitionBy(*by).orderBy("p")
        x = fc.withColumn("naive_err", F.abs(F.col("qty") - F.lag("qty").over(w))).filter(F.col("forecast").isNotNull())
        e = F.col("forecast") - F.col("qty")
        g = x.groupBy(*by).agg(
            F.avg(e).alias("bias"),
            F.avg(F.when(F.col("qty") > 0, F.abs(e) / F.col("qty"))).alias("mape"),
            F.try_divide(F.sum(F.abs(e)), F.sum("qty")).alias("wmape"),
            F.try_divide(F.avg(F.abs(e)), F.avg("naive_err")).alias("mase"))
    return g.select(*by, *[F.round(c, digits).alias(c) for c in names])


def with_category(df: DataFrame, part: DataFrame, level: str = "p_brand") -> DataFrame:
    p = part.select(item_code("p_partkey").alias("item_code"),
                    F.col(level).alias("category"))
    return df.join(p, "item_code")


def seasonal_index(series: DataFrame, part: DataFrame, level: str = "p_brand", digits: int = 6) -> DataFrame:
    """Retail-week seasonal index pooled at category level: mean demand of the category
    in retail week w over its mean weekly demand (two-level aggregate)."""
    s = with_category(series, part, level).withColumn("r_week", F.pmod(F.col("p"), F.lit(52)) + 1)
    wk = s.groupBy("category", "r_week").agg(F.avg("qty").alias("week_mean"))
    tot = s.groupBy("category").agg(F.avg("qty").alias("mean"))
    return wk.join(tot, "category").select(
        "category", "r_week", F.round(F.try_divide(F.col("week_mean"), F.col("mean")), digits).alias("seasonal_index"))


def quantile_forecast(series: DataFrame, part: DataFrame, taus=(0.5, 0.9), level: str = "p_brand") -> DataFrame:
    """Per category and retail week, empirical quantiles of item demand. All quantiles come from
    one pass of counts over value buckets; the items of a category are never held in one buffer."""
    s = with_category(series, part, level).withColumn("r_week", F.pmod(F.col("p"), F.lit(52)) + 1)
    return exact_percentiles(s, ["category", "r_week"], "qty", {f"q{int(round(t * 100))}": t for t in taus})


def decompose(series: DataFrame, by=ITEM, m: int = 13, digits: int = 6) -> DataFrame:
    """H33 (classical): centred moving-average trend (2 x m for even m), seasonal mean of the
    detrended series per position in the cycle, residual. Demand arrays (``q``) are worked on where they
    stand; a series (``p, qty``) is sorted."""
    if "q" in series.columns:
        x = _over_arrays(series.filter("q is not null"), by, "p int, qty double, trend double, seasonal double", lambda b: _decomposed(b, m))
        return _parts(x, by, digits)
    w = Window.partitionBy(*by).orderBy("p")
    half = m // 2
    if m % 2:
        trend = F.avg("qty").over(w.rowsBetween(-half, half))
        full = F.count("qty").over(w.rowsBetween(-half, half)) == m
    else:
        a = F.sum("qty").over(w.rowsBetween(-half, half - 1))
        b = F.sum("qty").over(w.rowsBetween(-half + 1, half))
        trend = (a + b) / (2 * m)
        full = F.count("qty").over(w.rowsBetween(-half, half)) == m + 1
    x = series.withColumn("trend", F.when(full, trend)).withColumn("pos", F.pmod(F.col("p"), F.lit(m)))
    x = x.withColumn("seasonal", F.avg(F.col("qty") - F.col("trend")).over(Window.partitionBy(*by, "pos")))
    return _parts(x, by, digits)


def _parts(x: DataFrame, by, digits: int) -> DataFrame:
    return x.select(*by, "p", "qty", F.round("trend", digits).alias("trend"), F.round("seasonal", digits).alias("seasonal"),
                    F.round(F.col("qty") - F.col("trend") - F.col("seasonal"), digits).alias("residual"))


def _decomposed(b, m: int):
    x, half = _Flat(b.column("q")), m // 2
    if m % 2:
        trend = sum(x.near(j) for j in range(-half, half + 1)) / m  # nan where the frame is not full
    else:
        trend = (sum(x.near(j) for j in range(-half, half)) + sum(x.near(j) for j in range(-half + 1, half + 1))) / (2 * m)
    p = np.asarray(b.column("first_p"), np.int64)[x.row] + x.at
    cell, rest = x.row * m + p % m, x.v - trend
    some = ~np.isnan(rest)
    n = len(x.size) * m
    with np.errstate(invalid="ignore"):
        seasonal = (np.bincount(cell[some], rest[some], n) / np.bincount(cell[some], minlength=n))[cell]
    return x.row, [pa.array(p, pa.int32()), *map(_null_nan, (x.v, trend, seasonal))]
