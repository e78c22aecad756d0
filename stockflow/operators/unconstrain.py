"""Unconstraining on calendar days (H4, H17, H25, H26, H32 over the dense form of H2).

A key's history is a list of movement days, each followed by a gap of days on which nothing moved
and the stock stayed as it was. Gap days are demand observations of zero when there was stock and
censored ones when there was none. They are never written out day by day: a gap is one interval,
cut at retail periods, whose weekdays are counted by arithmetic, or a weight in a fit.
"""

from __future__ import annotations

import math
from datetime import date
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from stockflow.functions import calendar as cal
from stockflow.operators.demand import KEY, sales_history
from stockflow.session import materialize, settings


def stock_history(mov: DataFrame, threshold: float = 0.0, key=KEY) -> DataFrame:
    """H1 rows with the gap that follows each movement day: its first and last day, length and
    whether the key was out of stock in it (the last gap ends with the journal)."""
    end = mov.agg(F.max("doc_date")).scalar()
    w = Window.partitionBy(*key).orderBy("doc_date")
    last = F.coalesce(F.date_sub(F.lead("doc_date").over(w), 1), end)
    return (sales_history(mov, threshold, key).withColumn("gap_to", last)
            .withColumn("gap_from", F.date_add("doc_date", 1))
            .withColumn("gap_days", _gap_days(F.col("doc_date"), F.col("gap_to")))
            .withColumn("gap_out", _gap_out(F.col("gap_days"), F.col("on_hand"), threshold)))


def _gap_days(day, to):
    return F.greatest(F.datediff(to, F.date_add(day, 1)) + 1, F.lit(0))


def _gap_out(days, on_hand, threshold: float):
    return (days > 0) & (on_hand <= threshold)


def cycle_history(mov: DataFrame, threshold: float = 0.0, key=KEY) -> DataFrame:
    """``stock_history`` with the receipt-to-receipt cycle of each movement day, a list ``d`` a key.

    The lists are written down before the last gap is closed, so that the journal is put together once: its
    end is read from them."""
    w = Window.partitionBy(*key).orderBy("doc_date")
    opened = F.sum(F.when(F.col("net_qty") > 0, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    h = sales_history(mov, threshold, key).withColumn("cycle", opened).withColumn("gap_to", F.date_sub(F.lead("doc_date").over(w), 1))
    kept = ("doc_date", "sales", "stockout", "on_hand", "cycle")
    lists = h.groupBy(*key).agg(F.collect_list(F.struct(*kept, "gap_to")).alias("d"))
    # the windows leave the days sorted by key; a hash aggregate would sort, and spill, them twice more
    with settings(mov.sparkSession, {"spark.sql.execution.replaceHashWithSortAgg": "true"}):
        lists = materialize(lists, "history")

    def closed(e):
        days = _gap_days(e["doc_date"], F.coalesce(e["gap_to"], F.col("end")))
        return F.struct(*[e[c].alias(c) for c in kept], days.alias("gap_days"), _gap_out(days, e["on_hand"], threshold).alias("gap_out"))

    end = lists.agg(F.max(F.array_max("d.doc_date"))).scalar()
    return lists.withColumn("end", end).select(*key, F.transform("d", closed).alias("d"))


# first day (from the year's start) of each period and the period of each day of a retail year
_PERIOD_START = np.array([(k // 3) * 91 + (0, 28, 63)[k % 3] for k in range(12)], np.int64)
_PERIOD_OF_DAY = np.repeat(np.arange(12), np.diff(np.append(_PERIOD_START, cal.DAYS_PER_YEAR)))
_ANCHOR = (cal.ANCHOR_WEEK1_START - date(1970, 1, 1)).days


def _period_index(day: np.ndarray) -> np.ndarray:
    """Year * 12 + period - 1 of days since 1970."""
    off = day - _ANCHOR
    return (cal.ANCHOR_YEAR + off // cal.DAYS_PER_YEAR) * 12 + _PERIOD_OF_DAY[off % cal.DAYS_PER_YEAR]


def _period_start(index: np.ndarray) -> np.ndarray:
    return _ANCHOR + (index // 12 - cal.ANCHOR_YEAR) * cal.DAYS_PER_YEAR + _PERIOD_START[index % 12]


def _weekday_days(first: np.ndarray, n: np.ndarray, k: int) -> np.ndarray:
    """Of ``n`` days from ``first`` on, every seventh is weekday k, and one more where the rest reaches it."""
    return n // 7 + ((k - (first - _ANCHOR)) % 7 < n % 7)


IN, OUT, UNKNOWN = 0, 1, 2  # a day's stock; nothing is known of it without any quantity


def period_pieces(row, day, out, sales, gap, gap_out):
    """One piece for each movement day and for each stretch of a gap inside one retail period: its key
    (``row``), period index, first day, days, state of the stock and sales."""
    has = np.flatnonzero(gap > 0)
    start, end = day[has] + 1, day[has] + gap[has]
    low = _period_index(start)
    cut = _period_index(end) - low + 1
    at = np.repeat(np.arange(len(has)), cut)
    index = low[at] + np.arange(len(at)) - np.repeat(np.cumsum(cut) - cut, cut)
    first, last = np.maximum(_period_start(index), start[at]), np.minimum(_period_start(index + 1) - 1, end[at])
    join = lambda a, b: np.concatenate([a, b])
    return (join(row, row[has][at]), join(_period_index(day), index), join(day, first), join(np.ones(len(day), np.int64), last - first + 1),
            join(out, gap_out[has][at]), join(sales, np.zeros(len(at))))


def unconstrained(row, day, out, sales, gap, gap_out, n: int):
    """H4 of ``n`` keys at once from their movement days (days since 1970) and the gaps behind them;
    ``sales`` is nan where it is not known. Returns key, period index, days, stock-out days, sales,
    in-stock sales (nan where none is known) and unconstrained demand of each period of each key, and
    whether each key was ever in stock."""
    row, index, first, days, out, sales = period_pieces(row, day, out, sales, gap, gap_out)
    known, inside = ~np.isnan(sales), out == IN
    value = np.where(known, sales, 0.0)
    # a key's periods run on from its first to its last one: a place for each
    low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
    np.minimum.at(low, row, index)
    np.maximum.at(high, row, index)
    size = np.maximum(high - low + 1, 0)
    begin = np.cumsum(size) - size
    total = int(size.sum())
    place = begin[row] + index - low[row]
    add = lambda use, v: np.bincount(place[use], v[use], total)
    every = slice(None)
    count = add(every, days).astype(np.int64)
    censored = add(out == OUT, days).astype(np.int64)
    in_sales = add(inside, value)
    none = lambda some, v: np.where(some > 0, v, np.nan)
    all_sales = none(add(every, known.astype(float)), add(every, value))
    in_sales = none(add(every, (known | ~inside).astype(float)), in_sales)
    # means of comparable in-stock days: period and weekday, period, key
    cell, i = row * 12 + index % 12, np.flatnonzero(inside)
    seen = np.stack([np.bincount(cell[i], _weekday_days(first[i], days[i], k), n * 12) for k in range(7)], 1)
    sold = np.bincount(cell[i] * 7 + (first[i] - _ANCHOR) % 7, value[i], n * 84).reshape(-1, 7)
    with np.errstate(divide="ignore", invalid="ignore"):
        by_day, by_period = sold / seen, sold.sum(1) / seen.sum(1)
        by_key = sold.reshape(n, -1).sum(1) / seen.reshape(n, -1).sum(1)
    by_period = np.where(np.isnan(by_period), np.repeat(by_key, 12), by_period)
    mean = np.where(np.isnan(by_day), by_period[:, None], by_day)
    o = np.flatnonzero(out == OUT)
    lost = sum(_weekday_days(first[o], days[o], k) * mean[cell[o], k] for k in range(7)) if len(o) else np.zeros(0)
    key = np.repeat(np.arange(n), size)
    ever = ~np.isnan(by_key)
    imputed = np.bincount(place[o], lost, total)
    demand = np.where(ever[key], in_sales + imputed, all_sales)
    return key, low[key] + np.arange(total) - begin[key], count, censored, all_sales, in_sales, demand, ever


_DAY = ("doc_date", "sales", "stockout", "gap_days", "gap_out")
_PERIOD_DDL = "r_index int, days bigint, stockout_days bigint, demand_leave double, demand_discard double, demand_v1 double"


def unconstrain_periods(mov: DataFrame, threshold: float = 0.0, key=KEY, digits: int = 6) -> DataFrame:
    """H4 on calendar days, summed by key and retail period: ``demand_leave`` takes sales as they
    are, ``demand_discard`` only those of in-stock days, ``demand_v1`` gives every stock-out day the
    mean sale of comparable in-stock days (same retail period and weekday, then same period, then
    the key; a key never in stock keeps its sales).

    A key's movement days are one row, as long as its history; its periods are made from them in
    numpy for many keys at once, so they are neither shuffled nor sorted."""
    keyed = _day_lists(mov, threshold, key)
    added = T.StructType.fromDDL(_PERIOD_DDL)
    schema, names = T.StructType([keyed.schema[c] for c in key] + added.fields), [*key, *added.names]

    def run(batches):
        for whole in batches:
            for i in range(0, whole.num_rows, 1000):
                b = whole.slice(i, 1000)
                at, undated, index, days, censored, *sums = _periods_of(b.column("d"))
                yield pa.RecordBatch.from_arrays([
                    *[b.column(c).take(pa.array(at)) for c in key], pa.array(index, pa.int32(), mask=undated), pa.array(days, pa.int64(), mask=undated),
                    pa.array(censored, pa.int64(), from_pandas=True), *[pa.array(x, pa.float64(), from_pandas=True) for x in sums]], names)

    x = keyed.mapInArrow(run, schema)
    return x.select(*key, cal.fdiv("r_index", 12).alias("r_year"), (F.pmod("r_index", F.lit(12)) + 1).cast("int").alias("r_period"), "days",
                    "stockout_days", "demand_leave", "demand_discard", F.round("demand_v1", digits).alias("demand_v1"))


def _day_lists(mov: DataFrame, threshold: float, key) -> DataFrame:
    return stock_history(mov, threshold, key).groupBy(*key).agg(F.collect_list(F.struct(*_DAY)).alias("d"))


def _periods_of(col):
    """The rows of ``unconstrained`` for a column of day lists: place of the key, whether the row is that
    of movements without a date (which no other row looks at), and the columns; nan is null."""
    n, days = len(col), col.flatten()
    row = np.repeat(np.arange(n), np.asarray(pc.list_value_length(col), np.int64))
    field = lambda name: pc.struct_field(days, name)
    state = lambda name: np.asarray(pc.fill_null(field(name).cast(pa.int8()), UNKNOWN))
    dated = np.asarray(field("doc_date").is_valid())
    day = np.asarray(pc.fill_null(field("doc_date").cast(pa.int32()), 0)).astype(np.int64)
    out, gap_out, gap = state("stockout"), state("gap_out"), np.asarray(field("gap_days")).astype(np.int64)
    sales = field("sales").to_numpy(zero_copy_only=False).astype(float)
    key, index, count, censored, leave, discard, demand, ever = unconstrained(
        *(x[dated] for x in (row, day, out, sales, gap, gap_out)), n)
    r, o, s = row[~dated], out[~dated], sales[~dated]
    own, none, join = np.where(o == IN, s, 0.0), np.zeros(len(r), np.int64), lambda *x: np.concatenate(x)
    return (join(key, r), join(np.zeros(len(key), bool), none == 0), join(index, none), join(count, none), join(censored, np.where(o == OUT, np.nan, 0.0)),
            join(leave, s), join(discard, own), join(demand, np.where(~ever[r], s, np.where(o == OUT, np.nan, own))))


_KPI_DDL = ("stockout_days bigint, days bigint, sales double, unit_days double, on_hand double, cycle_service_level double, "
            "demand_v1 array<double>")


def service_kpis(mov: DataFrame, threshold: float = 0.0, key=KEY, digits: int = 6) -> DataFrame:
    """H17 over calendar days: stock-out rate, fill rate (sales / unconstrained demand), cycle
    service level (share of receipt-to-receipt cycles without a stock-out day), weeks of cover and
    turnover (sales / mean stock).

    Cycles and periods (H4) of a key are made in numpy from one list of its movement days, so the journal is
    put together once and its days are shuffled no further."""
    keyed = cycle_history(mov, threshold, key)
    for c in key:
        keyed = keyed.filter(F.col(c).isNotNull())
    added = T.StructType.fromDDL(_KPI_DDL)
    schema, names = T.StructType([keyed.schema[c] for c in key] + added.fields), [*key, *added.names]

    def run(batches):
        for whole in batches:
            for i in range(0, whole.num_rows, 1000):
                b = whole.slice(i, 1000)
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in key], *_kpis_of(b.column("d"))], names)

    # each period's demand is rounded as H4 gives it
    demand = F.aggregate("demand_v1", F.lit(None).cast("double"), lambda a, v: F.coalesce(a + F.round(v, 6), F.round(v, 6), a))
    return keyed.mapInArrow(run, schema).withColumn("demand_v1", demand).select(
        *key, F.round(F.col("stockout_days") / F.col("days"), digits).alias("stockout_rate"),
        F.round(F.try_divide(F.col("sales"), F.col("demand_v1")), digits).alias("fill_rate"),
        F.round("cycle_service_level", digits).alias("cycle_service_level"),
        F.round(F.try_divide(F.col("on_hand"), F.col("sales") / F.col("days") * 7), digits).alias("weeks_of_cover"),
        F.round(F.try_divide(F.col("sales"), F.col("unit_days") / F.col("days")), digits).alias("turnover"))


def _kpis_of(col) -> list:
    """The columns of ``_KPI_DDL`` for a column of day lists with cycles; null where nothing is known."""
    n, days = len(col), col.flatten()
    size = np.asarray(pc.list_value_length(col), np.int64)
    row = np.repeat(np.arange(n), size)
    field = lambda name: pc.struct_field(days, name)
    state = lambda name: np.asarray(pc.fill_null(field(name).cast(pa.int8()), UNKNOWN))
    number = lambda name: field(name).to_numpy(zero_copy_only=False).astype(float)
    out, gap_out, sales, on_hand = state("stockout"), state("gap_out"), number("sales"), number("on_hand")
    length = np.asarray(field("gap_days")).astype(np.int64) + 1

    def total(r, v):
        known = ~np.isnan(v)
        return np.where(np.bincount(r[known], minlength=n) > 0, np.bincount(r[known], v[known], n), np.nan)

    # a cycle counts where one of its days was out of stock or one is known not to have been
    cycle = np.asarray(field("cycle")).astype(np.int64)
    width = int(cycle.max(initial=0)) + 1
    cycles, of = np.unique(row * width + cycle, return_inverse=True)
    had = (out == OUT) | (gap_out == OUT)
    had_out = np.bincount(of, had, len(cycles)) > 0
    known = np.bincount(of, had | ((out == IN) & (gap_out == IN)), len(cycles)) > 0
    count, bad = (np.bincount(cycles // width, x, n) for x in (known, had_out))
    with np.errstate(divide="ignore", invalid="ignore"):
        level = 1 - np.where(count > 0, bad / count, np.nan)
    # the stock after the last day; a day without a date comes first
    day = np.where(np.asarray(field("doc_date").is_valid()), np.asarray(pc.fill_null(field("doc_date").cast(pa.int32()), 0)).astype(np.int64), -2 ** 62)
    last = np.lexsort((day, row))[np.cumsum(size) - 1]
    at, _, _, _, censored, _, _, demand = _periods_of(col)
    order = np.argsort(at, kind="stable")
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.bincount(at, minlength=n))), pa.int32()),
                                     pa.array(demand[order], pa.float64(), from_pandas=True))
    null_nan = lambda x, kind=pa.float64(): pa.array(x, kind, from_pandas=True)
    return [null_nan(total(at, censored), pa.int64()), pa.array(np.bincount(row, length, n).astype(np.int64)), null_nan(total(row, sales)),
            null_nan(total(row, on_hand * length)), null_nan(on_hand[last]), null_nan(level), lists]


# -- statistical fits, batched over the keys of an Arrow batch --------------------------------------

_erfc = np.frompyfunc(math.erfc, 1, 1)
_inv_cdf = np.frompyfunc(NormalDist().inv_cdf, 1, 1)
SMALLEST = 1e-12


def normal_sf(a: np.ndarray) -> np.ndarray:
    return 0.5 * _erfc(np.asarray(a, float) / math.sqrt(2)).astype(float)


def normal_pdf(a: np.ndarray) -> np.ndarray:
    return np.exp(-0.5 * a * a) / math.sqrt(2 * math.pi)


def _combined(x: np.ndarray, censored: np.ndarray, weight: np.ndarray, row: np.ndarray):
    """Equal observations of a key as one with their weights added, and where each one went."""
    order = np.lexsort((censored, x, row))
    new = np.ones(len(x), bool)
    new[1:] = (np.diff(row[order]) != 0) | (np.diff(x[order]) != 0) | (censored[order][1:] != censored[order][:-1])
    group = np.cumsum(new) - 1
    back = np.empty(len(x), np.int64)
    back[order] = group
    first = order[new]
    return x[first], censored[first], np.bincount(back, weight, len(first)), row[first], back


def _start(x, censored, weight, row, n):
    seen = np.where(censored, 0.0, weight)
    count = np.bincount(row, seen, n)
    safe = np.maximum(count, 1e-300)
    mu = np.bincount(row, seen * x, n) / safe
    sd = np.sqrt(np.maximum(np.bincount(row, seen * (x - mu[row]) ** 2, n) / safe, 1e-12))
    return seen, count, mu, np.maximum(sd, 1e-6)


def censored_normal(x: np.ndarray, censored: np.ndarray, weight: np.ndarray, row: np.ndarray, n: int, iters: int, tol: float = 0.0):
    """EM for many keys at once: normal demand whose censored observations are lower bounds.

    ``row`` is the key of each weighted observation. Every key has its own end: it rests once its mean
    and deviation move by at most ``tol``, so its result is the same alone and in any batch. Returns
    mean and deviation of each key and the expected demand of each observation; keys without
    observations in stock have nan.
    """
    every, x, censored, weight, row, back = (x, *_combined(np.asarray(x, float), censored, weight, row))
    seen, count, mu, sd = _start(x, censored, weight, row, n)
    all_ = np.maximum(np.bincount(row, weight, n), 1e-300)
    inside, squares = np.bincount(row, seen * x, n), np.bincount(row, seen * x * x, n)
    filled = x.copy()
    c = np.flatnonzero(censored & (count > 0)[row])
    for _ in range(iters):
        if not len(c):
            break
        r, m, s = row[c], mu[row[c]], sd[row[c]]
        lam = normal_pdf((x[c] - m) / s) / np.maximum(normal_sf((x[c] - m) / s), SMALLEST)
        filled[c] = m + s * lam
        second = np.bincount(r, weight[c] * (m * m + s * s + s * (x[c] + m) * lam), n)
        busy = np.zeros(n, bool)
        busy[r] = True
        new = (inside + np.bincount(r, weight[c] * filled[c], n)) / all_
        new_sd = np.sqrt(np.maximum((squares + second) / all_ - new * new, 1e-12))
        moved = np.maximum(np.abs(new - mu), np.abs(new_sd - sd))
        mu, sd = np.where(busy, new, mu), np.where(busy, new_sd, sd)
        c = c[(moved > tol)[r]]
    mu, sd = np.where(count > 0, mu, np.nan), np.where(count > 0, sd, np.nan)
    return mu, sd, np.where(np.isnan(mu[row]), x, np.maximum(filled, x))[back]


def censored_likelihood(x: np.ndarray, censored: np.ndarray, weight: np.ndarray, row: np.ndarray, n: int, iters: int = 100, tol: float = 1e-10):
    """The maximum of the censored normal likelihood of many keys, by Newton steps.

    In g = 1 / deviation and d = mean / deviation the likelihood is concave, so Newton with halved steps
    finds its one maximum: at most ``iters`` steps of two sums a key, each key with its own end (a step
    below ``tol`` of its size). Returns what ``censored_normal`` does. A key all of whose observations
    in stock are equal has no maximum; it keeps their value and the least deviation.
    """
    x, censored, weight, row, back = _combined(np.asarray(x, float), censored, weight, row)
    seen, count, mu, sd = _start(x, censored, weight, row, n)
    g, d = 1 / sd, mu / sd
    own = lambda v, r: np.bincount(r, v, n)

    def likelihood(g, d, k):
        z = g[row[k]] * x[k] - d[row[k]]
        tail = np.log(np.maximum(normal_sf(z), 1e-300))
        return own(weight[k] * np.where(censored[k], tail, np.log(np.maximum(g[row[k]], 1e-300)) - z * z / 2), row[k])

    active = (count > 0) & (sd > 1e-5) & (own(weight * censored, row) > 0)
    for _ in range(iters):
        k = np.flatnonzero(active[row])
        if not len(k):
            break
        r, xk, w, out = row[k], x[k], weight[k], censored[k]
        z = g[r] * xk - d[r]
        lam = np.where(out, normal_pdf(z) / np.maximum(normal_sf(z), 1e-300), 0.0)
        lam = np.where(out & (z > 30), z + 1 / np.maximum(z, 1), lam)
        bend = lam * (lam - z)
        inside = np.where(out, 0.0, w)
        grad_d = own(inside * z + w * lam, r)
        grad_g = own(inside * (1 / g[r] - z * xk) - w * xk * lam, r)
        dd = -own(inside + w * bend, r)
        dg = own(inside * xk + w * xk * bend, r)
        gg = -own(inside * (1 / g[r] ** 2 + xk * xk) + w * xk * xk * bend, r)
        det = np.where(active, dd * gg - dg * dg, 1.0)
        det = np.where(np.abs(det) > 1e-300, det, 1e-300)
        step_d, step_g = -(gg * grad_d - dg * grad_g) / det, -(dd * grad_g - dg * grad_d) / det
        size, before = np.ones(n), likelihood(g, d, k)
        for _ in range(40):
            new_g, new_d = g + size * step_g, d + size * step_d
            worse = active & ((new_g <= 0) | ~(likelihood(np.where(new_g > 0, new_g, g), new_d, k) >= before - 1e-12 * np.abs(before)))
            if not worse.any():
                break
            size[worse] /= 2
        ok = active & ~worse
        g, d = np.where(ok, np.minimum(g + size * step_g, 1e6), g), np.where(ok, d + size * step_d, d)
        active = ok & (np.maximum(np.abs(size * step_g) / g, np.abs(size * step_d) / np.maximum(np.abs(d), 1)) > tol)
    mu, sd = np.where(count > 0, d / g, np.nan), np.where(count > 0, 1 / g, np.nan)
    z = np.where(censored, (x - mu[row]) / sd[row], 0.0)
    up = mu[row] + sd[row] * normal_pdf(z) / np.maximum(normal_sf(z), SMALLEST)
    filled = np.where(censored & ~np.isnan(mu[row]), np.maximum(np.where(z > 30, x, up), x), x)
    return mu, sd, filled[back]


def projection_detruncation(x: np.ndarray, censored: np.ndarray, weight: np.ndarray, row: np.ndarray, n: int, tau: float, iters: int) -> np.ndarray:
    """Expected demand of each observation: censored ones rise to the conditional tau-quantile above
    their value under a normal fit, until nothing of the key moves."""
    x, censored, weight, row, back = _combined(np.asarray(x, float), censored, weight, row)
    y = x.copy()
    c = np.flatnonzero(censored)
    all_ = np.maximum(np.bincount(row, weight, n), 1e-300)
    for _ in range(iters):
        if not len(c):
            break
        mu = np.bincount(row, weight * y, n) / all_
        sd = np.maximum(np.sqrt(np.maximum(np.bincount(row, weight * (y - mu[row]) ** 2, n) / all_, 0)), 1e-6)
        m, s = mu[row[c]], sd[row[c]]
        tail = np.clip((1 - tau) * normal_sf((x[c] - m) / s), 1e-15, 1 - 1e-15)
        new = np.maximum(m - s * _inv_cdf(tail).astype(float), x[c])
        moved = np.zeros(n, bool)
        moved[row[c][~np.isclose(new, y[c])]] = True
        y[c] = new
        c = c[moved[row[c]]]
    return y[back]


def smoothed_rates(sales: np.ndarray, out: np.ndarray, gap: np.ndarray, off: np.ndarray, alpha: float) -> np.ndarray:
    """Exponentially smoothed daily sale of each key over its in-stock days, in order; nan without one.

    Key i has the movement days off[i] to off[i + 1], each followed by ``gap`` in-stock days of no sale;
    ``out`` marks movement days out of stock. Smoothing is a weighted sum: a day's weight is alpha times
    (1 - alpha) to the number of in-stock days behind it (the first day has no factor alpha), so all
    days of all keys are added up at once."""
    n = len(off) - 1
    row = np.repeat(np.arange(n), np.diff(off))
    days = np.stack([np.where(out, 0, 1), gap], 1).ravel()           # in-stock days: the movement day, then its gap
    upto = np.concatenate([[0], np.cumsum(days)])
    first, last = upto[2 * off[:-1]], upto[2 * off[1:]]
    own = np.flatnonzero(~out)
    behind = last[row[own]] - upto[2 * own + 1]
    at_start = upto[2 * own] == first[row[own]]                      # the key's first in-stock day sets the level
    level = np.bincount(row[own], np.where(at_start, 1.0, alpha) * sales[own] * (1 - alpha) ** behind, n)
    return np.where(last > first, level, np.nan)


def smoothed_rate(days: list[list[dict]], alpha: float) -> np.ndarray:
    """``smoothed_rates`` of lists of days as dicts."""
    flat = [d for own in days for d in own]
    off = np.concatenate([[0], np.cumsum([len(d) for d in days])]).astype(np.int64)
    return smoothed_rates(np.array([d["sales"] for d in flat], float), np.array([d["stockout"] for d in flat], bool),
                          np.array([0 if d["gap_out"] else d["gap_days"] for d in flat], np.int64), off, alpha)


FIT_DDL = ("in_stock_days bigint, stockout_days bigint, sales double, method string, mu double, sigma double, "
           "demand_em double, demand_pd double, demand_proportional double")


def unconstrain_fits(mov: DataFrame, threshold: float = 0.0, key=KEY, iters: int = 50, tau: float = 0.5, alpha: float = 0.1,
                     long_history: int = 180, high_censoring: float = 0.5, heavy_censoring: float = 0.9, with_pd: bool = True) -> DataFrame:
    """Unconstrained demand of each key over all calendar days.

    ``method`` names the rule that ``demand_em`` follows: ``em`` for a long history in stock,
    ``mle`` (the maximum of the censored likelihood) where many days are censored, and
    ``smoothing`` for a short history or where nearly all is censored. ``demand_pd`` is projection
    detruncation (null without ``with_pd``), ``demand_proportional`` scales the in-stock sales to all
    days. Every key is fitted on its own, so its row does not depend on its batch. A key's observations
    are its movement days and gaps, so a row is as long as its movement days.
    """
    h = stock_history(mov, threshold, key)
    days = h.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("doc_date", "sales", "stockout", "gap_days", "gap_out"))).alias("d"))
    added = T.StructType.fromDDL(FIT_DDL)
    schema, names = T.StructType([days.schema[c] for c in key] + added.fields), [*key, *added.names]

    def run(batches):
        for whole in batches:
            for i in range(0, whole.num_rows, 2000):
                b = whole.slice(i, 2000)
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in key], *fit(b.column("d"))], names)

    def of_keys(which, x, out, weight, row, solve):
        """Mean, deviation and summed demand of the chosen keys; nan for the others."""
        mu, sd, demand = np.full((3, len(which)), np.nan)
        use = which[row]
        own = (np.cumsum(which) - 1)[row[use]]
        k = int(which.sum())
        if k:
            mu[which], sd[which], filled = solve(x[use], out[use], weight[use], own, k)
            demand[which] = np.bincount(own, weight[use] * filled, k)
        return mu, sd, demand

    def fit(col):
        n = len(col)
        off = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(col), np.int64))])
        days = col.flatten()
        field = lambda name, kind: np.asarray(pc.struct_field(days, name)).astype(kind)
        sold, own_out, gap, gap_out = field("sales", float), field("stockout", bool), field("gap_days", np.int64), field("gap_out", bool)
        # a movement day is one observation, its gap another of as many days
        row = np.repeat(np.repeat(np.arange(n), np.diff(off)), 2)
        x, out = np.stack([sold, np.zeros(len(sold))], 1).ravel(), np.stack([own_out, gap_out], 1).ravel()
        weight = np.stack([np.ones(len(gap)), gap], 1).ravel().astype(float)
        some = weight > 0
        x, out, weight, row = x[some], out[some], weight[some], row[some]
        add = lambda v: np.bincount(row, v, n)
        inside, censored = add(np.where(out, 0.0, weight)), add(np.where(out, weight, 0.0))
        sales, in_sales = add(x * weight), add(np.where(out, 0.0, x * weight))
        share = censored / np.maximum(inside + censored, 1)
        smooth = (inside < long_history) | (share > heavy_censoring)
        mle = ~smooth & (share > high_censoring)
        mu, sd, demand = of_keys(~smooth & ~mle, x, out, weight, row, lambda *o: censored_normal(*o, iters))
        mu2, sd2, demand_mle = of_keys(mle, x, out, weight, row, censored_likelihood)
        level = smoothed_rates(sold, own_out, np.where(gap_out, 0, gap), off, alpha)
        by_rate = in_sales + censored * np.where(np.isnan(level), 0.0, level)
        pd_ = add(weight * projection_detruncation(x, out, weight, row, n, tau, 20)) if with_pd else np.full(n, np.nan)
        method = np.where(smooth, "smoothing", np.where(mle, "mle", "em"))
        pick = lambda a, b, c: np.where(smooth, a, np.where(mle, b, c))
        none = lambda v: pa.array(v, pa.float64(), from_pandas=True)
        return [pa.array(inside.astype(np.int64)), pa.array(censored.astype(np.int64)), pa.array(sales), pa.array(method.tolist(), pa.string()),
                none(pick(level, mu2, mu)), none(pick(np.nan, sd2, sd)), pa.array(pick(np.maximum(by_rate, sales), demand_mle, demand)), none(pd_),
                none(np.where(inside > 0, in_sales / np.maximum(inside, 1) * (inside + censored), np.nan))]

    # these rows cost CPU, not bytes: an explicit number of partitions, which AQE does not merge
    n = int(mov.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return days.repartition(n, *key).mapInArrow(run, schema)


def _item_periods(col, digits: int):
    """The periods of each item in order, summed over the day lists of its warehouses."""
    item = np.repeat(np.arange(len(col)), np.asarray(pc.list_value_length(col), np.int64))
    at, undated, index, _, censored, raw, _, adj = _periods_of(col.flatten())
    adj = np.floor(adj * 10 ** digits + 0.5) / 10 ** digits
    order = np.lexsort((index, ~undated, item[at]))  # a row without a period comes first
    own, p, none = item[at][order], index[order], undated[order]
    new = np.ones(len(own), bool)
    new[1:] = (np.diff(own) != 0) | (np.diff(p) != 0) | (none[1:] != none[:-1])
    group, n = np.cumsum(new) - 1, int(new.sum())

    def total(x, kind):
        x, seen = x[order], ~np.isnan(x[order])
        some = np.bincount(group, seen, n) > 0
        return pa.array(np.bincount(group, np.where(seen, x, 0.0), n).astype(kind), mask=~some)

    entries = pa.StructArray.from_arrays([pa.array(p[new], pa.int32(), mask=none[new]), total(raw, float), total(adj, float), total(censored, np.int64)],
                                         ["p", "raw", "adj", "out"])
    ends = np.searchsorted(own[new], np.arange(len(col) + 1))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries)


def two_stage(mov: DataFrame, alpha: float = 0.3, digits: int = 6) -> DataFrame:
    """Per item, smoothing forecasts (SES, one retail period ahead) from raw and from
    unconstrained demand, both zero-filled over all periods since the item's first movement, and
    their errors on the same actuals: the sales of periods without any stock-out day."""
    item = ["company", "item_code"]
    # the day lists of an item's warehouses meet, not their periods, which are many more
    days = _day_lists(mov, 0.0, KEY).groupBy(*item).agg(F.collect_list("d").alias("d"))
    schema = T.StructType([*[days.schema[c] for c in item], T.StructField("s", T.ArrayType(T.StructType.fromDDL("p int, raw double, adj double, out bigint")))])

    def run(batches):
        for whole in batches:
            for i in range(0, whole.num_rows, 500):
                b = whole.slice(i, 500)
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in item], _item_periods(b.column("d"), digits)], schema.names)

    a = days.mapInArrow(run, schema)
    zero = F.lit(0.0)
    start = F.struct(F.lit(None).cast("double").alias("lr"), F.lit(None).cast("double").alias("la"), F.lit(0).alias("n"),
                     *[zero.alias(c) for c in ("er", "ea", "ar", "aa", "y")])

    def step(acc, e):
        known = acc["lr"].isNotNull() & (e["out"] == 0)
        more = lambda name, v: (acc[name] + F.when(known, v).otherwise(zero)).alias(name)
        level = lambda name, v: F.when(acc[name].isNull(), v).otherwise(acc[name] + alpha * (v - acc[name])).alias(name)
        dr, da = acc["lr"] - e["raw"], acc["la"] - e["raw"]
        return F.struct(level("lr", e["raw"]), level("la", e["adj"]), (acc["n"] + known.cast("int")).alias("n"),
                        more("er", dr), more("ea", da), more("ar", F.abs(dr)), more("aa", F.abs(da)), more("y", e["raw"]))

    r = a.select(*item, F.aggregate("s", start, step).alias("t")).where("t.n > 0")
    off_tie = lambda x: F.round(x + 1e-9, digits)  # noqa: E731  else the last bit of a sum decides a half
    return r.select(*item, F.col("t.n").alias("periods"), off_tie(F.col("t.er") / F.col("t.n")).alias("bias_raw"),
                    off_tie(F.col("t.ea") / F.col("t.n")).alias("bias_unconstrained"),
                    off_tie(F.try_divide(F.col("t.ar"), F.col("t.y"))).alias("wmape_raw"),
                    off_tie(F.try_divide(F.col("t.aa"), F.col("t.y"))).alias("wmape_unconstrained"))
