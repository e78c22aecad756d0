"""Ordered scans over long time series without a single-partition window.

A running sum or ``lag`` over one series (e.g. one host's samples, or all runs) would put the
whole series into one task. These helpers split the series into time buckets: the ordered
window runs inside ``(series, bucket)``, and only one summary row per bucket crosses bucket
boundaries. The per-series window over bucket summaries holds ``time span / bucket width``
rows, which depends on the time range, not on the data volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

DEFAULT_BUCKET_SECONDS = 3600


def time_bucket(ts, seconds: int = DEFAULT_BUCKET_SECONDS) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    micros = F.unix_micros(c.cast("timestamp"))
    return F.floor(micros / (seconds * 1_000_000)).cast("bigint")


def running_sum(df: DataFrame, by: list[str], order: list[str], value: str, out: str,
                ts: str | None = None, bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """``out`` = inclusive running sum of ``value`` per ``by`` in ``order`` (first = timestamp)."""
    ts = ts or order[0]
    b = "_bucket"
    x = df.withColumn(b, time_bucket(ts, bucket_seconds))
    w_in = Window.partitionBy(*by, b).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("_intra", F.sum(value).over(w_in))
    totals = x.groupBy(*by, b).agg(F.sum(value).alias("_total"))
    w_b = Window.partitionBy(*by).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_offset", F.coalesce(F.sum("_total").over(w_b), F.lit(0))).drop("_total")
    return (x.join(offsets, on=[*by, b]).withColumn(out, F.col("_offset") + F.col("_intra"))
             .drop(b, "_intra", "_offset"))


def lag_values(df: DataFrame, by: list[str], order: list[str], cols: list[str], prefix: str = "prev_",
               ts: str | None = None, bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """``prefix+c`` = value of ``c`` on the previous row of the series (null on the first row)."""
    ts = ts or order[0]
    b = "_bucket"
    x = df.withColumn(b, time_bucket(ts, bucket_seconds))
    w_in = Window.partitionBy(*by, b).orderBy(*order)
    for c in cols:
        x = x.withColumn("_in_" + c, F.lag(c).over(w_in))
    x = x.withColumn("_first", F.row_number().over(w_in) == 1)
    last = x.groupBy(*by, b).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("_last"))
    w_b = Window.partitionBy(*by).orderBy(b)
    prev_last = last.withColumn("_prev_last", F.lag("_last").over(w_b)).drop("_last")
    y = x.join(prev_last, on=[*by, b])
    for c in cols:
        y = y.withColumn(prefix + c, F.when(F.col("_first"), F.col("_prev_last").getField(c))
                         .otherwise(F.col("_in_" + c))).drop("_in_" + c)
    return y.drop(b, "_first", "_prev_last")


def prefix_max(events: DataFrame, by: list[str], ts: str, delta: str, out: str,
               bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Max over time of the running sum of ``delta`` per ``by`` (sweep line), bucketed.

    Deltas are first summed per distinct timestamp, so simultaneous events net out and a
    hot instant is one row.
    """
    per_ts = events.groupBy(*by, ts).agg(F.sum(delta).alias("_d"))
    b = "_bucket"
    x = per_ts.withColumn(b, time_bucket(ts, bucket_seconds))
    w_in = Window.partitionBy(*by, b).orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("_intra", F.sum("_d").over(w_in))
    per_b = x.groupBy(*by, b).agg(F.sum("_d").alias("_total"), F.max("_intra").alias("_max_intra"))
    w_b = Window.partitionBy(*by).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    per_b = per_b.withColumn("_offset", F.coalesce(F.sum("_total").over(w_b), F.lit(0)))
    return per_b.groupBy(*by).agg(F.max(F.col("_offset") + F.col("_max_intra")).alias(out))


VALUE_STEPS = 16  # value buckets for each factor of e


def value_bucket(value, steps: int = VALUE_STEPS) -> Column:
    """A bucket number that grows with the value: even steps of its logarithm, either side of 0."""
    v = F.col(value) if isinstance(value, str) else value
    return (F.signum(v) * F.floor(F.log1p(F.abs(v)) * steps)).cast("int")


def running_by_value(df: DataFrame, by: list[str], value: str, ties: list[str], add: str, out: str, total: str,
                     desc: bool = True) -> DataFrame:
    """``out``: inclusive running sum of ``add`` per ``by`` in order of ``value`` (ties by the columns
    ``ties``); ``total``: the sum of the whole group.

    A group is split into value buckets, so no task sorts a whole group; only bucket totals, whose
    number follows the range of the values, are summed across buckets."""
    b = "_bucket"
    way = F.desc if desc else F.asc
    x = df.withColumn(b, value_bucket(value))
    w_in = Window.partitionBy(*by, b).orderBy(way(value), *ties).rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("_intra", F.sum(add).over(w_in))
    totals = x.groupBy(*by, b).agg(F.sum(add).alias("_sum"))
    group = Window.partitionBy(*by)
    ordered = group.orderBy(way(b)).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*by, b, F.coalesce(F.sum("_sum").over(ordered), F.lit(0)).alias("_offset"), F.sum("_sum").over(group).alias(total))
    return x.join(totals, on=[*by, b]).withColumn(out, F.col("_offset") + F.col("_intra")).drop(b, "_intra", "_offset")


def exact_percentiles(df: DataFrame, by: list[str], value: str, wanted: dict[str, float]) -> DataFrame:
    """Percentiles (name -> fraction) by linear interpolation, as ``percentile`` gives them, without a
    buffer that holds all of a group's values: equal values are counted first, and the values around
    the wanted positions are found by one pass of running counts over value buckets. Groups without
    any value are left out."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"))
    x = running_by_value(counts, by, value, [], "_n", "_upto", "_total", desc=False)
    at = {k: (F.col("_total") - 1) * F.lit(q) for k, q in wanted.items()}
    holds = lambda p: (F.col("_upto") > p) & (F.col("_upto") - F.col("_n") <= p)
    g = x.groupBy(*by).agg(*[c for k, p in at.items() for c in (
        F.max(p).alias(f"_at_{k}"), F.max(F.when(holds(F.floor(p)), F.col(value))).alias(f"_low_{k}"),
        F.max(F.when(holds(F.ceil(p)), F.col(value))).alias(f"_high_{k}"))])
    return g.select(*by, *[(F.col(f"_low_{k}") + (F.col(f"_at_{k}") - F.floor(f"_at_{k}")) * (F.col(f"_high_{k}") - F.col(f"_low_{k}"))).alias(k)
                           for k in wanted])


def exact_percentile(df: DataFrame, by: list[str], value: str, q: float, out: str) -> DataFrame:
    """``exact_percentiles`` for one fraction."""
    return exact_percentiles(df, by, value, {out: q})


# -- interval joins by dyadic cells -------------------------------------------------------------------

TOP_LEVEL = 13  # largest cells: 2 ** 13 of the smallest (341 days of hours)


def dyadic_cover(first, last, top: int = TOP_LEVEL) -> Column:
    """The cells ``struct<level, cell>`` that make up the smallest cells ``first`` to ``last`` (bigint).

    Cell c of level k holds the smallest cells c * 2 ** k to (c + 1) * 2 ** k - 1. The cover is that of
    a segment tree: at level k there is a cell at the left where ceil(first / 2 ** k) is odd and one at
    the right where floor((last + 1) / 2 ** k) is, so an interval of n cells has at most 2 log2(n) of
    them; beyond level ``top`` the rest is cells of that level."""
    def ends(k):
        left = F.negative(F.call_function("shiftright", F.negative(first), k))
        return left, F.call_function("shiftright", last + 1, k)

    def cell(k, c):
        return F.struct(k.cast("int").alias("level"), c.alias("cell"))

    def at(k):
        left, right = ends(k)
        odd_left = (left < right) & (F.pmod(left, F.lit(2)) == 1)
        odd_right = (left + odd_left.cast("bigint") < right) & (F.pmod(right, F.lit(2)) == 1)
        return F.array_compact(F.array(F.when(odd_left, cell(k, left)), F.when(odd_right, cell(k, right - 1))))

    n = F.greatest(last - first + 1, F.lit(1))
    deepest = F.least(F.floor(F.log2(n.cast("double"))).cast("int") + 1, F.lit(top))  # no cell is larger than the interval
    none = F.array().cast("array<struct<level: int, cell: bigint>>")
    below = F.flatten(F.transform(F.sequence(F.lit(0), deepest - 1), at)) if top > 0 else none
    left, right = ends(deepest)
    rest = F.when(left < right, F.transform(F.sequence(left, right - 1), lambda c: cell(deepest, c))).otherwise(none)
    return F.when(first <= last, F.concat(below, rest)).otherwise(none)


def dyadic_cells(cell, levels) -> Column:
    """The cells ``struct<level, cell>`` of the given levels that hold one smallest cell."""
    return F.array(*[F.struct(F.lit(k).alias("level"), F.call_function("shiftright", cell, F.lit(k)).alias("cell")) for k in levels])
