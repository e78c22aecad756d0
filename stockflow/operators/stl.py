"""Seasonal-trend decomposition by loess (H33, STL) for many series at once.

Spark deals out the series, one row with the item's zero-filled demand array each (H5); a task
decomposes the rows of an Arrow batch together, as numpy matrices of series x periods. Shorter series
are padded on the right and every step knows each row's own length, so a series has the same result
alone and in any batch.

The inner loop smooths the cycle-subseries of the detrended series, takes the low-pass part out of
them, and smooths what is left without the season for the trend. The outer loop weights points down by
the size of their remainder (bisquare, six median absolute remainders), so single outliers move neither
trend nor season.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.operators.demand import ITEM

CELLS = 1 << 17  # numbers in one matrix of a batch: several of them stay in a core's cache


def _odd(x: float) -> int:
    n = int(np.ceil(x))
    return n + 1 - n % 2


def loess(y: np.ndarray, weight: np.ndarray | None, size: np.ndarray, q: int, first: int = 0, more: int = 0) -> np.ndarray:
    """Local linear fits of rows ``y[i, :size[i]]`` at the places ``first`` to ``width - 1 + more``, each
    from the q nearest points of its row with tricube weights times ``weight`` (None: all ones).

    Windows and tricube weights follow from a row's size alone, so they are made once for all rows of it."""
    out = np.empty((len(y), y.shape[1] + more - first))
    for n in np.unique(size):
        rows = np.flatnonzero(size == n)
        out[rows] = _loess_of_size(y[rows].T, None if weight is None else weight[rows].T, int(n), q, first, more).T
    return out


def _loess_of_size(y: np.ndarray, weight: np.ndarray | None, n: int, q: int, first: int, more: int) -> np.ndarray:
    """``loess`` of columns ``y[:n, i]``. Without weights the sums that do not hold y are the same for all."""
    y = np.ascontiguousarray(y)
    weight = np.ones((len(y), 1)) if weight is None else np.ascontiguousarray(weight)
    at = np.arange(first, len(y) + more)
    span = min(q, n)
    left = np.clip(at - (q - 1) // 2, 0, max(n - span, 0))
    reach = np.maximum(np.maximum(at - left, left + span - 1 - at) + max(q - n, 0) // 2, 1).astype(float)
    s0, s1, s2 = (np.zeros((len(at), weight.shape[1])) for _ in range(3))
    t0, t1 = (np.zeros((len(at), y.shape[1])) for _ in range(2))
    for j in range(span):
        d = (left + j - at).astype(float)
        r = np.abs(d) / reach
        k = np.where(r < 0.999, np.where(r <= 0.001, 1.0, (1 - np.minimum(r, 1) ** 3) ** 3), 0.0)
        d, w = d[:, None], weight[left + j] * k[:, None]
        wy = w * y[left + j]
        s0 += w
        t0 += wy
        w *= d
        s1 += w
        w *= d
        s2 += w
        wy *= d
        t1 += wy
    even = s0 * s2 - s1 * s1
    line = even > 1e-9 * np.maximum(s0 * s2, 1e-300)
    level = np.divide(t0, s0, out=y[np.clip(at, 0, max(n - 1, 0))].astype(float), where=s0 > 0)
    return np.where(line, np.divide(t0 * s2 - t1 * s1, even, out=level.copy(), where=line), level)


def _moving(y: np.ndarray, k: int) -> np.ndarray:
    c = np.concatenate([np.zeros((len(y), 1)), np.cumsum(y, 1)], 1)
    return (c[:, k:] - c[:, :-k]) / k


def _subseries(y: np.ndarray, period: int) -> np.ndarray:
    """Rows (series, place in the cycle) of the points of that place; padded to whole cycles."""
    cycles = -(-y.shape[1] // period)
    full = np.zeros((len(y), cycles * period))
    full[:, : y.shape[1]] = y
    return full.reshape(len(y), cycles, period).transpose(0, 2, 1).reshape(-1, cycles)


def _median(x: np.ndarray, size: np.ndarray) -> np.ndarray:
    x = np.sort(np.where(np.arange(x.shape[1]) < size[:, None], x, np.inf), 1)
    pick = lambda k: np.take_along_axis(x, k[:, None], 1)[:, 0]
    return (pick((size - 1) // 2) + pick(size // 2)) / 2


def stl_matrix(y: np.ndarray, size: np.ndarray, period: int, seasonal: int = 7, trend: int | None = None, inner: int = 2, outer: int = 5):
    """Trend, season and robustness weight of every point of rows ``y[i, :size[i]]``.

    ``seasonal`` and ``trend`` are the loess widths in cycles and in points (odd; the trend's default
    follows from the other two). A row shorter than two cycles has no season.
    """
    n, width = y.shape
    y = np.where(np.arange(width) < size[:, None], y, 0.0)
    trend = trend or _odd(1.5 * period / (1 - 1.5 / seasonal))
    low = _odd(period)
    cyclic = (size >= 2 * period)[:, None]
    own = np.maximum(-(-(size[:, None] - np.arange(period)) // period), 0).ravel()  # points of each subseries
    weight, level, season = None, np.zeros((n, width)), np.zeros((n, width))
    for k in range(outer + 1):
        for _ in range(inner):
            c = loess(_subseries(y - level, period), None if weight is None else _subseries(weight, period), np.maximum(own, 1), seasonal, -1, 1)
            # the value at place j of a subseries stands at (j + 1) * period + its place in the cycle
            c = c.reshape(n, period, -1).transpose(0, 2, 1).reshape(n, -1)[:, : width + 2 * period]
            smooth = loess(_moving(_moving(_moving(c, period), period), 3), None, size, low)
            season = np.where(cyclic, c[:, period: period + width] - smooth, 0.0)
            level = loess(y - season, weight, size, trend)
        if k < outer:
            rest = np.abs(y - level - season)
            h = 6 * _median(rest, size)[:, None]
            u = np.divide(rest, h, out=np.where(rest > 0, 2.0, 0.0), where=h > 0)
            weight = np.where(u <= 0.001, 1.0, np.where(u <= 0.999, (1 - np.minimum(u, 1) ** 2) ** 2, 0.0))
    return level, season, np.ones((n, width)) if weight is None else weight


def stl(arrays: DataFrame, period: int = 13, by=ITEM, seasonal: int = 7, trend: int | None = None, inner: int = 2, outer: int = 5) -> DataFrame:
    """H33 (STL): ``p, qty, trend, seasonal, remainder, weight`` of every period of the demand arrays
    (``first_p``, ``q``; see ``demand_arrays``). trend + seasonal + remainder = qty; ``weight`` is the
    robustness weight, near 0 for an outlier. A null or empty array gives no rows."""
    added = [T.StructField("first_p", T.IntegerType()), T.StructField("q", T.ArrayType(T.DoubleType()))] + [
        T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("trend", "seasonal", "weight")]
    schema = T.StructType([arrays.schema[c] for c in by] + added)

    def run(batches):
        for whole in batches:
            size = np.asarray(pa.compute.list_value_length(whole.column("q")), np.int64)
            order = np.argsort(size, kind="stable")  # so that a matrix holds few sizes
            whole, size = whole.take(pa.array(order)), size[order]
            step = max(1, CELLS // int(size.max(initial=1)))
            for i in range(0, whole.num_rows, step):
                b, own = whole.slice(i, step), size[i: i + step]
                y = np.zeros((len(own), int(own.max())))
                inside = np.arange(y.shape[1]) < own[:, None]
                y[inside] = np.asarray(b.column("q").flatten())
                level, season, weight = stl_matrix(y, own, period, seasonal, trend, inner, outer)
                off = pa.array(np.concatenate([[0], np.cumsum(own)]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(off, pa.array(x[inside])) for x in (y, level, season, weight)]
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in by], b.column("first_p"), *lists], schema.names)

    # the fits cost CPU, not bytes: an explicit number of partitions, which AQE does not merge
    n = int(arrays.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (arrays.select(*by, F.col("first_p").cast("int").alias("first_p"), F.col("q").cast("array<double>").alias("q")).where(F.size("q") > 0)
            .repartition(n, *by).mapInArrow(run, schema))
    x = rows.select(*by, "first_p", F.posexplode(F.arrays_zip("q", "trend", "seasonal", "weight")).alias("_i", "x"))
    return x.select(*by, (F.col("first_p") + F.col("_i")).alias("p"), F.col("x.q").alias("qty"), "x.trend", "x.seasonal",
                    (F.col("x.q") - F.col("x.trend") - F.col("x.seasonal")).alias("remainder"), "x.weight")
