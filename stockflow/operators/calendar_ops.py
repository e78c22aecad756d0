"""Calendar DataFrames (C1 as columns, C10 dimension, C11 windows, C12 validation)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.functions import calendar as cal

RETAIL_FIELDS = ("year", "week", "period", "period_name", "quarter", "day_of_week", "week_start", "week_end")


def with_retail_date(df: DataFrame, date_col: str, prefix: str = "r_") -> DataFrame:
    """C1 flattened: add the retail coordinates of ``date_col`` as columns."""
    s = cal.retail_date(date_col)
    return df.select("*", *[s.getField(f).alias(prefix + f) for f in RETAIL_FIELDS])


def calendar_dim(bounds: DataFrame, start_col: str = "start", end_col: str = "end") -> DataFrame:
    """One row per date in ``[start, end]`` (inclusive) with all retail columns.

    ``bounds`` is a one-row DataFrame computed by Spark (e.g. min/max of a date column), so
    nothing passes through the driver; the row count is the number of days, not data size.
    """
    days = bounds.select(F.explode(F.sequence(F.col(start_col).cast("date"), F.col(end_col).cast("date"))).alias("date"))
    return with_retail_date(days, "date", prefix="")


def retail_year_windows(bounds: DataFrame, start_col: str = "start", end_col: str = "end",
                        by: tuple[str, ...] = ()) -> DataFrame:
    """C11: half-open windows; first starts at ``start``, interior ones at retail-year starts,
    the last is clipped to ``end``; none when ``start >= end``."""
    s, e = F.col(start_col).cast("date"), F.col(end_col).cast("date")
    years = F.sequence(cal.retail_year(s).cast("int"), cal.retail_year(F.date_sub(e, 1)).cast("int"))
    x = bounds.filter(s < e).select(*by, s.alias("_s"), e.alias("_e"), F.explode(years).alias("retail_year"))
    ws = F.greatest(F.col("_s"), cal.year_start("retail_year"))
    we = F.least(F.col("_e"), cal.year_start(F.col("retail_year") + 1))
    return x.select(*by, F.col("retail_year").cast("smallint").alias("retail_year"),
                    ws.alias("win_start"), we.alias("win_end")).filter(F.col("win_start") < F.col("win_end"))


def validate_calendar(df: DataFrame, week: str | None = "week", period: str | None = "period",
                      quarter: str | None = "quarter") -> DataFrame:
    """C12 for columns: the job fails on week outside 1..52, period 1..12 or quarter 1..4."""
    out = df
    for c, lo, hi, what in ((week, 1, 52, "week"), (period, 1, 12, "period"), (quarter, 1, 4, "quarter")):
        if c is not None:
            out = out.withColumn(c, cal.checked(c, lo, hi, what))
    return out


def date_bounds(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.min(F.col(col).cast("date")).alias("start"), F.max(F.col(col).cast("date")).alias("end"))
