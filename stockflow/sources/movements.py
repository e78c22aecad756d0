"""Movement and stock extracts (A1-A4) and movement finalisation (B1)."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.functions.calendar import retail_year
from stockflow.functions.movement_fields import doc_ts, mov_id
from stockflow.schemas import MOVEMENT_COLUMNS, MOVEMENT_SCHEMA, SOURCE_COLUMNS

# fixed values: the companies and the floor date of a first load
COMPANIES = ("COMERCIAL", "HR", "CAP")
FLOOR_DATE = date(2019, 1, 1)


def window_pred(col: str, since, until) -> Column:
    """Half-open ``[since, until)``; either bound may be None."""
    pred = F.lit(True)
    if since is not None:
        pred = pred & (F.col(col) >= F.lit(since))
    if until is not None:
        pred = pred & (F.col(col) < F.lit(until))
    return pred


def read_movements(src: DataFrame, company: str | list[str] | None = None, since=None, until=None) -> DataFrame:
    """A1: the twelve source columns of one company's (or a list's) postings captured in ``[since, until)``.

    ``src`` is any DataFrame with the source columns (parquet, JDBC, the fixture mapping).
    The filters are plain column predicates, so they push into the scan.
    """
    df = src
    if company is not None and "company" in src.columns:
        df = df.filter(F.col("company") == company if isinstance(company, str)
                       else F.col("company").isin(*company))
    df = df.filter(window_pred("create_date", since, until))
    cols = (["company"] if "company" in src.columns else []) + list(SOURCE_COLUMNS)
    return df.select(*cols)


def read_stock(src: DataFrame, company: str | None = None) -> DataFrame:
    """A2: on-hand per (item, warehouse); the quantity cast is lenient (bad text -> null)."""
    df = src if company is None else src.filter(F.col("company") == company)
    return df.select(
        F.col("company").cast("string").alias("company"),
        F.col("item_code").cast("string").alias("item_code"),
        F.col("warehouse").cast("string").alias("warehouse"),
        F.col("qty_sap").try_cast("double").alias("qty_sap"),
    )


def union_companies(sources: dict[str, DataFrame], only: list[str] | None = None) -> DataFrame:
    """A3: run the same extract for every company database, tagged, as one parallel plan."""
    chosen = [c for c in sources if only is None or c in only]
    if not chosen:
        raise ValueError("no company selected")
    frames = [sources[c].withColumn("company", F.lit(c)) for c in chosen]
    return reduce(lambda a, b: a.unionByName(b), frames)


def empty_movements(spark: SparkSession) -> DataFrame:
    """A4: empty input still has the pinned movement schema."""
    return spark.createDataFrame([], MOVEMENT_SCHEMA)


def finalize(df: DataFrame, company: str | None = None, carry: list[str] | None = None) -> DataFrame:
    """B1: per-column strict / lenient casts, company tag, derived columns, pinned order.

    Strict columns use ``cast`` (ANSI mode raises on bad data); lenient ones use ``try_cast``
    (bad text or overflow becomes null). ``carry`` names further columns to keep behind them.
    """
    comp = F.lit(company) if company is not None else F.col("company").cast("string")
    typed = df.select(
        comp.alias("company"),
        F.col("item_code").cast("string").alias("item_code"),
        F.col("warehouse").cast("string").alias("warehouse"),
        F.col("doc_date").cast("date").alias("doc_date"),
        F.col("doc_time").try_cast("smallint").alias("doc_time"),
        F.col("create_date").cast("date").alias("create_date"),
        F.col("trans_type").try_cast("bigint").alias("trans_type"),
        F.col("base_entry").try_cast("bigint").alias("base_entry"),
        F.col("base_num").try_cast("bigint").alias("base_num"),
        F.col("doc_line").try_cast("bigint").alias("doc_line"),
        F.col("in_qty").try_cast("double").alias("in_qty"),
        F.col("out_qty").try_cast("double").alias("out_qty"),
        F.col("trans_value").try_cast("double").alias("trans_value"),
        *(carry or []),
    )
    out = typed.select(
        "*",
        doc_ts().alias("doc_ts"),
        mov_id().alias("mov_id"),
        retail_year("doc_date").alias("retail_year"),
    )
    return out.select(*MOVEMENT_COLUMNS, *(carry or []))
