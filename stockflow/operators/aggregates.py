"""Aggregations over the movement journal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.functions import calendar as cal
from stockflow.operators.enrich import document_name, typical_direction
from stockflow.functions.movement_fields import value_direction

KEY = ["company", "item_code", "warehouse"]
NATURAL_KEY = ["company", "trans_type", "base_entry", "doc_line", "item_code", "warehouse"]


def watermark(mov: DataFrame) -> DataFrame:
    """Last capture date per company (all companies in one aggregate)."""
    return mov.groupBy("company").agg(F.max("create_date").alias("watermark"))


def daily_net(mov: DataFrame, key=KEY, date_col: str = "doc_date") -> DataFrame:
    """In, out and net per key and day. Collapses any hot key to one row per day."""
    return mov.groupBy(*key, date_col).agg(
        F.sum("in_qty").alias("in_qty"), F.sum("out_qty").alias("out_qty"),
        F.sum(F.col("in_qty") - F.col("out_qty")).alias("net_qty"))


def inventory_value(mov: DataFrame, as_of=None, key=KEY, digits: int = 2) -> DataFrame:
    """Running cost value = SUM(trans_value) of movements effective on or before ``as_of``."""
    df = mov if as_of is None else mov.filter(F.col("doc_date") <= F.lit(as_of).cast("date"))
    return df.groupBy(*key).agg(F.round(F.sum("trans_value"), digits).alias("stock_value"))


def movement_mix(mov: DataFrame, digits: int = 2) -> DataFrame:
    """E5: count, quantities and value per document type and value direction."""
    return (mov.groupBy("trans_type", value_direction("trans_value").alias("value_direction"))
               .agg(F.count(F.lit(1)).alias("n"), F.sum("in_qty").alias("in_qty"),
                    F.sum("out_qty").alias("out_qty"), F.round(F.sum("trans_value"), digits).alias("value"))
               .withColumn("document", document_name("trans_type"))
               .withColumn("direction", typical_direction("trans_type")))


def transfer_netting(mov: DataFrame, tol: float = 1e-6, digits: int = 4) -> DataFrame:
    """Transfer documents whose quantity or value does not net to zero."""
    t = mov.filter(F.col("trans_type") == 67).groupBy("company", "base_entry").agg(
        F.round(F.sum(F.col("in_qty") - F.col("out_qty")), digits).alias("net_qty"),
        F.round(F.sum("trans_value"), digits).alias("net_value"), F.count(F.lit(1)).alias("legs"))
    return t.filter((F.abs("net_qty") > tol) | (F.abs("net_value") > tol))


def load_audit(mov: DataFrame) -> DataFrame:
    """Rows per company x load window (retail year of capture), ranges, back-dated share."""
    return (mov.withColumn("load_year", cal.retail_year("create_date"))
               .groupBy("company", "load_year")
               .agg(F.count(F.lit(1)).alias("rows"),
                    F.min("create_date").alias("min_create_date"), F.max("create_date").alias("max_create_date"),
                    F.min("doc_date").alias("min_doc_date"), F.max("doc_date").alias("max_doc_date"),
                    F.count_if(F.col("create_date") > F.col("doc_date")).alias("back_dated"))
               .withColumn("back_dated_share", F.round(F.col("back_dated") / F.col("rows"), 6)))


def mov_id_collisions(mov: DataFrame) -> DataFrame:
    """Natural keys that occur more than once."""
    return (mov.groupBy(*NATURAL_KEY).agg(F.count(F.lit(1)).alias("n"), F.min("mov_id").alias("mov_id"))
               .filter(F.col("n") > 1))


def distinct_counts(mov: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct items, warehouses and documents per retail year and period."""
    wk = cal.retail_week("doc_date")
    df = mov.select("item_code", "warehouse", "trans_type", "base_entry",
                    cal.retail_year("doc_date").alias("retail_year"),
                    cal.period_of_week(wk).alias("period"))
    if approx:
        aggs = [F.approx_count_distinct("item_code").alias("items"),
                F.approx_count_distinct("warehouse").alias("warehouses"),
                F.approx_count_distinct(F.struct("trans_type", "base_entry")).alias("documents")]
    else:
        aggs = [F.count_distinct("item_code").alias("items"),
                F.count_distinct("warehouse").alias("warehouses"),
                F.count_distinct("trans_type", "base_entry").alias("documents")]
    return df.groupBy("retail_year", "period").agg(*aggs)


DISTINCT_KINDS = {"items": ["item_code"], "warehouses": ["warehouse"], "documents": ["trans_type", "base_entry"]}


def distinct_by_grain(mov: DataFrame, grains: dict[str, list[str]]) -> DataFrame:
    """E9 (exact) at several grains: ``grain``, the columns of the finest one (null where a grain lacks them) and
    distinct items, warehouses and documents; null for a kind without a value. Rows without a date are left out.

    Repeats within the finest grain go first, map side too, so that a hot value is at most a row for each period.
    Then the rows of a value come together once, and every grain drops its own repeats there."""
    finest = max(grains.values(), key=len)
    rows, out = with_retail_coords(mov), None
    groups = F.explode(F.array(*[F.struct(F.lit(g).alias("grain"), *[(F.col(c) if c in by else F.lit(None)).cast("int").alias(c) for c in finest])
                                 for g, by in grains.items()])).alias("_g")
    for kind, value in DISTINCT_KINDS.items():
        x = rows.select(*finest, *value).dropna().distinct().repartition(*value)
        n = x.select(groups, *value).select("_g.*", *value).distinct().groupBy("grain", *finest).agg(F.count("*").alias("_n"))
        n = n.withColumn("_kind", F.lit(kind))
        out = n if out is None else out.unionByName(n)
    return out.groupBy("grain", *finest).agg(*[F.max(F.when(F.col("_kind") == k, F.col("_n"))).alias(k) for k in DISTINCT_KINDS])


SKETCHES = {"items": "item_code", "warehouses": "warehouse", "documents": "document"}
PERIOD, QUARTER, YEAR = ["r_year", "r_quarter", "r_period"], ["r_year", "r_quarter"], ["r_year"]


def distinct_sketches(mov: DataFrame, by: list[str] = PERIOD, lg_k: int = 12) -> DataFrame:
    """E9 (mergeable): one HyperLogLog sketch for items, warehouses and documents of every retail period,
    to be stored. A sketch has at most 2 ** lg_k bytes, however many rows it has seen."""
    x = with_retail_coords(mov).withColumn("document", F.concat_ws("/", F.col("trans_type").cast("string"), F.col("base_entry").cast("string")))
    x = x.withColumn("document", F.when(F.col("trans_type").isNotNull() & F.col("base_entry").isNotNull(), F.col("document")))
    return x.groupBy(*by).agg(*[F.hll_sketch_agg(c, F.lit(lg_k)).alias(k) for k, c in SKETCHES.items()])


def roll_sketches(stored: DataFrame, by: list[str]) -> DataFrame:
    """Stored sketches united to a coarser grain (period > quarter > year); the journal is not read."""
    return stored.groupBy(*by).agg(*[F.hll_union_agg(k).alias(k) for k in SKETCHES])


def sketch_counts(stored: DataFrame) -> DataFrame:
    """The estimated distinct counts of stored sketches."""
    return stored.withColumns({k: F.hll_sketch_estimate(k) for k in SKETCHES})


def sketch_error(lg_k: int = 12, sigmas: float = 4.0) -> float:
    """Relative error that an estimate exceeds about once in 16,000 times (4 standard errors)."""
    return sigmas * 1.04 / 2 ** (lg_k / 2)


def with_retail_coords(mov: DataFrame, date_col: str = "doc_date") -> DataFrame:
    wk = cal.retail_week(date_col)
    return (mov.withColumn("r_year", cal.retail_year(date_col))
               .withColumn("r_week", wk)
               .withColumn("r_period", cal.period_of_week(wk))
               .withColumn("r_quarter", cal.quarter_of_week(wk)))


GRAINS = {"year": [], "quarter": ["r_quarter"], "period": ["r_period"], "week": ["r_week"]}


def retail_rollup(mov: DataFrame, grain: str = "period", by=("company",), digits: int = 2) -> DataFrame:
    """Facts grouped by retail year and a retail grain instead of Gregorian months."""
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {sorted(GRAINS)}")
    g = [*by, "r_year", *GRAINS[grain]]
    return with_retail_coords(mov).groupBy(*g).agg(
        F.count(F.lit(1)).alias("n"), F.sum("in_qty").alias("in_qty"), F.sum("out_qty").alias("out_qty"),
        F.round(F.sum("trans_value"), digits).alias("value"))


def value_cube(mov: DataFrame, digits: int = 2) -> DataFrame:
    """Value by (company, retail year, quarter, period) with rollup subtotals."""
    return with_retail_coords(mov).rollup("company", "r_year", "r_quarter", "r_period").agg(
        F.round(F.sum("trans_value"), digits).alias("value"), F.count(F.lit(1)).alias("n"),
        F.grouping_id().alias("gid"))
