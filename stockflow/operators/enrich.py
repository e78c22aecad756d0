"""Projections and enrichment of movements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# fixed values: document type codes, their document and the typical stock direction
TRANS_TYPES = (
    (13, "A/R Invoice", "out"),
    (14, "A/R Credit Memo", "in"),
    (15, "Delivery", "out"),
    (16, "Return", "in"),
    (18, "A/P Invoice", "value-only"),
    (19, "A/P Credit Memo", "out"),
    (20, "Goods Receipt PO", "in"),
    (21, "Goods Return", "out"),
    (59, "Goods Receipt", "in"),
    (60, "Goods Issue", "out"),
    (67, "Inventory Transfer", "net-zero"),
    (69, "Landed Costs", "value-only"),
    (162, "Inventory Revaluation", "value-only"),
    (10000071, "Inventory Counting", "mixed"),
)


def _lookup(col: Column, idx: int) -> Column:
    m = F.create_map(*[x for row in TRANS_TYPES for x in (F.lit(row[0]).cast("bigint"), F.lit(row[idx]))])
    return F.element_at(m, col.cast("bigint"))


def document_name(trans_type="trans_type") -> Column:
    c = F.col(trans_type) if isinstance(trans_type, str) else trans_type
    return _lookup(c, 1)


def typical_direction(trans_type="trans_type") -> Column:
    c = F.col(trans_type) if isinstance(trans_type, str) else trans_type
    return _lookup(c, 2)


def classify_trans(df: DataFrame, col: str = "trans_type") -> DataFrame:
    """Add document name and typical direction; unknown codes are kept with nulls.

    The 14-entry table is a literal map evaluated inside whole-stage codegen, so the lookup
    costs no join and no shuffle.
    """
    return df.withColumn("document", document_name(col)).withColumn("direction", typical_direction(col))


def movement_quality(mov: DataFrame, by=("company",)) -> DataFrame:
    """Violation counters in one pass (conditional sums, partial aggregation)."""
    t = F.col("doc_time").cast("int")
    bad_hhmm = t.isNotNull() & ((t < 0) | (F.floor(t / 100) > 23) | (F.pmod(t, F.lit(100)) > 59))
    lenient = ["trans_type", "base_entry", "base_num", "doc_line", "in_qty", "out_qty", "trans_value"]
    any_null = F.lit(False)
    for c in lenient:
        any_null = any_null | F.col(c).isNull()
    against = (((F.col("in_qty") > 0) & (F.col("out_qty") == 0) & (F.col("trans_value") < 0))
               | ((F.col("out_qty") > 0) & (F.col("in_qty") == 0) & (F.col("trans_value") > 0)))
    return mov.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if((F.col("in_qty") < 0) | (F.col("out_qty") < 0)).alias("negative_qty"),
        F.count_if(any_null).alias("null_after_cast"),
        F.count_if(against).alias("value_against_direction"),
        F.count_if(bad_hhmm).alias("invalid_hhmm"),
    )


def redact(df: DataFrame, rules: dict[str, tuple[str, str]]) -> DataFrame:
    """Scrub sensitive fields before persisting: ``{column: (regex, replacement)}``."""
    out = df
    for c, (pattern, repl) in rules.items():
        out = out.withColumn(c, F.regexp_replace(F.col(c), pattern, repl))
    return out


def project_fields(df: DataFrame, fields: list[str] | None) -> DataFrame:
    """Sparse field selection; unknown names are an error, None keeps everything."""
    if not fields:
        return df
    unknown = [f for f in fields if f not in df.columns]
    if unknown:
        raise ValueError(f"unknown fields: {unknown}")
    return df.select(*fields)
