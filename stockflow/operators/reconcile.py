"""Golden reconciliation of reconstructed stock against a snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.session import materialize

KEY = ["company", "item_code", "warehouse"]
# fixed value: default absolute tolerance in units
DEFAULT_TOLERANCE = 1e-3


def on_hand(mov: DataFrame, key=KEY) -> DataFrame:
    """SUM(in_qty - out_qty) per key (partial + final hash aggregate)."""
    return mov.groupBy(*key).agg(F.sum(F.col("in_qty") - F.col("out_qty")).alias("qty_recon"))


def rolled_up(mov: DataFrame, key=KEY) -> DataFrame:
    """The journal as one row per key, written down: its keys and their on-hand are those of the journal,
    so that whoever asks for them several times does not put the journal together again."""
    return materialize(on_hand(mov, key), "on_hand").select(*key, F.col("qty_recon").alias("in_qty"), F.lit(0.0).alias("out_qty"))


def reconcile(mov: DataFrame, stock: DataFrame, tol: float = DEFAULT_TOLERANCE, key=KEY) -> DataFrame:
    """Aggregate first, then full outer join with the snapshot; missing side counts 0.

    Keeps rows with ``abs(diff) > tol`` (strict), largest difference first. Null keys never match (plain equi-join).
    Both sides are one row per key after the aggregate, so the join shuffles each side once
    on the key and the stream is bounded by the number of keys, not movements.
    """
    recon = on_hand(mov, key)
    sap = stock.groupBy(*key).agg(F.sum("qty_sap").alias("qty_sap"))
    joined = recon.join(sap, on=key, how="full")
    diff = F.coalesce(F.col("qty_recon"), F.lit(0.0)) - F.coalesce(F.col("qty_sap"), F.lit(0.0))
    return (joined.select(*key, "qty_recon", "qty_sap", diff.alias("diff"))
                  .filter(F.abs(F.col("diff")) > tol).orderBy(F.desc("diff")))


def missing_in(mov: DataFrame, stock: DataFrame, key=KEY) -> DataFrame:
    """Keys on one side only, tagged with the side that has them."""
    lake = mov.select(*key).distinct().withColumn("in_lake", F.lit(True))
    sap = stock.select(*key).distinct().withColumn("in_snapshot", F.lit(True))
    both = lake.join(sap, on=key, how="full")  # each side is computed once
    return both.filter(F.col("in_lake").isNull() | F.col("in_snapshot").isNull()).select(
        *key, F.when(F.col("in_lake").isNull(), "snapshot_only").otherwise("lake_only").alias("side"))


def transfer_pairs(mov: DataFrame) -> DataFrame:
    """Match the out-leg and the in-leg of each transfer (type 67) document line.

    Legs are matched on (company, item, document, line): the pair key is near-unique, so the
    self-join is an equi-join with at most a handful of rows per key, never a cross product.
    Unmatched legs come out with the other side null.
    """
    t = mov.filter(F.col("trans_type") == 67)
    k = ["company", "item_code", "base_entry", "doc_line"]
    outs = t.filter(F.col("out_qty") > 0).select(*k, F.col("warehouse").alias("from_wh"),
                                                 F.col("out_qty").alias("qty_out"),
                                                 F.col("trans_value").alias("value_out"))
    ins = t.filter(F.col("in_qty") > 0).select(*k, F.col("warehouse").alias("to_wh"),
                                               F.col("in_qty").alias("qty_in"),
                                               F.col("trans_value").alias("value_in"))
    j = outs.join(ins, on=k, how="full")
    return j.select(*k, "from_wh", "to_wh", "qty_out", "qty_in",
                    F.when(F.col("qty_out").isNull() | F.col("qty_in").isNull(), "unmatched")
                     .when(F.col("qty_out") != F.col("qty_in"), "qty_mismatch")
                     .otherwise("matched").alias("pair_status"))
