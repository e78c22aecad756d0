"""Contiguous shards of nearly equal bytes, by global prefix sums (operator 5, native).

Rows are put in one global order by a range partitioning. Each partition's totals give, through a
running sum over the few partitions, the bytes and rows before it; a running sum inside the
partition gives the bytes before each row. The line of all bytes is cut at equal targets, and a row
belongs to the shard in whose stretch its middle lies. No partition is ever gathered whole beyond
its own sort, and only small columns are shuffled.

Law: ``bytes`` - sizes are nearly equal (a shard differs from the target by at most one row's size
at either cut), counts are free. Equal texts stand next to each other, so a group of copies is
split only where a cut falls into it.

Edge cases: a null text has size 1; ties in the order are equal rows up to their other columns, and
``doc_id`` breaks them; wholly repeated rows take neighbouring slots; an empty table gives no rows;
with fewer rows than shards some shards are empty. Input columns named like added ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockflow.llm.arrays import named, numbered, without
from stockflow.session import ensure_checkpoint_dir


def shard(df: DataFrame, shards: int, size: str, order: list[str]) -> DataFrame:
    """Add ``shard int`` (0 to shards - 1) and ``slot long`` (place in its shard, gapless from 0).

    ``size`` names a positive long column; ``order`` the columns of the global order, which should
    tell rows apart. The rows with their partition number are checkpointed, as a second run of the
    range partitioning might draw other bounds.
    """
    keep = without(df, ["shard", "slot"])
    df = numbered(df, keep, _size=size, **{f"_o{i}": c for i, c in enumerate(order)})
    size, order = "_size", [f"_o{i}" for i in range(len(order))]
    ensure_checkpoint_dir(df.sparkSession)
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = (df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()).checkpoint())
    # one row for each partition, so its windows and its broadcast are as small as their number
    totals = placed.groupBy("_part").agg(F.sum(size).alias("_bytes"), F.count("*").alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "_part", F.coalesce(F.sum("_bytes").over(earlier), F.lit(0)).alias("_before"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_first"),
        F.sum("_bytes").over(Window.partitionBy(F.lit(0))).alias("_total"))
    own = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    cut = (placed.withColumn("_bytes", F.sum(size).over(own)).withColumn("_row", F.count("*").over(own) - 1)
           .join(F.broadcast(starts), "_part")
           # twice the middle of the row on the line of all bytes, times shards, over twice the line
           .withColumn("shard", F.expr(f"cast(((2 * (_before + _bytes) - `{size}`) * {shards}L) div (2 * _total) as int)"))
           .withColumn("_row", F.col("_first") + F.col("_row")))
    first = cut.groupBy("shard").agg(F.min("_row").alias("_first"))
    done = (cut.drop("_first").join(F.broadcast(first), "shard")  # one row for each shard
            .withColumn("slot", F.col("_row") - F.col("_first")))
    return named(done, keep, ["shard", "slot"])
