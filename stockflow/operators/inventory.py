"""Running stock (F1, F2, D11) and period rankings.

Skew note: every running sum here first collapses movements to one row per key and day
(``daily_net``). A hot key that holds a third of all movements still has at most one row per
calendar day, so the per-key window sorts a few thousand rows, not a third of the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stockflow.functions import calendar as cal
from stockflow.functions.movement_fields import doc_ts, mov_id
from stockflow.operators.aggregates import KEY, daily_net


def _running(key, order):
    return Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def running_on_hand(mov: DataFrame, key=KEY) -> DataFrame:
    """end-of-day on-hand per key = running sum of the daily net (ROWS frame, one row
    per day, so ties cannot reorder)."""
    d = daily_net(mov, key)
    return d.withColumn("on_hand", F.sum("net_qty").over(_running(key, ["doc_date"])))


def on_hand_before(mov: DataFrame, key=KEY) -> DataFrame:
    """F2 (day grain): stock at the start of each movement day."""
    f1 = running_on_hand(mov, key)
    return f1.withColumn("on_hand_before", F.col("on_hand") - F.col("net_qty"))


MOVEMENT_ORDER = ["doc_ts", "create_date", "base_entry", "doc_line", "mov_id"]


def on_hand_before_movement(mov: DataFrame, key=KEY) -> DataFrame:
    """F2 (movement grain): stock just before each movement.

    Two levels keep every window bounded: the per-key prefix over days (one row per key-day)
    gives the opening of the day, and the intra-day running sum is partitioned by key *and*
    day, so a hot key is split across its days. ``mov_id``, the last tie-break, is a hash that hardly
    compresses: it is made again from its parts (B3) behind the shuffle, as is ``doc_ts`` (B2). Rows
    without a key or day are left out; those without a day count as movements before the first one.
    """
    net = F.col("_net")
    columns = mov.columns
    # Both sides of the join must read the same rows, or the journal is put together and shuffled for either:
    # keys are filtered before, and days are joined by a number that is never null, so the join adds no filter.
    for c in key:
        mov = mov.filter(F.col(c).isNotNull())
    number = F.coalesce(F.unix_date("doc_date"), F.lit(-2 ** 31))
    mov = mov.withColumn("_net", F.col("in_qty") - F.col("out_qty")).drop("mov_id", "doc_ts").repartition(*key, number)
    mov = mov.withColumn("doc_ts", doc_ts()).withColumn("mov_id", mov_id()).select(*columns, "_net", number.alias("_day"))
    of_day = Window.partitionBy(*key, "_day").orderBy(*MOVEMENT_ORDER)
    intra = (mov.withColumn("intra", F.sum(net).over(of_day.rowsBetween(Window.unboundedPreceding, 0)))
                .withColumn("last_of_day", F.lead(F.lit(1)).over(of_day).isNull()))
    # the day's total stands in its last row, so the journal is computed and shuffled once
    day = (intra.filter("last_of_day").select(*key, "_day", F.col("doc_date").isNotNull().alias("_dated"), F.col("intra").alias("day_net"))
                .withColumn("day_open", F.sum("day_net").over(_running(key, ["_day"])) - F.col("day_net"))
                .filter("_dated").drop("day_net", "_dated"))
    return (intra.join(day, on=[*key, "_day"])
                 .withColumn("on_hand_before", F.col("day_open") + F.col("intra") - net)
                 .drop("day_open", "intra", "last_of_day", "_net", "_day"))


def inventory_asof(mov: DataFrame, probes: DataFrame, key=KEY, date_col: str = "probe_date") -> DataFrame:
    """On-hand at the end of arbitrary probe dates, including dates without movements.

    Probes are unioned into the per-key daily stream and carried forward with a running sum,
    so no range join is needed; probe rows contribute zero net and sort after the same day's
    movements (end-of-day semantics).
    """
    d = daily_net(mov, key).select(*key, F.col("doc_date").alias("d"), "net_qty",
                                   F.lit(0).alias("is_probe"))
    p = probes.select(*key, F.col(date_col).cast("date").alias("d"), F.lit(0.0).alias("net_qty"),
                      F.lit(1).alias("is_probe")).distinct()
    s = d.unionByName(p).withColumn("on_hand", F.sum("net_qty").over(_running(key, ["d", "is_probe"])))
    return s.filter(F.col("is_probe") == 1).select(*key, F.col("d").alias(date_col), "on_hand")


def top_movers(mov: DataFrame, n: int = 10, by: str = "out_qty", digits: int = 2) -> DataFrame:
    """top-n items per retail period by outflow (``out_qty``) or absolute value (``value``).

    The ``rank <= n`` filter over ``row_number`` lets Spark insert a partial per-group limit
    before the shuffle (window group limit), so each map task ships at most n rows per period.
    """
    wk = cal.retail_week("doc_date")
    df = mov.select("item_code", "out_qty", "trans_value",
                    cal.retail_year("doc_date").alias("r_year"), cal.period_of_week(wk).alias("r_period"))
    measure = F.sum("out_qty") if by == "out_qty" else F.round(F.sum(F.abs("trans_value")), digits)
    agg = df.groupBy("r_year", "r_period", "item_code").agg(measure.alias("measure"))
    w = Window.partitionBy("r_year", "r_period").orderBy(F.desc("measure"), F.asc("item_code"))
    return agg.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
