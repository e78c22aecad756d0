import re
from datetime import date

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from conftest import SF0001
from stockflow.operators import unconstrain as un
from stockflow.operators.demand import KEY
from stockflow.plans.catalog import QUERIES, load_all

MOV = "company string, item_code string, warehouse string, doc_date date, trans_type bigint, in_qty double, out_qty double"


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_periods_are_not_sorted_or_shuffled(spark):
    """only movement days may meet in windows and aggregates, not the periods made of them."""
    mov = spark.createDataFrame([("HR", "1", "A00", date(2020, 1, 5), 59, 9.0, 0.0)], MOV)
    plan = _plan(un.unconstrain_periods(mov)).partition("MapInArrow")
    assert plan[1] and "Window" not in plan[0] and "Aggregate" not in plan[0] and "explode" not in plan[2]
    plan = _plan(un.two_stage(mov)).partition("MapInArrow")
    assert plan[1] and "Aggregate" not in plan[0]


def test_unknown_dates_and_quantities(spark):
    """Movements without a date are a row of their own; a day without any quantity is neither in nor out of stock."""
    rows = [("HR", "1", "A00", None, 15, 0.0, 3.0), ("HR", "1", "A00", date(2026, 2, 1), 59, 9.0, 0.0), ("HR", "1", "A00", date(2026, 2, 3), 15, 0.0, 2.0),
            ("HR", "2", "A00", date(2026, 2, 2), 15, None, None), ("HR", "2", "A00", date(2026, 2, 3), 15, None, None)]
    got = {(r.item_code, r.r_year): tuple(r)[4:] for r in un.unconstrain_periods(spark.createDataFrame(rows, MOV)).collect()}
    # the stock before 1 February is -3: out; gap and 3 February in stock, sales of 2 on two days
    assert got == {("1", None): (None, None, None, 3.0, 0.0, None), ("1", 2026): (1, 3, 1, 2.0, 2.0, 3.0),
                   ("2", 2026): (1, 2, 0, None, 0.0, None)}


def test_service_kpis_put_the_journal_together_once(spark):
    load_all()
    plan = _plan(QUERIES["h17_service_kpis"](spark, SF0001))
    assert not re.search(r"Relation \[[^\]]*l_partkey", plan)  # it reads the written day lists only
    assert "Aggregate" not in plan.partition("MapInArrow")[0] and "Join" not in plan


def _kpis_by_rows(mov):
    """H17 from rows: days summed by cycle, cycles and periods by key."""
    w = Window.partitionBy(*KEY).orderBy("doc_date").rowsBetween(Window.unboundedPreceding, 0)
    h = un.stock_history(mov).withColumn("cycle", F.sum(F.when(F.col("net_qty") > 0, 1).otherwise(0)).over(w))
    span = F.col("gap_days") + 1
    cyc = (h.groupBy(*KEY, "cycle").agg(F.max((F.col("stockout") | F.col("gap_out")).cast("int")).alias("out"), F.sum(span).alias("days"), F.sum("sales").alias("sales"),
                                        F.sum(F.col("on_hand") * span).alias("unit_days"), F.max(F.struct("doc_date", "on_hand")).alias("end"))
            .groupBy(*KEY).agg(F.avg("out").alias("out"), F.sum("days").alias("days"), F.sum("sales").alias("sales"), F.sum("unit_days").alias("unit_days"), F.max("end").alias("end")))
    u = un.unconstrain_periods(mov).groupBy(*KEY).agg(F.sum("stockout_days").alias("stockout_days"), F.sum("demand_v1").alias("demand"))
    r = lambda c: F.round(c, 6)
    return cyc.join(u, KEY).select(*KEY, r(F.col("stockout_days") / F.col("days")), r(F.try_divide("sales", "demand")), r(1 - F.col("out")),
                                   r(F.try_divide(F.col("end.on_hand"), F.col("sales") / F.col("days") * 7)), r(F.try_divide("sales", F.col("unit_days") / F.col("days"))))


def test_service_kpis_equal_sums_of_rows(spark):
    day = lambda i: date.fromordinal(date(2025, 11, 1).toordinal() + i)
    rows = []
    for k in range(60):  # over period and year ends, with receipts, empty stock and several movements a day
        rows += [("HR", f"i{k}", f"A0{k % 3}", day((k * 7 + j * j * (1 + k % 4)) % 190), 15 if j % 3 else 20, 0.0 if j % 3 else 3.0 + k % 5, 1.0 + j % 4 if j % 3 else 0.0)
                 for j in range(1 + k % 13)]
    rows += [("HR", "undated", "A00", None, 20, 9.0, 0.0), ("HR", "undated", "A00", None, 15, 0.0, 4.0), ("HR", "undated", "A00", day(3), 15, 0.0, 5.0), ("HR", "undated", "A00", day(9), 20, 2.0, 0.0),
             ("HR", "never dated", "A00", None, 15, 0.0, 4.0), ("HR", "unknown", "A00", day(1), 15, None, None), ("HR", "unknown", "A00", day(5), 20, 4.0, 0.0), ("HR", "unknown", "A00", day(8), 15, 0.0, None),
             ("HR", "never known", "A00", day(2), 15, None, None), ("HR", "never in stock", "A00", day(2), 15, 0.0, 3.0), ("HR", None, "A00", day(2), 20, 3.0, 0.0)]
    mov = spark.createDataFrame(rows, MOV)
    got = {tuple(r)[:3]: tuple(r)[3:] for r in un.service_kpis(mov).collect()}
    assert got == {tuple(r)[:3]: tuple(r)[3:] for r in _kpis_by_rows(mov).collect()}
    assert len(got) == 65 and got["HR", "never known", "A00"] == (0.0, None, None, None, None)


def test_day_lists_are_made_without_another_sort(spark, monkeypatch):
    name, plans = "spark.sql.execution.replaceHashWithSortAgg", []
    before, inner = spark.conf.get(name), un.materialize
    monkeypatch.setattr(un, "materialize", lambda df, *rest: plans.append(df._jdf.queryExecution().executedPlan().toString()) or inner(df, *rest))
    mov = spark.createDataFrame([("HR", "1", "A00", date(2020, 1, 5), 59, 9.0, 0.0), ("HR", "1", "A00", date(2020, 1, 9), 15, 0.0, 2.0)], MOV)
    assert [tuple(e)[:4] for e in un.cycle_history(mov).first().d] == [(date(2020, 1, 5), 0.0, True, 9.0), (date(2020, 1, 9), 2.0, False, 7.0)]
    assert len(plans) == 1 and "ObjectHashAggregate" not in plans[0] and plans[0].count("Sort [") == 1
    assert spark.conf.get(name) == before


def test_service_kpis_of_no_movements(spark):
    assert un.service_kpis(spark.createDataFrame([], MOV)).collect() == []
