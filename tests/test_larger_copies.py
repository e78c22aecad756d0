"""Work that must not be done again for every use of the journal."""

import re
from datetime import date, datetime

import numpy as np
from pyspark.sql import functions as F

from conftest import SF0001
from stockflow.operators import aggregates as ag
from stockflow.operators import inventory as inv
from stockflow.operators import reconcile as rc
from stockflow.operators import stl as sm
from stockflow.plans.catalog import QUERIES, load_all
from stockflow.schemas import MOVEMENT_COLUMNS
from stockflow.sources import fixtures as fx
from stockflow.sources.movements import finalize


def _scans(df, table):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return len(re.findall(f"Relation \\[[^\\]]*{table}", plan))


def test_stl_makes_its_windows_once_for_all_rows_of_a_size(monkeypatch):
    calls = []
    inner = sm._loess_of_size
    monkeypatch.setattr(sm, "_loess_of_size", lambda y, *rest: calls.append(y.shape[1]) or inner(y, *rest))
    y, size = np.random.default_rng(1).random((60, 30)), np.repeat([30, 12, 5], 20)
    some = sm.loess(y, None, size, 7, -1, 1)
    assert calls == [20, 20, 20]
    assert np.array_equal(some, sm.loess(y, np.ones_like(y), size, 7, -1, 1))


def test_reconcile_puts_the_journal_together_once(spark):
    load_all()
    for name in ("d4_reconcile", "d9_missing_in"):
        df = QUERIES[name](spark, SF0001)
        assert _scans(df, "l_partkey") == 0, name  # it reads the written on-hand only


def test_rolled_up_journal_keeps_null_keys_and_sums(spark):
    rows = [("HR", "a", "A00", 5.0, 0.0), ("HR", "a", "A00", 0.0, 2.0), ("HR", None, "A00", 1.0, 0.0), ("HR", "b", "A00", None, 0.0), ("HR", "b", "A00", None, 0.0)]
    mov = spark.createDataFrame(rows, "company string, item_code string, warehouse string, in_qty double, out_qty double")
    got = {r.item_code: r.qty_recon for r in rc.on_hand(rc.rolled_up(mov)).collect()}
    assert got == {"a": 3.0, None: 1.0, "b": None}


def test_distinct_counts_of_all_grains_equal_plain_ones(spark):
    n = 5000
    mov = spark.range(n).select(F.when(F.col("id") % 7 > 0, F.pmod("id", F.lit(90)).cast("string")).alias("item_code"), F.lit(None).cast("string").alias("warehouse"),
                                F.when(F.col("id") % 3 > 0, 15).alias("trans_type"), F.pmod("id", F.lit(400)).alias("base_entry"),
                                F.when(F.col("id") % 11 > 0, F.date_add(F.lit("1995-01-01").cast("date"), F.pmod("id", F.lit(700)).cast("int"))).alias("doc_date"))
    grains = {"period": ag.PERIOD, "quarter": ag.QUARTER, "year": ag.YEAR}
    got = ag.distinct_by_grain(mov, grains).collect()
    for g, by in grains.items():
        want = {tuple(r[c] for c in by): (r.items, r.documents) for r in ag.with_retail_coords(mov).dropna(subset=["doc_date"]).groupBy(*by).agg(
            F.count_distinct("item_code").alias("items"), F.count_distinct("trans_type", "base_entry").alias("documents")).collect()}
        assert {tuple(r[c] for c in by): (r["items"], r["documents"]) for r in got if r.grain == g} == want, g
    assert all(r.warehouses is None for r in got)


def test_movement_ids_are_made_behind_the_shuffle(spark):
    mov = fx.movements(spark, SF0001)
    plan = inv.on_hand_before_movement(mov)._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" in plan and "md5" not in plan[plan.rindex("RepartitionByExpression"):]


MOVEMENT = "company string, item_code string, warehouse string, doc_date date, doc_time int, create_date date, trans_type int, base_entry int, base_num int, doc_line int, in_qty double, out_qty double, trans_value double"


def _movement(item, day, time, entry, in_qty, out_qty):
    d = day and date(2020, 1, day)
    return "HR", item, "A00", d, time, date(2020, 1, 1), 15, entry, entry, 0, in_qty, out_qty, 0.0


def test_on_hand_before_movement_shuffles_the_journal_once(spark):
    rows = [_movement("1", 2, 900, 1, 5.0, 0.0), _movement("1", 2, 800, 2, 0.0, 2.0), _movement("1", 5, None, 3, 0.0, 1.0), _movement("1", 5, 1, 4, None, 1.0),
            _movement("1", 6, 0, 5, 4.0, 0.0), _movement(None, 2, 0, 6, 9.0, 0.0), _movement("1", None, 0, 7, 9.0, 0.0), _movement("2", 2, 2575, 8, 1.0, 0.0)]
    df = inv.on_hand_before_movement(finalize(spark.createDataFrame(rows, MOVEMENT)))
    assert sorted(df.columns) == sorted([*MOVEMENT_COLUMNS, "on_hand_before"])
    got = {r.base_entry: (r.doc_ts, r.on_hand_before) for r in df.collect()}
    # a movement of an unknown quantity has no stock before it; those without a key or day are left out, but the stock of the latter is there
    assert got == {1: (datetime(2020, 1, 2, 9), 7.0), 2: (datetime(2020, 1, 2, 8), 9.0), 3: (datetime(2020, 1, 5), 12.0), 4: (datetime(2020, 1, 5, 0, 1), None),
                   5: (datetime(2020, 1, 6), 11.0), 8: (datetime(2020, 1, 3, 2, 15), 0.0)}
    made = {r.base_entry: r.mov_id for r in finalize(spark.createDataFrame(rows, MOVEMENT)).collect()}
    assert all(r.mov_id == made[r.base_entry] for r in df.collect())
    # both sides of the join of the days' openings read one shuffle of the journal
    df = df.select("mov_id", "company", "item_code", "warehouse", "doc_ts", "on_hand_before")
    assert len(df.collect()) == 6
    plan = df._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
    assert plan.count("REPARTITION_BY_COL") == 2 and len(re.findall(r"ReusedExchange \[.*REPARTITION_BY_COL", plan)) == 1


def test_journal_keys_take_one_aggregate_and_suppliers_come_without_a_shuffle(spark, tmp_path):
    day = datetime(2020, 1, 2)
    lines = [(1, 10, 1, 1, 2.0, 5.0, "N", "F", day), (1, 10, 2, 2, 2.0, 5.0, "N", "O", day), (2, None, 1, 1, 1.0, 1.0, "A", "F", day),
             (2, 10, 1, 3, 1.0, 1.0, "R", "F", day), (2, 10, 1, 3, 1.0, 1.0, "R", "F", day), (3, 12345678, 3, 7, 1.0, 1.0, None, None, None),
             (3, 11, None, 1, 1.0, 1.0, "A", "F", day), (4, 11, 4, 1, 1.0, 1.0, "A", "F", day)]
    tables = {"lineitem": (lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
              "orders": ([(k, day) for k in (1, 2, 3, 4)], "o_orderkey bigint, o_orderdate timestamp_ntz"),
              "supplier": ([(1, 0), (2, 1), (3, 2), (4, None)], "s_suppkey bigint, s_nationkey bigint"),
              "nation": ([(0, 0), (1, 4), (2, None)], "n_nationkey bigint, n_regionkey bigint")}
    for name, (rows, ddl) in tables.items():
        spark.createDataFrame(rows, ddl).write.parquet(str(tmp_path / f"{name}.parquet"))
    keys, journal = fx.stock_keys(spark, str(tmp_path)), fx.movement_source(spark, str(tmp_path))
    got = sorted(map(tuple, keys.collect()), key=str)
    assert got == sorted(map(tuple, journal.select("company", "item_code", "warehouse").distinct().collect()), key=str)
    assert got == sorted([("HR", "0000010", "A00"), ("HR", "0000010", "A01"), ("HR", "0000010", "A04"), ("CAP", None, "A00"), ("COMERCIAL", "12345678", None)], key=str)
    assert journal.count() == 7 and dict(journal.dtypes)["doc_date"] == "date"
    plan = keys._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Aggregate \[", plan)) == 1
    # no join of suppliers and nations, whose size the planner takes for the product of theirs
    plan = journal._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Join Inner, \(l_suppkey#\d+L = s_suppkey#\d+L\)", plan) and plan.index("l_suppkey#") > plan.index("n_nationkey#")
