from datetime import datetime

from pyspark.sql import functions as F

from stockflow.schemas import MOVEMENT_COLUMNS
from stockflow.sources.movements import empty_movements, finalize

RAW = [("0010324", "A01", "2024-03-15", 1430, "2024-03-15", 15, 1001, 5001, 0, 0.0, 3.0, 0.0),
       ("0010324", "A01", "2024-03-16", 905, "2024-03-16", 20, 1002, 5002, 0, 10.0, 0.0, 100.0)]
RAW_SCHEMA = ("item_code string, warehouse string, doc_date string, doc_time int, create_date string, "
              "trans_type int, base_entry int, base_num int, doc_line int, in_qty double, out_qty double, "
              "trans_value double")


def test_finalize_two_rows(spark):
    df = finalize(spark.createDataFrame(RAW, RAW_SCHEMA), "HR")
    assert tuple(df.columns) == MOVEMENT_COLUMNS
    rows = df.orderBy("doc_date").collect()
    assert [r["doc_ts"] for r in rows] == [datetime(2024, 3, 15, 14, 30), datetime(2024, 3, 16, 9, 5)]
    assert all(r["mov_id"] for r in rows) and rows[0]["mov_id"] != rows[1]["mov_id"]
    assert rows[0]["item_code"] == "0010324" and rows[0]["company"] == "HR"
    assert dict(df.dtypes)["doc_time"] == "smallint" and dict(df.dtypes)["retail_year"] == "smallint"
    assert rows[0]["retail_year"] == 2024
    again = finalize(spark.createDataFrame(RAW, RAW_SCHEMA), "HR").orderBy("doc_date").collect()
    assert [r["mov_id"] for r in again] == [r["mov_id"] for r in rows]


def test_lenient_and_rollover(spark):
    raw = [("1", "A01", "2024-03-15", "2575", "2024-03-15", "abc", "1", "1", "0", "x", "1", "1")]
    schema = RAW_SCHEMA.replace(" int", " string").replace(" double", " string")
    r = finalize(spark.createDataFrame(raw, schema), "CAP").first()
    assert r["trans_type"] is None and r["in_qty"] is None and r["mov_id"] is None  # null propagates
    assert r["doc_ts"] == datetime(2024, 3, 16, 2, 15)  # no range check: rolls over


def test_null_time_is_midnight(spark):
    raw = [("1", "A01", "2024-03-15", None, "2024-03-15", 15, 1, 1, 0, 0.0, 1.0, -1.0)]
    r = finalize(spark.createDataFrame(raw, RAW_SCHEMA), "HR").first()
    assert r["doc_ts"] == datetime(2024, 3, 15)


def test_empty_has_schema(spark):
    e = empty_movements(spark)
    assert e.count() == 0 and tuple(e.columns) == MOVEMENT_COLUMNS


def test_fixture_counts(spark):
    from stockflow.sources import fixtures as fx
    src = fx.movement_source(spark, "/root/testdata/sf0.01")
    assert src.count() == 68468
    by = {r["trans_type"]: r["count"] for r in src.groupBy("trans_type").count().collect()}
    assert by == {13: 8577, 15: 17152, 16: 8599, 20: 8606, 67: 16936, 69: 8598}
    t = src.filter("trans_type = 67").agg(F.sum("in_qty"), F.sum("out_qty")).first()
    assert t[0] == t[1] == 217903
