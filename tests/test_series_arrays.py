import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from stockflow.operators import analogs as an
from stockflow.operators import demand as dm
from stockflow.operators import forecast as fc
from stockflow.operators import replenish as rp

MOV = "company string, item_code string, doc_date date, trans_type bigint, out_qty double"


@pytest.fixture(scope="module")
def mov(spark):
    rng = random.Random(3)
    rows = [(c, f"{i:07d}", date(2020, 1, 1) + timedelta(days=rng.randrange(700)), rng.choice([13, 15, 20]), rng.choice([None, 0.0, 1.0, 4.0, 9.0]))
            for i in range(12) for c in ("HR", "CAP") for _ in range(rng.choice([1, 3, 40]))]
    rows += [("HR", "0000099", None, 13, 2.0), ("HR", "0000001", None, 13, 2.0)]
    return spark.createDataFrame(rows, MOV).cache()


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _rows(df):
    return sorted(map(str, df.collect()))


def test_arrays_are_used_where_they_stand(spark, mov):
    """The same rows from demand arrays as from the series, without gathering or sorting it."""
    arrays, series = dm.demand_arrays(mov), dm.demand_series(mov)
    half = series.select(*dm.ITEM).distinct().withColumn("fraction", F.lit(0.8))
    ops = {"croston": fc.croston_family, "holt": fc.ses_holt, "news": lambda x: rp.newsvendor_by_group(x, half),
           "error": lambda x: dm.forecast_error(dm.moving_average_forecast(x)), "odd": dm.decompose, "even": lambda x: dm.decompose(x, m=4)}
    for name, op in ops.items():
        use = arrays.filter(F.exists("q", lambda y: y.isNotNull())) if name == "news" else arrays
        got = op(use)
        assert "Window" not in _plan(got) and "collect_list" not in _plan(got) and (name == "news" or "posexplode" not in _plan(got)), name
        assert _rows(got) == _rows(op(use.select(*dm.ITEM, F.posexplode("q").alias("i", "qty"), (F.col("first_p") + F.col("i")).alias("p"))
                                      if name == "news" else series)), name


def test_journal_is_put_together_once(spark, mov):
    """however often the series and the items are read, the journal is not in the plan again."""
    part = spark.createDataFrame([(i, f"B{i % 2}", f"T{i % 3}", 10.0 + i) for i in range(12)], "p_partkey bigint, p_brand string, p_type string, p_retailprice double")
    series = dm.demand_series(mov)
    assert "InMemoryRelation" not in _plan(series)
    near = _plan(an.ranked_analogs(an.item_stats(series, part, min_periods=50), 2))
    assert "Generate posexplode" not in near.replace("posexplode(b", "") and len(near.splitlines()) < 400
