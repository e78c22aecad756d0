import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from stockflow.operators import logs as lg
from stockflow.operators.sequence import dyadic_cells, dyadic_cover
from stockflow.sources import fixtures as fx

T0 = datetime(2026, 1, 1)


def test_cover_is_exact_small_and_disjoint(spark):
    rng = random.Random(1)
    spans = [(0, 0), (5, 4), (-7, -7), (-9, 12), (0, 8759), (1, 8760), (3, 8765), (-8760, 8760)]
    spans += [(a, a + rng.choice([0, 1, 2, 3, 7, 8, 100, 5000])) for a in (rng.randint(-10_000, 10_000) for _ in range(300))]
    df = spark.createDataFrame(spans, "a bigint, b bigint")
    for top in (13, 4, 0):
        for r in df.select("a", "b", dyadic_cover(F.col("a"), F.col("b"), top).alias("x")).collect():
            cells = [c for x in r.x for c in range(x.cell << x.level, (x.cell + 1) << x.level)]
            assert sorted(cells) == list(range(r.a, r.b + 1))
            assert all(x.level <= top for x in r.x)
            n = max(r.b - r.a + 1, 1)
            assert len(r.x) <= 2 * n.bit_length() + (n >> top) + 1
    year = df.where("b - a = 8759").select(F.size(dyadic_cover(F.col("a"), F.col("b"))).alias("n")).collect()
    assert year and all(r.n < 60 for r in year)
    got = df.select("a", dyadic_cells(F.col("a"), [0, 3]).alias("x")).collect()
    assert all([tuple(c) for c in r.x] == [(0, r.a), (3, r.a >> 3)] for r in got)


def _activities(spark):
    rng = random.Random(2)
    rows = []
    for i in range(60):
        at = T0 + timedelta(seconds=rng.randint(0, 380 * 86400))
        rows.append((i, at, at + timedelta(seconds=rng.choice([0, 30, 3600, 86400, 20 * 86400, 365 * 86400, -5]))))
    return spark.createDataFrame(rows + [(99, None, T0), (98, T0, None)], "event_id long, started_at timestamp_ntz, finished_at timestamp_ntz")


def test_long_activities_equal_the_plain_join(spark):
    a = _activities(spark)
    perf = spark.range(4000).select(F.col("id").alias("event_id"), F.timestamp_add("SECOND", (F.col("id") * 16_411).cast("int"), F.lit(T0).cast("timestamp_ntz")).alias("ts"),
                                    (F.col("id") % 7).cast("double").alias("rss_mb"))
    for pred in (None, F.col("rss_mb") > 3):
        got = lg.activity_during(a, perf, pred).select("a.event_id", "p.event_id").collect()
        p = perf if pred is None else perf.filter(pred)
        want = a.alias("a").join(p.alias("p"), (F.col("a.started_at") <= F.col("p.ts")) & (F.col("p.ts") <= F.col("a.finished_at"))).select("a.event_id", "p.event_id").collect()
        assert len(got) > 1000 and sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert lg.activity_during(a.limit(0), perf).count() == 0
    assert lg.activity_during(a, perf.limit(0)).count() == 0


def test_a_year_in_the_join_has_few_rows(spark):
    a = spark.createDataFrame([(1, T0 + timedelta(minutes=7), T0 + timedelta(days=365))], "event_id long, started_at timestamp_ntz, finished_at timestamp_ntz")
    cell = lambda c: F.floor(F.unix_micros(F.col(c).cast("timestamp")) / 3_600_000_000).cast("bigint")
    assert a.select(F.explode(dyadic_cover(cell("started_at"), cell("finished_at")))).count() < 60


@pytest.mark.parametrize("bucket", [60, 3600, 86400])
def test_other_buckets(spark, bucket):
    jobs, perf = fx.job_logs(spark, SF0001), fx.performance_logs(spark, SF0001)
    n = lg.activity_during(jobs, perf, bucket_seconds=bucket).count()
    assert n == jobs.alias("a").join(perf.alias("p"), (F.col("a.started_at") <= F.col("p.ts")) & (F.col("p.ts") <= F.col("a.finished_at"))).count()
