from datetime import datetime, timedelta

from pyspark.sql import functions as F

from conftest import SF0001
from stockflow.operators import logs as lg
from stockflow.operators import runs as rn
from stockflow.sources import fixtures as fx

EV_SCHEMA = ("id long, job string, trigger string, correlation_id string, idempotency_key string, seq int, "
             "state string, event_at timestamp_ntz, rows long")
T0 = datetime(2026, 6, 22, 10, 0)


def _ev(rows, spark):
    return spark.createDataFrame(rows, EV_SCHEMA)


def test_fold_lifecycle(spark):
    ev = _ev([(1, "a", "api", "c1", None, 0, "queued", T0, None),
              (1, "a", "api", "c1", None, 1, "running", T0 + timedelta(seconds=5), None),
              (1, "a", "api", "c1", None, 2, "ok", T0 + timedelta(seconds=65), 42),
              (2, "a", "cli", "c2", None, 0, "queued", T0, None)], spark)
    r = {x["id"]: x for x in rn.fold_runs(ev).collect()}
    assert r[1]["status"] == "ok" and r[1]["rows"] == 42 and r[1]["duration_s"] == 60.0
    assert r[2]["status"] == "queued" and r[2]["started_at"] is None
    assert rn.active_runs(rn.fold_runs(ev), T0 + timedelta(seconds=10)).count() == 1
    assert rn.active_runs(rn.fold_runs(ev), T0 + timedelta(seconds=10), stale_s=0).count() == 0
    assert rn.stuck_runs(rn.fold_runs(ev), T0 + timedelta(hours=2)).count() == 1


def test_lifecycle_violations_planted(spark):
    ev = _ev([(1, "a", "api", "c", None, 1, "running", T0, None),
              (2, "a", "api", "c", None, 0, "queued", T0, None),
              (2, "a", "api", "c", None, 1, "running", T0 + timedelta(seconds=5), None),
              (2, "a", "api", "c", None, 2, "ok", T0 + timedelta(seconds=6), 1),
              (2, "a", "api", "c", None, 3, "failed", T0 + timedelta(seconds=7), 1),
              (3, "a", "api", "c", None, 0, "queued", T0, None),
              (3, "a", "api", "c", None, 1, "running", T0 + timedelta(seconds=9), None),
              (3, "a", "api", "c", None, 2, "ok", T0 + timedelta(seconds=8), 1)], spark)
    v = {(r["id"], r["violation"]) for r in rn.lifecycle_violations(ev).collect()}
    assert (1, "running_not_from_queued") in v and (2, "terminal_twice") in v and (3, "finish_before_start") in v


def test_peak_overlap(spark):
    def runs(intervals):
        return spark.createDataFrame(
            [(i, "job", T0 + timedelta(seconds=a), T0 + timedelta(seconds=b)) for i, (a, b) in enumerate(intervals)],
            "id long, job string, started_at timestamp_ntz, finished_at timestamp_ntz")
    serial = runs([(0, 10), (10, 20), (20, 30)])  # three writers behind a lock
    assert rn.peak_overlap(serial).first()["peak_overlap"] == 1
    assert rn.peak_overlap(runs([(0, 10), (5, 20), (6, 7), (30, 40)])).first()["peak_overlap"] == 3
    # across hour buckets
    assert rn.peak_overlap(runs([(0, 7200), (3599, 3700), (5000, 9000)])).first()["peak_overlap"] == 2


def test_idempotency(spark):
    runs = spark.createDataFrame([(1, "k", T0), (2, "k", T0 + timedelta(seconds=1)), (3, None, T0), (4, None, T0)],
                                 "id long, idempotency_key string, created_at timestamp_ntz")
    m = {r["id"]: r["canonical_id"] for r in rn.idempotent_runs(runs).collect()}
    assert m == {1: 1, 2: 1, 3: 3, 4: 4}


def test_seek_paging_covers_all_once(spark):
    logs = spark.createDataFrame([(i, T0 + timedelta(minutes=i)) for i in range(5)], "event_id long, ts timestamp_ntz")
    seen, after = [], None
    while True:
        page = lg.seek_page(logs, after=after, desc=True, limit=2).collect()
        seen += [r["event_id"] for r in page[:2]]
        if len(page) <= 2:
            break
        after = (page[1]["ts"].isoformat(sep=" "), page[1]["event_id"])
    assert seen == [4, 3, 2, 1, 0]


def test_seek_union_pages_cover_all_once(spark):
    fr = {"job": fx.job_logs(spark, SF0001), "api": fx.api_logs(spark, SF0001),
          "performance": fx.performance_logs(spark, SF0001)}
    total = sum(f.count() for f in fr.values())
    seen, after = [], None
    while True:
        page = lg.seek_union(fr, after=after, desc=True, limit=1000).collect()
        seen += [(r["type"], r["event_id"]) for r in page[:1000]]
        if len(page) <= 1000:
            break
        last = page[999]
        after = (last["ts"].isoformat(sep=" "), last["type"], last["event_id"])
    assert len(seen) == len(set(seen)) == total


def test_narrow_kinds():
    assert lg.narrow_kinds(status="ok") == ["job", "api"]
    assert lg.narrow_kinds(job="x") == ["job"]
    assert lg.narrow_kinds(path="/y") == ["api"]
    assert lg.narrow_kinds(job="x", path="/y") == []
    assert lg.narrow_kinds("performance") == ["performance"]
    assert lg.narrow_kinds("performance", status="ok") == []
    assert lg.narrow_kinds() == ["job", "api", "performance"]
    import pytest
    with pytest.raises(ValueError):
        lg.sort_spec("name")


def test_interval_join_bucketed_equals_plain(spark):
    jobs, perf = fx.job_logs(spark, SF0001), fx.performance_logs(spark, SF0001)
    a = lg.activity_during(jobs, perf).select("a.event_id", "p.event_id").collect()
    b = jobs.alias("a").join(perf.alias("p"), (F.col("a.started_at") <= F.col("p.ts")) & (F.col("p.ts") <= F.col("a.finished_at"))) \
        .select("a.event_id", "p.event_id").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_bucketed_lag_matches_plain_window(spark):
    from pyspark.sql.window import Window
    perf = fx.performance_logs(spark, SF0001)
    got = lg.io_delta(perf).select("event_id", "disk_io_mb")
    w = Window.partitionBy("host").orderBy("ts", "event_id")
    exp = perf.select("event_id", F.round(F.coalesce(F.col("io_counter_mb") - F.lag("io_counter_mb").over(w),
                                                      F.lit(0.0)), 4).alias("disk_io_mb"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))


def test_cap_detail(spark):
    from stockflow.functions.log_fields import cap_detail
    df = spark.createDataFrame([("ñandú" * 3, True), ("x", False)], "d string, f boolean")
    r = df.select(cap_detail("d", F.col("f"), 5).alias("c")).collect()
    assert r[0]["c"].startswith("ñan") and len(r[0]["c"].encode()) <= 8 and r[1]["c"] is None


def _land(spark, df):
    import os
    import uuid

    from stockflow.session import ensure_checkpoint_dir
    path = os.path.join(ensure_checkpoint_dir(spark), f"t-stream-{uuid.uuid4().hex}")
    df.write.parquet(path + "/in")
    return path


def test_long_activities_match_or_fail(spark):
    import pytest

    from stockflow.streaming import streams as st
    jobs = spark.createDataFrame([(1, T0, T0 + timedelta(hours=12))], "event_id long, started_at timestamp_ntz, finished_at timestamp_ntz")
    perf = spark.createDataFrame([(i, T0 + timedelta(hours=i), 1.0) for i in range(-2, 14)], "event_id long, ts timestamp_ntz, rss_mb double")
    j, p = _land(spark, jobs), _land(spark, perf)

    def run(bound, k):
        st.stream_activity_perf(spark, j + "/in", jobs.schema, p + "/in", perf.schema, f"{j}/out{k}", f"{j}/ck{k}", bound)
        return spark.read.parquet(f"{j}/out{k}").count()

    assert run(12 * 3600, 1) == 13
    with pytest.raises(Exception):
        run(9 * 3600, 2)


def test_counts_of_activities_are_those_of_their_pairs(spark, monkeypatch):
    import random

    from pyspark.sql import functions as F

    from stockflow.plans.catalog import QUERIES, load_all
    from stockflow.streaming import streams as st
    rng = random.Random(5)
    at = lambda s: T0 + timedelta(seconds=s)
    starts = [(None if i == 3 else i // 2, rng.randint(0, 200_000), rng.choice([0, 5, 3000, 20_000])) for i in range(200)]
    jobs = spark.createDataFrame([(i, at(s), at(s + n)) for i, s, n in starts], "event_id long, started_at timestamp_ntz, finished_at timestamp_ntz")
    rss = lambda: rng.choice([None, None, 1.5, float("nan"), *[rng.random() * 9 for _ in range(20)]])
    perf = spark.createDataFrame([(i, at(rng.choice(starts)[1] if i % 9 == 0 else rng.randint(-5000, 230_000)), rss()) for i in range(3000)],
                                 "event_id long, ts timestamp_ntz, rss_mb double")
    j, p = _land(spark, jobs.limit(0)), _land(spark, perf.limit(0))
    for part in range(4):  # an activity's samples come before it, with it and after it
        jobs.filter(F.coalesce(F.pmod("event_id", F.lit(4)), F.lit(2)) == 3 - part).write.mode("append").parquet(j + "/in")
        perf.filter(F.pmod("event_id", F.lit(4)) == part).write.mode("append").parquet(p + "/in")
        for pairs in (False, True):
            st.stream_activity_perf(spark, j + "/in", jobs.schema, p + "/in", perf.schema, f"{j}/out{pairs}", f"{j}/ck{pairs}", 20_000, pairs=pairs)
    got = spark.read.parquet(j + "/outFalse").groupBy("job_event").agg(F.sum("samples").alias("n"), F.max("max_rss_mb").alias("m"))
    want = spark.read.parquet(j + "/outTrue").groupBy("job_event").agg(F.count("*").alias("n"), F.max("rss_mb").alias("m"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 50
    load_all()
    monkeypatch.setattr(st, "activity_perf_join", None)  # the query writes no pairs
    assert QUERIES["i4_stream_activity_perf"](spark, SF0001).count() > 0


def test_a_stream_that_is_not_done_fails(spark):
    import pytest

    from stockflow.streaming import streams as st
    logs = spark.createDataFrame([(1, T0)], "event_id long, ts timestamp_ntz")
    path = _land(spark, logs)

    def slow(batch, _):
        import time
        time.sleep(20)

    stream = spark.readStream.schema(logs.schema).parquet(path + "/in")
    with pytest.raises(TimeoutError):
        st._run(stream.writeStream.foreachBatch(slow).option("checkpointLocation", path + "/ck"), True, 2)
    for q in spark.streams.active:
        q.stop()


def test_planted_lifecycles_are_found(spark):
    ev = fx.run_events(spark, "/root/testdata/sf0.01", planted=True)
    kinds = {r["violation"] for r in rn.lifecycle_violations(ev).select("violation").distinct().collect()}
    assert kinds == {"running_not_from_queued", "terminal_twice", "finish_before_start"}
    assert rn.lifecycle_violations(fx.run_events(spark, SF0001)).count() == 0
