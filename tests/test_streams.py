import os
import uuid
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from stockflow.plans import lake
from stockflow.session import ensure_checkpoint_dir
from stockflow.sources import fixtures as fx
from stockflow.sources.movements import finalize
from stockflow.streaming import streams as st

EVENTS = ("id long, job string, trigger string, correlation_id string, idempotency_key string, seq int, "
          "state string, event_at timestamp_ntz, rows long")
T0 = datetime(2026, 6, 22, 10, 0)


def _folder(spark):
    return os.path.join(ensure_checkpoint_dir(spark), f"t-streams-{uuid.uuid4().hex}")


def _event(run, seq, state, at_s, rows=None):
    return (run, "job", "api", None, None, seq, state, T0 + timedelta(seconds=at_s), rows)


def _verdicts(spark, batches, **conf):
    """Rows of the stream after the given batches of events, one trigger for each."""
    base = _folder(spark)
    for rows in batches:
        df = spark.createDataFrame(rows, EVENTS)
        df.coalesce(1).write.mode("append").parquet(base + "/in")
        st.stream_run_state(spark, base + "/in", df.schema, base + "/out", base + "/ckpt", **conf)
    at = lambda x: None if x is None else int((x - T0).total_seconds())
    out = spark.read.parquet(base + "/out").withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("created_at", "started_at", "finished_at")}).collect()
    return sorted((r.id, r.status, at(r.created_at), at(r.started_at), at(r.finished_at), r.rows, r.was_stuck) for r in out)


def test_events_out_of_order_give_one_row(spark):
    got = _verdicts(spark, [[_event(1, 1, "running", 5), _event(1, 2, "ok", 65, 42)], [_event(1, 0, "queued", 0)], [_event(9, 0, "queued", 7200)]])
    assert got == [(1, "ok", 0, 5, 65, 42, False)]


def test_stuck_at_its_limit_then_ends(spark):
    batches = [[_event(1, 0, "queued", 0), _event(1, 1, "running", 5), _event(2, 0, "queued", 0), _event(2, 1, "running", 9), _event(2, 2, "ok", 3600, 1),
                _event(3, 1, "running", 100)],
               [_event(9, 0, "queued", 4000)],                      # watermark 3400: nobody is stuck yet
               [_event(9, 1, "running", 4250)],                     # watermark 3650: 1 is, 3 (created unknown) is not
               [_event(9, 2, "failed", 5000, 0), _event(1, 2, "ok", 4900, 7)],
               [_event(8, 0, "queued", 9000)]]
    got = _verdicts(spark, batches)
    assert got == [(1, "ok", 0, 5, 4900, 7, True), (1, "stuck", 0, 5, None, None, True), (2, "ok", 0, 9, 3600, 1, False),
                   (3, "stuck", None, 100, None, None, True), (9, "failed", 4000, 4250, 5000, 0, False)]
    assert _verdicts(spark, batches[:2]) == []
    assert [x[:2] for x in _verdicts(spark, batches[:3])] == [(1, "stuck"), (2, "ok")]


def test_late_and_repeated_events_give_no_second_row(spark):
    first = [_event(1, 0, "queued", 0), _event(1, 1, "running", 5), _event(1, 2, "ok", 60, 3)]
    got = _verdicts(spark, [first, [_event(9, 0, "queued", 1000)], [*first, _event(1, 3, "failed", 61, 4)],
                            [_event(1, 3, "failed", 900, 4), _event(1, 1, "running", 950)], [_event(9, 1, "running", 4000)]])
    assert got == [(1, "ok", 0, 5, 60, 3, False)]


def test_tombstones_leave_in_time(spark):
    first = [_event(1, 0, "queued", 0), _event(1, 2, "ok", 60, 3)]
    late = [[_event(9, 0, "queued", 20_000)], [_event(9, 1, "running", 40_000)], [_event(1, 3, "failed", 39_900, 4)], [_event(9, 2, "ok", 60_000, 1)]]
    assert [x[:2] for x in _verdicts(spark, [first, *late], keep_s=86400) if x[0] == 1] == [(1, "ok")]
    # dropped after 100 s of event time: the id may be used again
    assert [x[:2] for x in _verdicts(spark, [first, *late], keep_s=100) if x[0] == 1] == [(1, "failed"), (1, "ok")]


def test_batches_do_not_change_the_rows(spark):
    import random
    rng = random.Random(3)
    rows = []
    for run in range(40):
        at = rng.randint(0, 20_000)
        steps = [_event(run, 0, "queued", at), _event(run, 1, "running", at + rng.randint(1, 5000)), _event(run, 2, rng.choice(["ok", "failed"]), at + rng.randint(1, 9000), run),
                 _event(run, 3, "failed", at + rng.randint(1, 9000), -run)]
        rows += rng.sample(steps, rng.randint(1, 4))
    rows.sort(key=lambda r: r[7])
    end = [_event(999, 0, "queued", 60_000)]
    one = _verdicts(spark, [rows, end])
    cuts = [0, *sorted(rng.sample(range(len(rows)), 3)), len(rows)]
    parts = [rows[a:b] for a, b in zip(cuts, cuts[1:])]
    for k in range(len(parts) - 1):  # some events come one batch later, within the allowed delay
        slow = [r for r in parts[k] if r[7] > parts[k][-1][7] - timedelta(seconds=500) and rng.random() < .5][:3]
        parts[k] = [r for r in parts[k] if r not in slow]
        parts[k + 1] = slow + parts[k + 1]
    assert _verdicts(spark, [*[p for p in parts if p], end], delay="2 hours") == _verdicts(spark, [rows, end], delay="2 hours")
    assert len(one) > 40


def test_sync_is_the_same_in_one_batch_or_many(spark):
    src = (fx.movement_source(spark, SF0001).filter("company = 'HR' and create_date >= '1996-01-01' and create_date < '1996-03-01'")
           .withColumn("trans_type", F.col("trans_type").cast("string")))
    five = src.limit(5).withColumn("trans_type", F.lit("no number"))  # null trans_type, and null mov_id with it
    rows = src.unionByName(five)
    want = None
    for max_files in (None, 1):
        base = _folder(spark)
        for _ in range(2):  # the same rows in two files, one of which repeats five
            rows.coalesce(1).write.mode("append").parquet(base + "/in")
        five.coalesce(1).unionByName(five.coalesce(1)).coalesce(1).write.mode("append").parquet(base + "/in")
        st.stream_sync(spark, base + "/in", rows.schema, base + "/out", base + "/ckpt", max_files=max_files)
        got = sorted(map(str, lake.read_table(spark, base + "/out").collect()))
        assert len(got) == src.count() + 10
        assert want in (None, got)
        want = got


@pytest.fixture
def loaded(spark):
    src = fx.movement_source(spark, SF0001)
    root = _folder(spark)
    lake.replace_window(spark, root, finalize(src), ["COMERCIAL", "CAP", "HR"], date(1990, 1, 1), date(2005, 1, 1))
    return src, root


def _whole(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("window", [(date(1990, 1, 1), date(2005, 1, 1)), (date(1996, 3, 10), date(1997, 2, 20))])
def test_a_company_without_rows_keeps_what_it_has(spark, loaded, window):
    src, root = loaded
    before = _whole(lake.read_table(spark, root))
    assert lake.read_table(spark, root).filter("company = 'HR'").count() == 2319
    inc = finalize(src).filter((F.col("company") != "HR") & (F.col("create_date") >= F.lit(window[0])) & (F.col("create_date") < F.lit(window[1])))
    n = lake.replace_window(spark, root, inc, ["COMERCIAL", "CAP", "HR"], *window)
    assert n == inc.count()
    assert _whole(lake.read_table(spark, root)) == before
    lake.replace_window(spark, root, inc.limit(0), ["HR"], *window, allow_empty=True)
    inside = lake.read_table(spark, root).filter((F.col("company") == "HR") & (F.col("create_date") >= F.lit(window[0])) & (F.col("create_date") < F.lit(window[1])))
    assert inside.count() == 0


def test_merge_without_a_delivery_takes_equal_rows_once(spark):
    src = finalize(fx.movement_source(spark, SF0001)).filter("company = 'HR' and create_date >= '1996-01-01' and create_date < '1996-02-01'")
    five = src.limit(5).withColumn("mov_id", F.when(F.col("doc_line") % 2 == 0, F.col("mov_id")))
    window = ("HR", date(1996, 1, 1), date(1996, 2, 1))
    one, two = _folder(spark), _folder(spark)
    lake.merge_window(spark, one, five.unionByName(five), *window)
    for _ in range(3):
        lake.merge_window(spark, two, five, *window)
    assert _whole(lake.read_table(spark, one)) == _whole(lake.read_table(spark, two)) == _whole(five.distinct())


def test_a_merge_adds_what_lacks_and_leaves_the_rest(spark, loaded):
    src, root = loaded
    before = set(lake.read_table(spark, root).inputFiles())
    mov = finalize(src).filter("company <> 'CAP' and create_date >= '1996-01-01' and create_date < '1996-03-01'")
    windows = {c: (date(1996, 1, 1), date(1996, 3, 1)) for c in ("COMERCIAL", "HR")}
    few = mov.limit(3)
    few = spark.createDataFrame(few.collect(), few.schema).withColumn("in_qty", F.lit(0.125))
    batch = mov.withColumn("_f", F.lit("a")).unionByName(few.withColumn("_f", F.lit("b"))).unionByName(few.withColumn("_f", F.lit("b")))
    for derive in (finalize, None):  # the second time there is nothing to add
        lake.merge_windows(spark, root, batch, windows, "_f", derive)
        assert _whole(lake.read_table(spark, root)) == _whole(finalize(src).unionByName(few).unionByName(few))
        after = set(lake.read_table(spark, root).inputFiles())
        assert before < after and len(after - before) <= 6
    assert not lake._list_dirs(spark, root + "/_staging")
    with pytest.raises(Exception, match="outside"):
        lake.merge_windows(spark, root, batch, {"HR": (date(1996, 1, 1), date(1996, 3, 1))}, "_f")


def test_recovery_counts_whole_rows(spark):
    rows = finalize(fx.movement_source(spark, SF0001)).filter("company = 'HR' and create_date >= '1996-01-01' and create_date < '1996-02-01'").limit(6)
    rows = spark.createDataFrame(rows.collect(), rows.schema)
    twin = rows.limit(1).withColumn("in_qty", F.lit(123.0))            # same mov_id, other values
    none = rows.limit(2).withColumn("mov_id", F.lit(None).cast("string"))
    root, window = _folder(spark), (date(1996, 1, 1), date(1996, 2, 1))
    lake.replace_window(spark, root, rows.unionByName(none), "HR", *window)
    staged = rows.unionByName(none).unionByName(twin).unionByName(rows.limit(1)).withColumn("load_month", lake.load_month())
    own = f"{root}/_staging/cut-off"
    lake._write_leaves(staged, own + "/keep", "overwrite")
    path, fs = lake._path(spark, f"{own}/{lake.MARKER}")
    fs.create(path).close()
    assert lake.recover(spark, root) == 1
    want = _whole(rows.unionByName(none).unionByName(twin).unionByName(rows.limit(1)))
    assert _whole(lake.read_table(spark, root)) == want
    assert lake.recover(spark, root) == 0 and _whole(lake.read_table(spark, root)) == want


def test_backfill_commits_window_after_window(spark, monkeypatch):
    src = fx.movement_source(spark, SF0001)
    root, span = _folder(spark), (date(1990, 1, 1), date(2005, 1, 1))
    real, calls = lake.replace_window, []

    def cut_off(spark, root, incoming, company, since, until, **more):
        calls.append(since)
        if len(calls) == 4:
            raise RuntimeError("cut off")
        return real(spark, root, incoming, company, since, until, **more)

    monkeypatch.setattr(lake, "replace_window", cut_off)
    with pytest.raises(RuntimeError):
        lake.backfill(spark, root, src, ["HR", "CAP"], *span)
    rows = finalize(src).filter("company in ('HR', 'CAP')")
    assert _whole(lake.read_table(spark, root)) == _whole(rows.filter(F.col("create_date") < F.lit(calls[3])))
    report = lake.backfill(spark, root, src, ["HR", "CAP"], calls[3], span[1])  # resumed at the window that failed
    assert sum(n for _, _, n in report) == rows.filter(F.col("create_date") >= F.lit(calls[3])).count()
    assert _whole(lake.read_table(spark, root)) == _whole(rows)


def test_runs_share_state_values(spark):
    """Thousands of runs are a bounded number of state values, and each still gets its own rows."""
    at = lambda run, s: T0 + timedelta(seconds=run % 600 + s)
    runs = [None, *range(5000)]
    rows = [(run, "job", "api", None, None, seq, state, at(run or 0, s), n) for run in runs
            for seq, state, s, n in ((0, "queued", 0, None), (1, "running", 5, None), (2, "ok", 65, 2 ** 60 + 1)) if state != "ok" or run != 7]
    base = _folder(spark)
    for part in (rows[::2], rows[1::2], [_event(-1, 0, "queued", 8100)]):
        spark.createDataFrame(part, EVENTS).coalesce(1).write.mode("append").parquet(base + "/in")
        q = st.stream_run_state(spark, base + "/in", spark.createDataFrame([], EVENTS).schema, base + "/out", base + "/ckpt", delay="1 hour")
        assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= st.RUN_BUCKETS + 1
    got = {r.id: r for r in spark.read.parquet(base + "/out").withColumn("s", F.timestamp_diff("SECOND", "created_at", "finished_at")).collect()}
    assert set(got) == set(runs) and got.pop(7).status == "stuck"
    assert {(r.status, r.s, r.rows, r.was_stuck) for r in got.values()} == {("ok", 65, 2 ** 60 + 1, False)}


@pytest.mark.parametrize("query, flow", [("a7_sync", "sync"), ("a8_backfill", "backfill")])
def test_windows_are_pulled_from_an_extract_put_together_once(spark, monkeypatch, query, flow):
    from stockflow.plans.catalog import QUERIES, load_all
    load_all()
    plans, real = [], getattr(lake, flow)

    def seen(spark, root, source, *args, **more):
        plans.append(source._jdf.queryExecution().optimizedPlan().toString())
        return real(spark, root, source, *args, **more)

    monkeypatch.setattr(lake, flow, seen)
    assert QUERIES[query](spark, SF0001).count() == fx.movement_source(spark, SF0001).count()
    assert plans and not any("Join" in p for p in plans)
