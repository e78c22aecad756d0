"""Catalogue: run state (F3, G1-G8, G11) and logs (A11-A13, B9-B13, D2, D3, D6-D8, D13, D14,
F4-F9, F11, G9, G10)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from stockflow.functions.log_fields import cap_detail, duration_ms, duration_s, log_level
from stockflow.operators import enrich as en
from stockflow.operators import filters as fl
from stockflow.operators import logs as lg
from stockflow.operators import runs as rn
from stockflow.plans.catalog import query
from stockflow.plans.oracle_sql import RUNS_AS_OF, with_ctes
from stockflow.session import apply_session_conf, ensure_checkpoint_dir
from stockflow.sources import fixtures as fx

AS_OF = RUNS_AS_OF
SEEK_AFTER = ("2024-01-15 12:00:00", 0)


def _frames(spark, sf_dir):
    apply_session_conf(spark)
    return {"job": fx.job_logs(spark, sf_dir), "api": fx.api_logs(spark, sf_dir),
            "performance": fx.performance_logs(spark, sf_dir)}


def _runs(spark, sf_dir, as_of=None):
    apply_session_conf(spark)
    return rn.fold_runs(fx.run_events(spark, sf_dir), as_of)


# ---------------------------------------------------------------- G / F3: runs
@query("g1_fold_runs", with_ctes("SELECT * FROM runs", "runs"))
def g1(spark, sf_dir):
    return _runs(spark, sf_dir)


@query("g2_idempotent_runs", with_ctes("""
SELECT r.id, r.idempotency_key, f.canonical_id, r.id <> f.canonical_id AS replayed
FROM runs r JOIN (SELECT idempotency_key, first(id ORDER BY created_at, id) AS canonical_id FROM runs
                  WHERE idempotency_key IS NOT NULL GROUP BY idempotency_key) f USING (idempotency_key)
UNION ALL
SELECT id, idempotency_key, id, false FROM runs WHERE idempotency_key IS NULL""", "runs"))
def g2(spark, sf_dir):
    return rn.idempotent_runs(_runs(spark, sf_dir))


@query("g3_active_runs", with_ctes(f"""SELECT * FROM runs_asof WHERE status IN ('queued', 'running')
  AND created_at >= TIMESTAMP '{AS_OF}' - INTERVAL 3600 SECOND""", "runs_asof"))
def g3(spark, sf_dir):
    return rn.active_runs(_runs(spark, sf_dir, AS_OF), AS_OF)


@query("g4_lifecycle_violations", with_ctes("""
SELECT id, seq, state, event_at, violation FROM (
  SELECT *, CASE WHEN state = 'running' AND COALESCE(prev_state, '') <> 'queued' THEN 'running_not_from_queued'
                 WHEN state IN ('ok', 'failed') AND terminals > 1 THEN 'terminal_twice'
                 WHEN state IN ('ok', 'failed') AND event_at < running_at THEN 'finish_before_start' END AS violation
  FROM (SELECT *, lag(state) OVER (PARTITION BY id ORDER BY seq, event_at) AS prev_state,
               count(*) FILTER (WHERE state IN ('ok', 'failed')) OVER (PARTITION BY id) AS terminals,
               max(event_at) FILTER (WHERE state = 'running') OVER (PARTITION BY id) AS running_at
        FROM run_events_planted) e) v WHERE violation IS NOT NULL""", "run_events_planted"))
def g4(spark, sf_dir):
    apply_session_conf(spark)
    return rn.lifecycle_violations(fx.run_events(spark, sf_dir, planted=True))


@query("g5_stuck_runs", with_ctes(f"""SELECT * FROM runs_asof WHERE status IN ('queued', 'running')
  AND created_at < TIMESTAMP '{AS_OF}' - INTERVAL 3600 SECOND""", "runs_asof"))
def g5(spark, sf_dir):
    return rn.stuck_runs(_runs(spark, sf_dir, AS_OF), AS_OF)


_G6 = """SELECT {sel} max(open_runs) AS peak_overlap FROM (
  SELECT {sel} sum(d) OVER ({part} ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS open_runs
  FROM (SELECT {sel} t, sum(d) AS d FROM (
          SELECT {sel} started_at AS t, 1 AS d FROM runs WHERE started_at IS NOT NULL AND finished_at IS NOT NULL
          UNION ALL
          SELECT {sel} finished_at, -1 FROM runs WHERE started_at IS NOT NULL AND finished_at IS NOT NULL) e
        GROUP BY {grp} t) p) s {grp2}"""


@query("g6_peak_overlap", with_ctes(
    _G6.format(sel="", part="", grp="", grp2="").replace("SELECT  max", "SELECT CAST(max(open_runs) AS BIGINT) AS peak_overlap, max").replace(
        ", max(open_runs) AS peak_overlap FROM", " FROM"), "runs"))
def g6(spark, sf_dir):
    return rn.peak_overlap(_runs(spark, sf_dir)).select(F.col("peak_overlap").cast("bigint"))


@query("g6_peak_overlap_by_job", with_ctes(
    _G6.format(sel="job,", part="PARTITION BY job", grp="job,", grp2="GROUP BY job").replace(
        "max(open_runs) AS peak_overlap", "CAST(max(open_runs) AS BIGINT) AS peak_overlap"), "runs"))
def g6j(spark, sf_dir):
    return rn.peak_overlap(_runs(spark, sf_dir), ["job"]).select("job", F.col("peak_overlap").cast("bigint"))


@query("g7_one_active_violations", with_ctes("""SELECT job, count(*) AS active_api_runs FROM runs_asof_planted
  WHERE status IN ('queued', 'running') AND trigger = 'api' GROUP BY job HAVING count(*) > 1""", "runs_asof_planted"))
def g7(spark, sf_dir):
    apply_session_conf(spark)
    return rn.one_active_violations(rn.fold_runs(fx.run_events(spark, sf_dir, planted=True), AS_OF))


@query("g8_job_health", with_ctes("""
SELECT a.*, l.last_status FROM (
  SELECT job, count(*) AS runs, count_if(status = 'failed') AS failures, sum(rows) AS rows,
         round(avg(duration_s), 3) AS mean_duration_s, round(quantile_cont(duration_s, 0.95), 3) AS p95_duration_s
  FROM runs GROUP BY job) a
LEFT JOIN (SELECT job, arg_max(status, (created_at, id)) AS last_status FROM runs
           WHERE status IN ('ok', 'failed') GROUP BY job) l USING (job)""", "runs"))
def g8(spark, sf_dir):
    return rn.job_health(_runs(spark, sf_dir))


_CHANGED = ("state", "trigger", "rows", "correlation_id")


@query("g11_change_list", with_ctes("""SELECT id, seq, event_at, trigger, field, before, after FROM (""" + " UNION ALL ".join(
    f"SELECT id, seq, event_at, trigger, '{c}' AS field, lag(CAST({c} AS VARCHAR)) OVER w AS before, CAST({c} AS VARCHAR) AS after FROM amended WINDOW w AS (PARTITION BY id ORDER BY seq, event_at)"
    for c in _CHANGED) + """) u WHERE before IS DISTINCT FROM after""", "run_events").replace("\nSELECT id, seq, event_at, trigger, field", """,
amended AS (SELECT * REPLACE (CASE WHEN id % 7 = 0 AND seq = 1 THEN 'cli' ELSE trigger END AS trigger, CASE WHEN id % 11 = 0 AND seq = 2 THEN NULL ELSE correlation_id END AS correlation_id)
  FROM run_events)
SELECT id, seq, event_at, trigger, field""", 1))
def g11_changes(spark, sf_dir):
    """Every field that an event changes, with planted amendments: another trigger, a lost correlation id."""
    apply_session_conf(spark)
    ev = fx.run_events(spark, sf_dir)
    ev = (ev.withColumn("trigger", F.when((F.pmod("id", F.lit(7)) == 0) & (F.col("seq") == 1), "cli").otherwise(F.col("trigger")))
          .withColumn("correlation_id", F.when((F.pmod("id", F.lit(11)) != 0) | (F.col("seq") != 2), F.col("correlation_id"))))
    return rn.change_rows(rn.change_list(ev, list(_CHANGED)))


@query("g11_replay_entity", with_ctes("""SELECT id, seq, event_at, trigger, lag(state) OVER (PARTITION BY id ORDER BY seq, event_at) AS before,
  state AS after FROM run_events""", "run_events"))
def g11(spark, sf_dir):
    apply_session_conf(spark)
    return rn.replay_entity(fx.run_events(spark, sf_dir))


@query("g11_current_state", with_ctes("SELECT id, arg_max(state, seq) AS state FROM run_events GROUP BY id", "run_events"))
def g11c(spark, sf_dir):
    apply_session_conf(spark)
    return rn.current_state(fx.run_events(spark, sf_dir))


@query("f3_latest_terminal", with_ctes("""SELECT job, r.id, r.status, r.created_at, r.finished_at, r.rows FROM (
  SELECT job, arg_max({'id': id, 'status': status, 'created_at': created_at, 'finished_at': finished_at, 'rows': rows},
                      (created_at, id)) AS r FROM runs WHERE status IN ('ok', 'failed') GROUP BY job) t""", "runs"))
def f3(spark, sf_dir):
    return rn.latest_terminal(_runs(spark, sf_dir))


# ---------------------------------------------------------------- logs
@query("g9_api_health", with_ctes("""SELECT path, date_trunc('hour', ts) AS bucket, count(*) AS requests,
  count_if(status_code >= 400 AND status_code < 500) AS n_4xx, count_if(status_code >= 500) AS n_5xx,
  quantile_cont(duration_ms, 0.95) AS p95_ms FROM api_logs GROUP BY ALL""", "api_logs"))
def g9(spark, sf_dir):
    return lg.api_health(_frames(spark, sf_dir)["api"])


@query("g10_perf_series", with_ctes("""SELECT host, date_trunc('hour', ts) AS bucket, count(*) AS samples,
  count_if(date_diff('microsecond', prev_ts, ts) > 15000000) AS gaps,
  round(avg(cpu_pct), 6) AS avg_cpu_pct, max(cpu_pct) AS max_cpu_pct, round(avg(rss_mb), 6) AS avg_rss_mb,
  max(rss_mb) AS max_rss_mb, round(avg(mem_pct), 6) AS avg_mem_pct, max(mem_pct) AS max_mem_pct,
  round(avg(disk_pct), 6) AS avg_disk_pct, max(disk_pct) AS max_disk_pct
FROM (SELECT *, lag(ts) OVER (PARTITION BY host ORDER BY ts, event_id) AS prev_ts FROM perf_logs) p GROUP BY ALL""",
    "perf_logs"))
def g10(spark, sf_dir):
    return lg.perf_series(_frames(spark, sf_dir)["performance"])


@query("f4_io_delta", with_ctes("""SELECT event_id, ts, round(COALESCE(io_counter_mb - lag(io_counter_mb) OVER
  (PARTITION BY host ORDER BY ts, event_id), 0.0e0), 4) AS disk_io_mb FROM perf_logs""", "perf_logs"))
def f4(spark, sf_dir):
    return lg.io_delta(_frames(spark, sf_dir)["performance"]).select("event_id", "ts", "disk_io_mb")


@query("f5_seek_page", with_ctes(f"""SELECT event_id, ts, job, status FROM job_logs
WHERE ts < TIMESTAMP '{SEEK_AFTER[0]}' OR (ts = TIMESTAMP '{SEEK_AFTER[0]}' AND event_id < {SEEK_AFTER[1]})
ORDER BY ts DESC, event_id DESC LIMIT 101""", "job_logs"))
def f5(spark, sf_dir):
    return lg.seek_page(_frames(spark, sf_dir)["job"], after=SEEK_AFTER, desc=True, limit=100).select(
        "event_id", "ts", "job", "status")


@query("f6_seek_union", with_ctes(f"""SELECT type, ts, event_id, level, correlation_id FROM unified
WHERE ts < TIMESTAMP '{SEEK_AFTER[0]}' OR (ts = TIMESTAMP '{SEEK_AFTER[0]}' AND (type_rank > 1 OR (type_rank = 1 AND event_id < 0)))
ORDER BY ts DESC, type_rank ASC, event_id DESC LIMIT 101""", "unified"))
def f6(spark, sf_dir):
    return lg.seek_union(_frames(spark, sf_dir), after=(SEEK_AFTER[0], "api", 0), desc=True, limit=100).select(
        "type", "ts", "event_id", "level", "correlation_id")


@query("f7_sort_spec", with_ctes("SELECT event_id, ts, job FROM job_logs ORDER BY ts DESC, job ASC LIMIT 50", "job_logs"))
def f7(spark, sf_dir):
    jl = _frames(spark, sf_dir)["job"]
    return jl.orderBy(*lg.sort_spec("-ts,job", ("ts", "job"))).limit(50).select("event_id", "ts", "job")


@query("f8_unified_logs", with_ctes(
    "SELECT type, type_rank, event_id, ts, level, status, job, path, status_code, rss_mb FROM unified", "unified"))
def f8(spark, sf_dir):
    return lg.unified_logs(_frames(spark, sf_dir)).select(
        "type", "type_rank", "event_id", "ts", "level", "status", "job", "path", "status_code", "rss_mb")


@query("f9_narrow_kinds", with_ctes("SELECT type, event_id, status FROM unified WHERE status = 'failed'", "unified"))
def f9(spark, sf_dir):
    kinds = lg.narrow_kinds(status="failed")
    u = lg.unified_logs(_frames(spark, sf_dir), kinds)
    return u.filter(F.col("status") == "failed").select("type", "event_id", "status")


@query("f11_query_kind", with_ctes("""SELECT event_id, ts, path, status_code FROM api_logs
WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-20 00:00:00' AND status_code >= 400
ORDER BY ts DESC, event_id DESC LIMIT 50""", "api_logs"))
def f11(spark, sf_dir):
    return lg.query_kind(_frames(spark, sf_dir), "api", "2024-01-05 00:00:00", "2024-01-20 00:00:00",
                         F.col("status_code") >= 400, "ts", True, 50).select("event_id", "ts", "path", "status_code")


@query("d2_range_filter", with_ctes("""SELECT event_id, ts FROM job_logs
WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts <= TIMESTAMP '2024-01-12 23:59:59'""", "job_logs"))
def d2(spark, sf_dir):
    return fl.range_filter(_frames(spark, sf_dir)["job"], "ts", F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"),
                           F.lit("2024-01-12 23:59:59").cast("timestamp_ntz")).select("event_id", "ts")


@query("d3_field_filters", with_ctes(
    "SELECT event_id, job, status FROM job_logs WHERE status = 'failed' AND job = 'sync-movements'", "job_logs"))
def d3(spark, sf_dir):
    return fl.field_filters(_frames(spark, sf_dir)["job"], status="failed", job="sync-movements",
                            correlation_id=None).select("event_id", "job", "status")


@query("d6_activity_during", with_ctes("""SELECT a.event_id AS job_event, count(*) AS samples, max(p.rss_mb) AS max_rss_mb
FROM job_logs a JOIN perf_logs p ON a.started_at <= p.ts AND p.ts <= a.finished_at GROUP BY ALL""", "job_logs", "perf_logs"))
def d6(spark, sf_dir):
    """Per activity, as pairs grow with the square of the event rate; the filtered form lists them."""
    fr = _frames(spark, sf_dir)
    return lg.activity_during(fr["job"], fr["performance"]).groupBy(F.col("a.event_id").alias("job_event")).agg(
        F.count("*").alias("samples"), F.max("p.rss_mb").alias("max_rss_mb"))


@query("d6_activity_during_high_rss", with_ctes("""SELECT a.event_id AS job_event, p.event_id AS sample_event, p.rss_mb
FROM job_logs a JOIN perf_logs p ON a.started_at <= p.ts AND p.ts <= a.finished_at WHERE p.rss_mb > 4000""",
    "job_logs", "perf_logs"))
def d6h(spark, sf_dir):
    fr = _frames(spark, sf_dir)
    return lg.activity_during(fr["job"], fr["performance"], F.col("rss_mb") > 4000).select(
        F.col("a.event_id").alias("job_event"), F.col("p.event_id").alias("sample_event"), F.col("p.rss_mb"))


@query("d7_trace", with_ctes("""SELECT type, ts, event_id, correlation_id FROM (
  SELECT type, ts, event_id, correlation_id FROM unified
  UNION ALL SELECT 'run', created_at, id, correlation_id FROM runs) a
WHERE correlation_id IN (SELECT correlation_id FROM job_logs WHERE status = 'failed')""", "unified", "runs"))
def d7(spark, sf_dir):
    fr = _frames(spark, sf_dir)
    ids = fr["job"].filter(F.col("status") == "failed").select("correlation_id")
    return lg.trace(fr, _runs(spark, sf_dir), ids).select("type", "ts", "event_id", "correlation_id")


@query("d8_runs_with_logs", with_ctes("""SELECT r.id, r.status, j.status AS log_status, j.ts AS log_ts, j.ts IS NOT NULL AS has_log
FROM runs r LEFT JOIN (SELECT * FROM job_logs WHERE event_id % 83 <> 0) j ON r.id = j.event_id""", "runs", "job_logs"))
def d8(spark, sf_dir):
    fr = _frames(spark, sf_dir)
    return lg.runs_with_logs(_runs(spark, sf_dir), fx.without_lost_logs(fr["job"])).select("id", "status", "log_status", "log_ts", "has_log")


@query("d8_runs_without_logs", with_ctes("SELECT id FROM runs WHERE id NOT IN (SELECT event_id FROM job_logs WHERE event_id % 83 <> 0)",
                                          "runs", "job_logs"))
def d8a(spark, sf_dir):
    fr = _frames(spark, sf_dir)
    return lg.runs_without_logs(_runs(spark, sf_dir), fx.without_lost_logs(fr["job"])).select("id")


@query("d13_lookup", with_ctes("""SELECT r.* FROM runs r JOIN (SELECT job, min(event_id) AS first_id FROM job_logs GROUP BY job) k
  ON r.job = k.job AND r.id = k.first_id""", "runs", "job_logs"))
def d13(spark, sf_dir):
    # Point lookups by (job, id): the keys (first run of every job) come from the data.
    runs = _runs(spark, sf_dir)
    keys = _frames(spark, sf_dir)["job"].groupBy("job").agg(F.min("event_id").alias("id"))
    return runs.join(keys, ["job", "id"], "left_semi")


@query("d13_lookup_literal", with_ctes("SELECT * FROM runs WHERE job = 'sync-movements' AND id = 14", "runs"))
def d13l(spark, sf_dir):
    return fl.lookup(_runs(spark, sf_dir), job="sync-movements", id=14)


@query("d14_text_search", with_ctes(
    "SELECT event_id, job FROM job_logs WHERE contains(lower(job), 'backfill') OR contains(lower(status), 'backfill')",
    "job_logs"))
def d14(spark, sf_dir):
    return fl.text_search(_frames(spark, sf_dir)["job"], "BackFill", ["job", "status"]).select("event_id", "job")


@query("a11_roll_off_logs", with_ctes("SELECT type, event_id, ts, level, correlation_id, CAST(ts AS DATE) AS day FROM unified", "unified"))
def a11(spark, sf_dir):
    u = lg.unified_logs(_frames(spark, sf_dir)).select("type", "event_id", "ts", "level", "correlation_id")
    path = os.path.join(ensure_checkpoint_dir(spark), f"rolloff-{uuid.uuid4().hex}")
    lg.roll_off_logs(u, path)
    return spark.read.parquet(path)


@query("a12_prune_logs", with_ctes("""SELECT type, event_id, ts FROM unified
WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY""", "unified"))
def a12(spark, sf_dir):
    return lg.prune_logs(lg.unified_logs(_frames(spark, sf_dir)), 7, "2024-01-31 00:00:00").select(
        "type", "event_id", "ts")


@query("a13_append_batches", with_ctes("SELECT * FROM api_logs", "api_logs"))
def a13(spark, sf_dir):
    api = _frames(spark, sf_dir)["api"]
    path = os.path.join(ensure_checkpoint_dir(spark), f"append-{uuid.uuid4().hex}")
    assert lg.append_batches(api, "unknown-kind", path) == 0
    odd = F.pmod("event_id", F.lit(2)) == 1
    lg.append_batches(api.filter(odd), "api", path)  # two batches land side by side
    lg.append_batches(api.filter(~odd), "api", path)
    return spark.read.parquet(path)


@query("b9_log_level", with_ctes("""SELECT event_id, status_code,
  CASE WHEN status_code >= 500 THEN 'error' WHEN status_code >= 400 THEN 'warn' ELSE 'info' END AS level,
  status_code >= 400 AS failed FROM api_logs""", "api_logs"))
def b9(spark, sf_dir):
    a = _frames(spark, sf_dir)["api"]
    return a.select("event_id", "status_code", log_level().alias("level"), (F.col("status_code") >= 400).alias("failed"))


@query("b10_duration", with_ctes("""SELECT id, date_diff('microsecond', started_at, finished_at) // 1000 AS duration_ms,
  date_diff('microsecond', started_at, finished_at) / 1e6 AS duration_s FROM runs""", "runs"))
def b10(spark, sf_dir):
    r = _runs(spark, sf_dir)
    return r.select("id", duration_ms().alias("duration_ms"), duration_s().alias("duration_s"))


@query("b11_cap_detail", with_ctes("""SELECT event_id,
  CASE WHEN status_code >= 400 THEN left(detail, 6) END AS detail
FROM api_logs""", "api_logs"))
def b11(spark, sf_dir):
    a = _frames(spark, sf_dir)["api"]
    return a.select("event_id", cap_detail("detail", F.col("status_code") >= 400, 6).alias("detail"))


@query("b12_redact", with_ctes(
    "SELECT event_id, regexp_replace(correlation_id, '[0-9a-f]{28}$', '****') AS correlation_id FROM job_logs",
    "job_logs"))
def b12(spark, sf_dir):
    jl = _frames(spark, sf_dir)["job"]
    return en.redact(jl, {"correlation_id": ("[0-9a-f]{28}$", "****")}).select("event_id", "correlation_id")


@query("b13_project_fields", with_ctes("SELECT event_id, job, status FROM job_logs", "job_logs"))
def b13(spark, sf_dir):
    return en.project_fields(_frames(spark, sf_dir)["job"], ["event_id", "job", "status"])
