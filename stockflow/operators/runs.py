"""Run-state analytics (F3, G1-G8, G11) over append-only run events.

Run events are ``(id, job, trigger, correlation_id, idempotency_key, seq, state, event_at, rows)``.
Every per-run step groups by run id (three events per run), so no group grows with the data;
per-job results use aggregates with partial (map-side) combine rather than windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stockflow.functions.log_fields import duration_s
from stockflow.operators.sequence import exact_percentile, prefix_max

# fixed values: states, active states and the staleness limit
TERMINAL = ("ok", "failed")
ACTIVE = ("queued", "running")
STALE_SECONDS = 3600


def fold_runs(events: DataFrame, as_of=None) -> DataFrame:
    """G1: one current row per run from its events (optionally only events up to ``as_of``).

    queued -> running -> ok/failed; on finalise ``started_at = coalesce(running, finished)``.
    """
    ev = events if as_of is None else events.filter(F.col("event_at") <= F.lit(as_of).cast("timestamp_ntz"))
    st = F.col("state")
    g = ev.groupBy("id").agg(
        F.max("job").alias("job"), F.max("trigger").alias("trigger"),
        F.max("correlation_id").alias("correlation_id"), F.max("idempotency_key").alias("idempotency_key"),
        F.max_by("state", F.struct("seq", "event_at")).alias("status"),
        F.min(F.when(st == "queued", F.col("event_at"))).alias("created_at"),
        F.max(F.when(st == "running", F.col("event_at"))).alias("running_at"),
        F.max(F.when(st.isin(*TERMINAL), F.col("event_at"))).alias("finished_at"),
        F.max(F.when(st.isin(*TERMINAL), F.col("rows"))).alias("rows"),
    )
    started = F.when(F.col("finished_at").isNotNull(), F.coalesce("running_at", "finished_at")) \
        .otherwise(F.col("running_at"))
    return g.select(
        "id", "job", "status", "trigger", "rows", F.lit(None).cast("string").alias("detail"),
        "correlation_id", "idempotency_key",
        F.coalesce("created_at", "running_at", "finished_at").alias("created_at"),
        started.alias("started_at"), "finished_at",
        duration_s(started, F.col("finished_at")).alias("duration_s"))


def latest_terminal(runs: DataFrame) -> DataFrame:
    """latest ok/failed run per job by ``created_at desc, id desc`` (max_by, no window)."""
    t = runs.filter(F.col("status").isin(*TERMINAL))
    best = F.max_by(F.struct("id", "status", "created_at", "finished_at", "rows"), F.struct("created_at", "id"))
    return t.groupBy("job").agg(best.alias("r")).select("job", "r.*")


def idempotent_runs(runs: DataFrame) -> DataFrame:
    """The first request per idempotency key wins; later ones map to it. Null keys never
    deduplicate. One aggregate per key (partial combine absorbs a hot key), then a join."""
    keyed = runs.filter(F.col("idempotency_key").isNotNull())
    first = keyed.groupBy("idempotency_key").agg(
        F.min_by("id", F.struct("created_at", "id")).alias("canonical_id"))
    a = keyed.join(first, "idempotency_key").select("id", "idempotency_key", "canonical_id")
    b = runs.filter(F.col("idempotency_key").isNull()).select(
        "id", "idempotency_key", F.col("id").alias("canonical_id"))
    return a.unionByName(b).withColumn("replayed", F.col("id") != F.col("canonical_id"))


def active_runs(runs: DataFrame, as_of, stale_s: int = STALE_SECONDS) -> DataFrame:
    """queued/running and created within the staleness limit."""
    cutoff = F.timestamp_add("SECOND", F.lit(-stale_s), F.lit(as_of).cast("timestamp_ntz"))
    return runs.filter(F.col("status").isin(*ACTIVE) & (F.col("created_at") >= cutoff))


def stuck_runs(runs: DataFrame, as_of, stale_s: int = STALE_SECONDS) -> DataFrame:
    """Active-status runs older than the staleness limit (complement of G3)."""
    cutoff = F.timestamp_add("SECOND", F.lit(-stale_s), F.lit(as_of).cast("timestamp_ntz"))
    return runs.filter(F.col("status").isin(*ACTIVE) & (F.col("created_at") < cutoff))


def lifecycle_violations(events: DataFrame) -> DataFrame:
    """Running not from queued, terminal twice, finish before start (per-run window)."""
    w = Window.partitionBy("id").orderBy("seq", "event_at")
    x = events.withColumn("prev_state", F.lag("state").over(w)) \
              .withColumn("terminals", F.count(F.when(F.col("state").isin(*TERMINAL), 1)).over(
                  Window.partitionBy("id"))) \
              .withColumn("running_at", F.max(F.when(F.col("state") == "running", F.col("event_at"))).over(
                  Window.partitionBy("id")))
    st = F.col("state")
    kind = (F.when((st == "running") & (F.coalesce(F.col("prev_state"), F.lit("")) != "queued"), "running_not_from_queued")
             .when(st.isin(*TERMINAL) & (F.col("terminals") > 1), "terminal_twice")
             .when(st.isin(*TERMINAL) & (F.col("event_at") < F.col("running_at")), "finish_before_start"))
    return x.withColumn("violation", kind).filter(F.col("violation").isNotNull()) \
            .select("id", "seq", "state", "event_at", "violation")


def peak_overlap(runs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Max number of runs open at the same time ([started, finished) intervals)."""
    by = by or []
    r = runs.filter(F.col("started_at").isNotNull() & F.col("finished_at").isNotNull())
    if not by:
        r = r.withColumn("_all", F.lit(1))
    keys = by or ["_all"]
    ev = r.select(*keys, F.explode(F.array(
        F.struct(F.col("started_at").alias("t"), F.lit(1).alias("d")),
        F.struct(F.col("finished_at").alias("t"), F.lit(-1).alias("d")))).alias("e")) \
        .select(*keys, F.col("e.t").alias("t"), F.col("e.d").alias("d"))
    out = prefix_max(ev, keys, "t", "d", "peak_overlap")
    return out.drop("_all") if not by else out


def one_active_violations(runs: DataFrame) -> DataFrame:
    """Jobs with more than one active API run."""
    return (runs.filter(F.col("status").isin(*ACTIVE) & (F.col("trigger") == "api"))
                .groupBy("job").agg(F.count(F.lit(1)).alias("active_api_runs"))
                .filter(F.col("active_api_runs") > 1))


def job_health(runs: DataFrame, q: float = 0.95, digits: int = 3) -> DataFrame:
    """Per job runs, failures, rows, mean / p95 duration and the last terminal status."""
    agg = runs.groupBy("job").agg(
        F.count(F.lit(1)).alias("runs"), F.count_if(F.col("status") == "failed").alias("failures"),
        F.sum("rows").alias("rows"), F.round(F.avg("duration_s"), digits).alias("mean_duration_s"))
    p95 = exact_percentile(runs, ["job"], "duration_s", q, "_p").select("job", F.round("_p", digits).alias("p95_duration_s"))
    last = latest_terminal(runs).select("job", F.col("status").alias("last_status"))
    return agg.join(p95, "job", "left").join(last, "job", "left")


def replay_entity(events: DataFrame, entity: str = "id", order=("seq", "event_at"), state: str = "state",
                  actor: str = "trigger") -> DataFrame:
    """Change list of an append-only entity log: (entity, at, actor, before, after)."""
    w = Window.partitionBy(entity).orderBy(*order)
    return events.select(entity, *order, actor, F.lag(state).over(w).alias("before"), F.col(state).alias("after"))


def change_list(events: DataFrame, columns: list[str], entity: str = "id", order=("seq", "event_at"), actor: str = "trigger") -> DataFrame:
    """G11, field by field: for every event of an append-only entity log a map ``changes`` from the name
    of each column that differs from the event before (nulls are equal) to its ``before`` and ``after``,
    as text. The first event changes every column that it sets; an event that changes nothing has an
    empty map. The window holds one entity's events."""
    w = Window.partitionBy(entity).orderBy(*order)
    now = F.struct(*[F.col(c).cast("string").alias(c) for c in columns])
    x = events.withColumn("_now", now).withColumn("_last", F.lag("_now").over(w))
    pairs = F.array(*[F.struct(F.lit(c).alias("key"), F.struct(F.col(f"_last.{c}").alias("before"), F.col(f"_now.{c}").alias("after")).alias("value")) for c in columns])
    changes = F.map_from_entries(F.filter(pairs, lambda e: ~e["value"]["before"].eqNullSafe(e["value"]["after"])))
    return x.select(entity, *order, actor, changes.alias("changes"))


def change_rows(changes: DataFrame) -> DataFrame:
    """One row for each changed field: the columns of ``change_list`` with ``field, before, after``."""
    keep = [c for c in changes.columns if c != "changes"]
    return changes.select(*keep, F.explode("changes").alias("field", "_c")).select(*keep, "field", "_c.before", "_c.after")


def current_state(events: DataFrame, entity: str = "id", order=("seq", "event_at"), state: str = "state") -> DataFrame:
    """Current state per entity (last event wins)."""
    return events.groupBy(entity).agg(F.max_by(state, F.struct(*order)).alias(state))
