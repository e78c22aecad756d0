"""Structured Streaming flows.

All flows read files incrementally (``readStream`` with an explicit schema), keep their progress
in a checkpoint folder on shared storage, and can run continuously or as
``trigger(availableNow=True)`` catch-up jobs. Event-time columns in the data are zone-less
(TIMESTAMP_NTZ); watermarks need TIMESTAMP, so they are cast under the session's UTC zone.
"""

from __future__ import annotations

from contextlib import contextmanager
from datetime import timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.operators.sequence import TOP_LEVEL, dyadic_cells, dyadic_cover
from stockflow.plans import lake
from stockflow.sources.movements import finalize

STUCK_SECONDS = 3600
RUN_BUCKETS = 1024  # state values of I6; a checkpoint keeps to the number it was started with


def _run(writer, available_now: bool = True, timeout_s: int | None = None):
    """Start the flow. A catch-up run is waited for; beyond ``timeout_s`` it is stopped and fails,
    so a sink that is not complete is never read as if it were."""
    q = (writer.trigger(availableNow=True) if available_now else writer).start()
    if available_now:
        if timeout_s is None:
            q.awaitTermination()
        elif not q.awaitTermination(timeout_s):
            q.stop()
            raise TimeoutError(f"the stream was still running after {timeout_s} s")
        if q.exception():
            raise q.exception()
    return q


def _files(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None) -> DataFrame:
    """File stream; ``max_files`` bounds the intake of a trigger (None: all that have arrived)."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(path)


def stream_sync(spark: SparkSession, src_path: str, schema: T.StructType, table_root: str, checkpoint: str,
                max_files: int | None = None, available_now: bool = True):
    """New movement extract files -> finalize -> window merge per company and batch.

    Progress is by capture date: each batch is merged into ``[min(create_date), max(create_date)+1)``
    of every company it carries, so back-dated documents (old doc_date, new capture date) are
    loaded with the batch that captured them. A window may arrive in several files and batches: a
    row stands as often as in the file that holds it most often, however files fall into batches, so
    neither a batch replayed after a failure nor files whose windows overlap double it."""
    stream = _files(spark, src_path, schema, max_files).select("*", F.col("_metadata.file_path").alias("_file"))

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        mov = finalize(batch, carry=["_file"]).filter("company is not null")
        bounds = mov.groupBy("company").agg(F.min("create_date").alias("lo"), F.max("create_date").alias("hi")).collect()
        if bounds:  # one row per company in the batch (three at most)
            windows = {r["company"]: (r["lo"], r["hi"] + timedelta(days=1)) for r in bounds}
            lake.merge_windows(spark, table_root, mov, windows, delivery="_file", derive=finalize)

    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    return _run(w, available_now)


def stream_logs(spark: SparkSession, src_path: str, schema: T.StructType, out_path: str, checkpoint: str,
                max_files: int | None = None, available_now: bool = True):
    """Append log records with bounded intake per trigger (back-pressure without loss; the
    source's drop-when-full queue is replaced by ``maxFilesPerTrigger``), files partitioned by
    kind and day."""
    stream = _files(spark, src_path, schema, max_files)
    out = stream.withColumn("day", F.to_date("ts").cast("string"))
    w = (out.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint)
            .partitionBy("type", "day").outputMode("append"))
    return _run(w, available_now)


def perf_windows(samples: DataFrame, window: str = "1 hour", slide: str | None = None,
                 delay: str = "10 minutes") -> DataFrame:
    """I3 (plan): tumbling or sliding aggregates of resource samples with an event-time
    watermark; rows later than the watermark are dropped."""
    s = samples.withColumn("ets", F.col("ts").cast("timestamp")).withWatermark("ets", delay)
    win = F.window("ets", window, slide) if slide else F.window("ets", window)
    return s.groupBy(F.col("host"), win.alias("w")).agg(
        F.count(F.lit(1)).alias("samples"), F.avg("cpu_pct").alias("avg_cpu_pct"), F.max("rss_mb").alias("max_rss_mb"))


def stream_perf_windows(spark, src_path, schema, out_path, checkpoint, window="1 hour", delay="10 minutes",
                        max_files: int | None = None, available_now: bool = True, slide: str | None = None):
    """Windowed aggregates written in append mode (each window once, when final); with ``slide``
    the windows overlap."""
    stream = _files(spark, src_path, schema, max_files)
    agg = perf_windows(stream, window, slide, delay).select(
        "host", F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"), "samples", "avg_cpu_pct", "max_rss_mb")
    w = agg.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint).outputMode("append")
    return _run(w, available_now)


def _in_cells(jobs: DataFrame, perf: DataFrame, max_activity_s: int, delay: str) -> tuple[DataFrame, DataFrame]:
    """Both sides of I4 by dyadic hour cells: an activity carries the cells that cover it (at most 2 log2
    of its hours), a sample one cell of each level that an activity of ``max_activity_s`` can have; a
    sample in an activity shares exactly one cell with it. A longer activity fails the job: its matches
    could not be complete."""
    us = 3600 * 1_000_000
    hour = lambda c: F.floor(F.unix_micros(c) / us).cast("bigint")
    length = F.unix_micros("a_end") - F.unix_micros("a_start")
    top = min(TOP_LEVEL, (max_activity_s // 3600 + 2).bit_length() - 1)  # an activity of n hours touches n + 2 at most
    a = (jobs.select(F.col("event_id").alias("job_event"), F.col("started_at").cast("timestamp").alias("a_start"),
                     F.col("finished_at").cast("timestamp").alias("a_end"))
             .withColumn("a_start", F.when(length <= max_activity_s * 1_000_000, F.col("a_start")).otherwise(F.raise_error(
                 F.lit(f"an activity is longer than {max_activity_s} s")).cast("timestamp")))
             .withColumn("a_cell", F.explode(dyadic_cover(hour("a_start"), hour("a_end"), top)))
             .withWatermark("a_end", delay))
    p = (perf.select(F.col("event_id").alias("sample_event"), F.col("ts").cast("timestamp").alias("p_ts"), "rss_mb")
             .withColumn("p_cell", F.explode(dyadic_cells(hour("p_ts"), range(top + 1))))
             .withWatermark("p_ts", delay))
    return a, p


def activity_perf_join(jobs: DataFrame, perf: DataFrame, max_activity_s: int, delay: str = "1 day") -> DataFrame:
    """I4 (plan): D6 as a stream-stream interval join. Stream joins need an equality, which is that of
    the hour cells (see ``_in_cells``). Watermarks on both sides plus the bound
    ``finished_at <= ts + max_activity_s`` let Spark drop join state that can no longer match."""
    a, p = _in_cells(jobs, perf, max_activity_s, delay)
    cond = ((F.col("a_cell.level") == F.col("p_cell.level")) & (F.col("a_cell.cell") == F.col("p_cell.cell"))
            & (F.col("a_start") <= F.col("p_ts")) & (F.col("p_ts") <= F.col("a_end"))
            & (F.col("a_end") <= F.col("p_ts") + F.expr(f"INTERVAL {max_activity_s} SECONDS")))
    return a.join(p, cond, "inner").select("job_event", "sample_event", "rss_mb")


_JOBS = pa.schema([("event", pa.int64()), ("named", pa.bool_()), ("since", pa.int64()), ("until", pa.int64())])
_SAMPLES = pa.schema([("us", pa.int64()), ("rss", pa.float64()), ("known", pa.bool_())])


def _columns(data: bytes | None, schema: pa.Schema) -> dict[str, np.ndarray]:
    b = pa.ipc.open_stream(data).read_next_batch() if data else pa.RecordBatch.from_pylist([], schema)
    return {c: b.column(c).to_numpy(zero_copy_only=False) for c in schema.names}


def _bytes(x: dict[str, np.ndarray], schema: pa.Schema) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema) as stream:
        stream.write_batch(pa.RecordBatch.from_arrays([pa.array(x[f.name], f.type) for f in schema], schema=schema))
    return sink.getvalue().to_pybytes()


class CellSamples:
    """Activities and samples of an hour cell: how many samples an activity has and the highest, of the
    matches that a batch makes (new activities with all samples, old ones with the new samples).

    A pair is never written out: the samples are sorted, so those of an activity are a stretch of them,
    whose maximum is that of two stretches of a power of two. The cell is one state value; what no later
    row can match leaves it, and it goes as a whole once the watermark has passed all that can come."""

    def __init__(self, max_activity_s: int):
        self.longest_us = max_activity_s * 1_000_000

    def peaks(self, jobs: dict[str, np.ndarray], samples: dict[str, np.ndarray]) -> pd.DataFrame:
        order = np.argsort(samples["us"], kind="stable")
        us, known = samples["us"][order], samples["known"][order]
        low, high = np.searchsorted(us, jobs["since"], "left"), np.searchsorted(us, jobs["until"], "right")
        hit = np.flatnonzero(high > low)
        low, high = low[hit], high[hit]
        upto = np.append(0, np.cumsum(known))
        best, size = np.full(len(hit), -np.inf), np.frexp((high - low).astype(float))[1] - 1
        widest = np.where(known, samples["rss"][order], -np.inf)  # of 2 ** k samples from each one on
        for k in range(int(size.max()) + 1 if len(hit) else 0):
            if k:
                widest = np.maximum(widest[: -(1 << k - 1)], widest[1 << k - 1:])
            here = np.flatnonzero(size == k)
            best[here] = np.maximum(widest[low[here]], widest[high[here] - (1 << k)])
        return pd.DataFrame({"job_event": pd.arrays.IntegerArray(jobs["event"][hit], ~jobs["named"][hit]), "samples": high - low,
                             "max_rss_mb": pd.arrays.FloatingArray(best, upto[high] == upto[low])})

    def __call__(self, key, batches, state):
        if state.hasTimedOut:
            state.remove()
            return
        jobs, samples = ((_columns(x, s) for x, s in zip(state.get if state.exists else (None, None), (_JOBS, _SAMPLES))))
        rows = pd.concat(list(batches), ignore_index=True)
        job = rows["job"].to_numpy(bool)
        new_jobs = {f.name: rows[f.name].to_numpy()[job] for f in _JOBS}
        new_samples = {"us": rows["since"].to_numpy()[~job], "rss": rows["rss"].to_numpy()[~job], "known": rows["known"].to_numpy()[~job]}
        joined = lambda x, y: {c: np.concatenate([x[c], y[c]]).astype(y[c].dtype) for c in x}
        now = state.getCurrentWatermarkMs()
        every = joined(samples, new_samples)
        for out in (self.peaks(new_jobs, every), self.peaks(jobs, new_samples)):
            if len(out):
                yield out
        jobs = joined(jobs, new_jobs)
        stays, open_ = every["us"] + self.longest_us >= now * 1000, jobs["until"] >= now * 1000
        state.update((_bytes({c: v[open_] for c, v in jobs.items()}, _JOBS), _bytes({c: v[stays] for c, v in every.items()}, _SAMPLES)))
        level, cell = key
        over = ((int(cell) + 1) << int(level)) * 3_600_000 + self.longest_us // 1000 + 3_600_000
        state.setTimeoutTimestamp(max(over, now + 1, 1))


def activity_perf_counts(jobs: DataFrame, perf: DataFrame, max_activity_s: int, delay: str = "1 day") -> DataFrame:
    """I4 (plan) without its pairs, which grow with the square of the event rate: ``samples`` and
    ``max_rss_mb`` (null samples do not count for it) of the matches that each batch makes in each cell.
    Summed up over an activity's rows they are those of ``activity_perf_join``."""
    a, p = _in_cells(jobs, perf, max_activity_s, delay)
    us, none = F.unix_micros, F.lit(0).cast("bigint")
    both = (a.select("a_cell.level", "a_cell.cell", F.col("a_end").alias("ets"), F.lit(True).alias("job"), F.coalesce("job_event", none).alias("event"),
                     F.col("job_event").isNotNull().alias("named"), us("a_start").alias("since"), us("a_end").alias("until"),
                     F.lit(0.0).alias("rss"), F.lit(False).alias("known"))
            .unionByName(p.select("p_cell.level", "p_cell.cell", F.col("p_ts").alias("ets"), F.lit(False).alias("job"), none.alias("event"),
                                  F.lit(False).alias("named"), us("p_ts").alias("since"), us("p_ts").alias("until"),
                                  F.coalesce("rss_mb", F.lit(0.0)).alias("rss"), F.col("rss_mb").isNotNull().alias("known"))))
    cells = CellSamples(max_activity_s)
    return both.groupBy("level", "cell").applyInPandasWithState(
        lambda key, batches, state: cells(key, batches, state), "job_event bigint, samples bigint, max_rss_mb double",
        "jobs binary, samples binary", "append", "EventTimeTimeout")


def stream_activity_perf(spark, jobs_path, jobs_schema, perf_path, perf_schema, out_path, checkpoint,
                         max_activity_s: int, max_files: int | None = None, available_now: bool = True, pairs: bool = True):
    """I4: run the interval join incrementally into a parquet sink; without ``pairs`` its counts and
    maxima (``activity_perf_counts``)."""
    plan = activity_perf_join if pairs else activity_perf_counts
    j = plan(_files(spark, jobs_path, jobs_schema, max_files), _files(spark, perf_path, perf_schema, max_files), max_activity_s)
    w = j.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint).outputMode("append")
    if pairs:
        return _run(w, available_now)
    with _rocksdb(spark):
        return _run(w, available_now)


def dedup_requests(requests: DataFrame, key: str = "idempotency_key", ts: str = "created_at",
                   delay: str = "1 hour") -> DataFrame:
    """I5 (plan): the first request per idempotency key within the watermark survives; rows
    with a null key never deduplicate."""
    r = requests.withColumn("ets", F.col(ts).cast("timestamp")).withWatermark("ets", delay)
    keyed = r.filter(F.col(key).isNotNull()).dropDuplicatesWithinWatermark([key])
    return keyed.unionByName(r.filter(F.col(key).isNull())).drop("ets")


def stream_dedup_requests(spark, src_path, schema, out_path, checkpoint, max_files: int | None = None,
                          available_now: bool = True, delay: str = "1 hour"):
    s = _files(spark, src_path, schema, max_files)
    w = (dedup_requests(s, delay=delay).writeStream.format("parquet").option("path", out_path)
            .option("checkpointLocation", checkpoint).outputMode("append"))
    return _run(w, available_now)


@contextmanager
def _rocksdb(spark: SparkSession):
    """Queries started inside keep their state in RocksDB; other queries keep the session's setting."""
    name, provider = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(name)
    spark.conf.set(name, provider)
    try:
        yield
    finally:
        spark.conf.set(name, before)


_RUN_ROW = "id bigint, job string, status string, created_us bigint, started_us bigint, finished_us bigint, rows bigint, was_stuck boolean"
_RUN_STATE = pa.schema([("id", pa.int64()), ("job", pa.string()), ("created", pa.int64()), ("started", pa.int64()), ("finished", pa.int64()),
                        ("seq", pa.int64()), ("status", pa.string()), ("rows", pa.int64()), ("alerted", pa.bool_()), ("done", pa.bool_())])
_RUN_EVENT = ["job", "seq", "state", "n", "has_n", "us"]
_NEVER = np.iinfo(np.int64).max  # a time that is not known (yet)


def _codes(*parts):
    """One code for each equal string of the parts, in the strings' order and -1 for null; the strings."""
    codes, names = pd.factorize(np.concatenate([np.asarray(x, object) for x in parts]), sort=True)
    return np.split(codes, np.cumsum([len(x) for x in parts])[:-1]), np.append(names, None).astype(object)


def _first_of(*order):
    """Rows that come first in each group of the last key, by the keys before it (from the last one on)."""
    rows = np.lexsort(order)
    group = order[-1][rows]
    return rows[np.append(True, group[1:] != group[:-1])] if len(rows) else rows


class RunLifecycles:
    """Lifecycles of the runs of a bucket: events are merged in any order, rows leave as event time passes.

    A verdict waits until the watermark has passed the time that it speaks of and is made from the
    events up to that time, all of which have been seen by then. So rows do not depend on how events
    fall into batches:

    - ``ok`` / ``failed`` once the watermark passes the run's first terminal event;
    - ``stuck`` once it passes ``created_at + stuck_s`` without a terminal event up to that time. A run
      that ends later still gets its final row, marked ``was_stuck``.

    The state of a run stays as a tombstone for ``keep_s`` of event time, so that events that come later
    still (repeats, a second end) give no further row; then it is dropped. So is a run that never ends.

    The runs of a bucket are one state value (an Arrow batch) and one timeout, at the next time that can
    change any of them, and each step is one numpy operation over all of them: neither a call to the
    state store nor a Python step is spent on a single run.
    """

    def __init__(self, stuck_s: int, keep_s: int):
        self.stuck_us, self.keep_us = stuck_s * 1_000_000, keep_s * 1_000_000

    def merge(self, old: pa.RecordBatch, events: pd.DataFrame) -> dict:
        """Columns of the bucket's runs, old and new, after the events; those of runs that are done change nothing."""
        had = {c: old.column(c).to_numpy(zero_copy_only=False) for c in old.schema.names if c != "rows"}
        ids, at = np.unique(np.concatenate([had["id"], events["id"].to_numpy()]), return_inverse=True)
        of_old, run = at[: old.num_rows], at[old.num_rows:]

        def spread(values, empty):
            x = np.full(len(ids), empty)
            x[of_old] = values
            return x

        x = {c: spread(had[c], _NEVER) for c in ("created", "started", "finished")}
        x |= {"id": ids, "alerted": spread(had["alerted"], False), "done": spread(had["done"], False)}
        live = ~x["done"][run]
        run, events = run[live], events[live]
        us = events["us"].to_numpy().astype(np.int64) if events["us"].notna().all() else events["us"].astype("int64")
        state = events["state"].to_numpy(object)
        for column, name in (("created", "queued"), ("started", "running")):
            here = state == name
            np.minimum.at(x[column], run[here], us[here])
        (job_old, job_new), jobs = _codes(had["job"], events["job"])
        job = spread(job_old, -1)
        np.maximum.at(job, run, job_new)

        ends = np.flatnonzero((state != "queued") & (state != "running"))
        seq = np.concatenate([had["seq"], events["seq"].to_numpy()[ends].astype(np.int64)])
        when = np.concatenate([had["finished"], us[ends]])
        (st_old, st_new), names = _codes(had["status"], state[ends])
        status = np.concatenate([st_old, st_new])
        rows = np.concatenate([old.column("rows").fill_null(0).to_numpy(), events["n"].to_numpy()[ends]])
        known = np.concatenate([old.column("rows").is_valid().to_numpy(zero_copy_only=False), events["has_n"].to_numpy(bool)[ends]])
        owner = np.concatenate([of_old, run[ends]])
        first = _first_of(seq, when, owner)  # stable: what is known already stands against an equal end

        def full(values, empty):
            x = np.full(len(ids), empty)
            x[owner[first]] = values[first]
            return x

        return x | {"job": jobs[job], "finished": full(when, _NEVER), "seq": full(seq, 0), "status": names[full(status, -1)],
                    "rows": full(rows, 0), "known": full(known, False)}

    def settle(self, x: dict, now_ms: int):
        """Verdicts due at the watermark, the runs that stay, and the time (ms) that the watermark has to pass next."""
        ms = lambda us: -(-us // 1000)
        created, started, finished = x["created"], x["started"], x["finished"]
        due = np.where(created != _NEVER, created, np.where(started != _NEVER, started, finished)) + self.stuck_us
        ended = finished != _NEVER
        stuck = ~x["alerted"] & ~x["done"] & (now_ms > ms(due)) & (finished > due)
        x["alerted"] = x["alerted"] | stuck
        final = ~x["done"] & ended & (now_ms > ms(finished))
        x["done"] = x["done"] | final
        null = lambda values, mask: pd.arrays.IntegerArray(values.astype(np.int64), mask)

        def verdicts(these, status, upto, end):
            at = {c: x[c][these] for c in ("created", "started", "finished")}
            upto, none = upto[these], np.ones(int(these.sum()), bool)
            begun = null(np.minimum(at["started"], upto), ~none) if end else null(at["started"], at["started"] > upto)
            return pd.DataFrame({
                "id": x["id"][these], "job": x["job"][these], "status": status[these], "created_us": null(at["created"], at["created"] > upto),
                "started_us": begun, "finished_us": null(at["finished"], none & (not end)),
                "rows": null(x["rows"][these], ~x["known"][these] if end else none), "was_stuck": x["alerted"][these]})

        out = pd.concat([verdicts(stuck, np.full(len(due), "stuck", object), due, False), verdicts(final, x["status"], finished, True)])
        over = np.maximum(due, np.where(ended, finished, 0)) + self.keep_us
        closed = x["done"] | (x["alerted"] & ~ended)
        stays = ~(closed & (now_ms > ms(over)))
        wake = np.where(closed, over, np.minimum(finished, np.where(x["alerted"], _NEVER, due)))[stays]
        return out, {c: v[stays] for c, v in x.items()}, max(int(ms(wake.min())), now_ms, 1) if len(wake) else None

    def __call__(self, key, batches, state):
        old = pa.ipc.open_stream(state.get[0]).read_next_batch() if state.exists else pa.RecordBatch.from_pylist([], _RUN_STATE)
        none = pd.DataFrame({"id": np.zeros(0, np.int64), "us": np.zeros(0, np.int64), "n": np.zeros(0, np.int64), "seq": np.zeros(0, np.int64)},
                            columns=["id", *_RUN_EVENT])
        events = none if state.hasTimedOut else pd.concat(list(batches), ignore_index=True)
        out, runs, wake = self.settle(self.merge(old, events), state.getCurrentWatermarkMs())
        if wake is None:
            state.remove()
        else:
            columns = [pa.array(runs[f.name], f.type, mask=~runs["known"] if f.name == "rows" else None) for f in _RUN_STATE]
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, _RUN_STATE) as stream:
                stream.write_batch(pa.RecordBatch.from_arrays(columns, schema=_RUN_STATE))
            state.update((sink.getvalue().to_pybytes(),))
            state.setTimeoutTimestamp(wake)
        if len(out):
            yield out.assign(id=pd.Series(pd.NA, out.index, "Int64")) if key[0] < 0 else out


def run_state(events: DataFrame, stuck_s: int = STUCK_SECONDS, delay: str = "10 minutes", keep_s: int = 86400) -> DataFrame:
    """I6 (plan): one final row for each run that ends, after at most one ``stuck`` row for a run
    without an end ``stuck_s`` seconds (event time) after its creation; see ``RunLifecycles``.

    A run whose queued event never comes counts from its first known event and has no ``created_at``.
    Events without an id count as one run; its bucket is its own, -1."""
    e = (events.withColumn("ets", F.col("event_at").cast("timestamp")).withWatermark("ets", delay)
         .withColumn("us", F.unix_micros("ets"))
         .withColumn("bucket", F.when(F.col("id").isNull(), -1).otherwise(F.pmod(F.xxhash64("id"), F.lit(RUN_BUCKETS)))))
    # without timestamps in the rows there is no time zone on the way through Python
    rows = e.select("bucket", F.coalesce("id", F.lit(0).cast("bigint")).alias("id"), "job", "seq", "state",
                    F.coalesce("rows", F.lit(0).cast("bigint")).alias("n"), F.col("rows").isNotNull().alias("has_n"), "us", "ets")
    lifecycles = RunLifecycles(stuck_s, keep_s)
    out = rows.groupBy("bucket").applyInPandasWithState(
        lambda key, batches, state: lifecycles(key, batches, state), _RUN_ROW, "runs binary", "append", "EventTimeTimeout")
    at = [F.timestamp_micros(f"{c}_us").alias(f"{c}_at") for c in ("created", "started", "finished")]
    return out.select("id", "job", "status", *at, "rows", "was_stuck")


def stream_run_state(spark, src_path, schema, out_path, checkpoint, max_files: int | None = None, available_now: bool = True,
                     stuck_s: int = STUCK_SECONDS, delay: str = "10 minutes", keep_s: int = 86400):
    """Run lifecycles into a parquet sink. State and timeouts are kept by RocksDB, which holds more
    keys than memory does."""
    s = _files(spark, src_path, schema, max_files)
    w = (run_state(s, stuck_s, delay, keep_s).writeStream.format("parquet").option("path", out_path)
            .option("checkpointLocation", checkpoint).outputMode("append"))
    with _rocksdb(spark):
        return _run(w, available_now)
