"""Map the driver's TPC-H-style tables onto the movement, stock, log and run schemas.

The rules are fixed test semantics (see FIXTURES.md): they make every operator run on the given
tables, so work grows with the scale factor. Everything is a lazy DataFrame plan; dimension
tables with a fixed size (nation: 25 rows) are broadcast, the big joins are left to the planner
and AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.functions.log_fields import duration_ms, job_level, log_level
from stockflow.functions.movement_fields import item_code
from stockflow.operators.sequence import running_sum
from stockflow.sources.movements import finalize
from stockflow.sources.tables import read_table

# --- fixed values of the fixture mapping ------------------------------------------------------
COMPANY_BY_PARTKEY_MOD3 = ("COMERCIAL", "HR", "CAP")
OPENING_QTY = 60.0
OPENING_DATE = "1994-12-31"
OPENING_ENTRY_BASE = 900000000
BASE_NUM_OFFSET = 100000
EXTRA_ITEM, EXTRA_WAREHOUSE, EXTRA_QTY = "9999999", "A00", 5.0
PLANT_WRONG_MOD, PLANT_WRONG_DELTA = 97, 1.0
PLANT_TOL_MOD, PLANT_TOL_DELTA = 89, 0.0005
PLANT_DROP_MOD = 101
JOB_BY_EVENT = {"signup": "sync-movements", "purchase": "backfill-movements"}
API_BY_EVENT = {"click": ("GET", "/v1/logs"), "error": ("POST", "/v1/jobs")}
TRIGGER_BY_K_MOD4 = ("api", "scheduled", "cli", "manual")
HOST = "host-1"
# planted faults, by the remainder of the document or run number
TRANSFER_SHORT_MOD = 97                       # a transfer's in-leg lacks one unit
NO_QUEUED_MOD, TWICE_MOD, EARLY_FINISH_MOD, NEVER_ENDS_MOD = 53, 59, 61, 67
LOST_LOG_MOD = 83                             # a run whose log record is lost
NEW_ITEM_MOD, NEW_ITEM_PERIODS = 41, 10       # an item with a history of a few periods only
# -----------------------------------------------------------------------------------------------


def _company(partkey) -> "F.Column":
    m = F.pmod(partkey, F.lit(3))
    return (F.when(m == 0, COMPANY_BY_PARTKEY_MOD3[0]).when(m == 1, COMPANY_BY_PARTKEY_MOD3[1])
            .otherwise(COMPANY_BY_PARTKEY_MOD3[2]))


def _trans_type(linenumber, rflag, lstatus) -> "F.Column":
    return (F.when(linenumber == 7, 69)
            .when((rflag == "R") & (lstatus == "O"), 20)
            .when(rflag == "R", 16)
            .when(rflag == "A", 15)
            .when((rflag == "N") & (lstatus == "O"), 13)
            .when((rflag == "N") & (lstatus == "F"), 67)).cast("bigint")


def movement_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source extract (company + 12 source columns) for all companies, without opening rows."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
                    "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag",
                    "l_linestatus", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    # the lines' join with the orders shuffles both, so the lines have their type, region and day before
    lines = _with_region(_typed(li), spark, sf_dir).select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", F.col("l_shipdate").cast("date").alias("l_shipdate"),
        "trans_type", "n_regionkey")
    j = _with_legs(lines.join(orders, lines.l_orderkey == orders.o_orderkey))
    tt, leg, q, px = F.col("trans_type"), F.col("leg"), F.col("l_quantity"), F.col("l_extendedprice")
    in_qty = (F.when(tt == 20, q * 3).when((tt == 16) | ((tt == 67) & (leg == 1)), q)
              .otherwise(F.lit(0.0)))
    out_qty = F.when(tt.isin(13, 15) | ((tt == 67) & (leg == 0)), q).otherwise(F.lit(0.0))
    value = F.when(tt.isin(20, 16, 69) | ((tt == 67) & (leg == 1)), px).otherwise(-px)
    ln = F.col("l_linenumber")
    doc_time = F.when(ln != 1, F.pmod(F.col("l_orderkey"), F.lit(24)) * 100 + F.pmod(ln * 7, F.lit(60)))
    return j.select(
        _company(F.col("l_partkey")).alias("company"),
        item_code("l_partkey").alias("item_code"),
        _warehouse(_warehouse_number()).alias("warehouse"),
        F.col("l_shipdate").alias("doc_date"),
        doc_time.cast("smallint").alias("doc_time"),
        F.col("o_orderdate").alias("create_date"),
        tt.alias("trans_type"),
        F.col("l_orderkey").alias("base_entry"),
        (F.col("l_orderkey") + BASE_NUM_OFFSET).alias("base_num"),
        ln.cast("bigint").alias("doc_line"),
        in_qty.alias("in_qty"),
        out_qty.alias("out_qty"),
        value.alias("trans_value"),
    )


def _with_region(lines: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with the region of their supplier. The suppliers are joined as they stand: for a join of suppliers
    and nations the planner expects the product of their sizes and would shuffle every line."""
    supplier = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")
    # nation has 25 rows by definition: a fixed-size broadcast.
    return (lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey")))


def _typed(lines: DataFrame) -> DataFrame:
    return lines.withColumn("trans_type", _trans_type(F.col("l_linenumber"), F.col("l_returnflag"), F.col("l_linestatus")))


def _with_legs(typed: DataFrame) -> DataFrame:
    """The legs of a document: transfers (67) post out of one warehouse and into the next one."""
    return typed.withColumn("leg", F.explode(F.when(F.col("trans_type") == 67, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))


def _warehouse_number():
    return F.pmod(F.col("n_regionkey") + F.col("leg"), F.lit(5))


def _warehouse(number):
    return F.concat(F.lit("A0"), number.cast("string"))


def stock_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (company, item, warehouse) of the journal. Each line has an order, so orders are not read.

    A part has one company and one item code, so keys are told apart by part and warehouse numbers."""
    li = read_table(spark, sf_dir, "lineitem", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus")
    few = _with_legs(_with_region(_typed(li), spark, sf_dir)).select("l_partkey", _warehouse_number().alias("number")).distinct()
    return few.select(_company(F.col("l_partkey")).alias("company"), item_code("l_partkey").alias("item_code"),
                      _warehouse(F.col("number")).alias("warehouse"))


def opening_rows(keys: DataFrame, qty: float = OPENING_QTY) -> DataFrame:
    """One type-59 opening receipt per (company, item, warehouse)."""
    entry = F.col("item_code").cast("bigint") + OPENING_ENTRY_BASE
    return keys.select(
        "company", "item_code", "warehouse",
        F.lit(OPENING_DATE).cast("date").alias("doc_date"),
        F.lit(None).cast("smallint").alias("doc_time"),
        F.lit(OPENING_DATE).cast("date").alias("create_date"),
        F.lit(59).cast("bigint").alias("trans_type"),
        entry.alias("base_entry"),
        entry.alias("base_num"),
        F.lit(0).cast("bigint").alias("doc_line"),
        F.lit(float(qty)).alias("in_qty"),
        F.lit(0.0).alias("out_qty"),
        F.lit(0.0).alias("trans_value"),
    )


def movements(spark: SparkSession, sf_dir: str, opening_qty: float | None = OPENING_QTY) -> DataFrame:
    """Finalised movement journal (16 pinned columns) for all companies."""
    src = movement_source(spark, sf_dir)
    if opening_qty is not None:
        src = src.unionByName(opening_rows(stock_keys(spark, sf_dir), opening_qty))
    return finalize(src)


def with_transfer_faults(mov: DataFrame) -> DataFrame:
    """The journal with in-legs of some transfers short by one unit."""
    short = (F.col("trans_type") == 67) & (F.col("in_qty") > 0) & (F.pmod("base_entry", F.lit(TRANSFER_SHORT_MOD)) == 0)
    return mov.withColumn("in_qty", F.when(short, F.col("in_qty") - 1).otherwise(F.col("in_qty")))


def with_new_items(series: DataFrame) -> DataFrame:
    """A demand series in which some items only began a few periods ago."""
    new = F.pmod(F.col("item_code").cast("bigint"), F.lit(NEW_ITEM_MOD)) == 0
    return series.filter(~new | (F.col("p") > series.agg(F.max("p")).scalar() - NEW_ITEM_PERIODS))


def without_lost_logs(logs: DataFrame) -> DataFrame:
    """Job logs of which some records are lost."""
    return logs.filter(F.pmod("event_id", F.lit(LOST_LOG_MOD)) != 0)


def stock_snapshot(spark: SparkSession, sf_dir: str, mov: DataFrame | None = None) -> DataFrame:
    """Stock snapshot (company, item_code, warehouse, qty_sap) with planted errors."""
    mov = mov if mov is not None else movements(spark, sf_dir)
    on_hand = mov.groupBy("company", "item_code", "warehouse").agg(
        F.sum(F.col("in_qty") - F.col("out_qty")).alias("qty"))
    pk = F.col("item_code").cast("bigint")
    qty = (F.col("qty")
           + F.when(F.pmod(pk, F.lit(PLANT_WRONG_MOD)) == 0, PLANT_WRONG_DELTA).otherwise(0.0)
           + F.when(F.pmod(pk, F.lit(PLANT_TOL_MOD)) == 0, PLANT_TOL_DELTA).otherwise(0.0))
    kept = on_hand.filter(F.pmod(pk, F.lit(PLANT_DROP_MOD)) != 0).select(
        "company", "item_code", "warehouse", qty.alias("qty_sap"))
    extra = on_hand.select("company").distinct().select(
        "company", F.lit(EXTRA_ITEM).alias("item_code"), F.lit(EXTRA_WAREHOUSE).alias("warehouse"),
        F.lit(EXTRA_QTY).alias("qty_sap"))
    return kept.unionByName(extra)


# --- logs and runs from `events` ----------------------------------------------------------------

def _events(spark: SparkSession, sf_dir: str, kinds) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    return ev.filter(F.col("event_type").isin(*kinds)).withColumn(
        "k", F.get_json_object("props", "$.k").cast("bigint"))


def _correlation_id() -> "F.Column":
    return F.md5(F.concat(F.col("user_id").cast("string"), F.lit("|"),
                          F.col("ts").cast("date").cast("string")))


def _minus_minutes(ts, minutes) -> "F.Column":
    micros = F.round(minutes * 60000000.0).cast("bigint")
    return F.timestamp_add("MICROSECOND", -micros, ts)


def job_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir, list(JOB_BY_EVENT))
    job = F.when(F.col("event_type") == "signup", JOB_BY_EVENT["signup"]).otherwise(JOB_BY_EVENT["purchase"])
    status = F.when(F.col("value") > 100, "failed").otherwise("ok")
    started = _minus_minutes(F.col("ts"), F.col("value"))
    df = ev.select(
        "event_id", F.col("ts").alias("ts"), status.alias("status"), _correlation_id().alias("correlation_id"),
        started.alias("started_at"), F.col("ts").alias("finished_at"), job.alias("job"),
        F.col("k").alias("rows"))
    return df.select(
        "event_id", "ts", job_level("status").alias("level"), "correlation_id",
        F.lit("job").alias("source"), "status", "started_at", "finished_at",
        duration_ms("started_at", "finished_at").alias("duration_ms"),
        F.lit(None).cast("string").alias("detail"), "job", "rows")


def api_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir, list(API_BY_EVENT))
    code = F.when(F.col("value") > 150, 500).when(F.col("value") > 100, 404).otherwise(200).cast("int")
    dur = F.floor(F.col("value") * 10).cast("bigint")
    is_click = F.col("event_type") == "click"
    df = ev.select(
        "event_id", "ts", _correlation_id().alias("correlation_id"), code.alias("status_code"),
        dur.alias("duration_ms"),
        F.when(is_click, API_BY_EVENT["click"][0]).otherwise(API_BY_EVENT["error"][0]).alias("method"),
        F.when(is_click, API_BY_EVENT["click"][1]).otherwise(API_BY_EVENT["error"][1]).alias("path"))
    failed = F.col("status_code") >= 400
    return df.select(
        "event_id", "ts", log_level("status_code").alias("level"), "correlation_id",
        F.lit("api").alias("source"),
        F.when(failed, "failed").otherwise("ok").alias("status"),
        F.timestamp_add("MILLISECOND", -F.col("duration_ms"), F.col("ts")).alias("started_at"),
        F.col("ts").alias("finished_at"), "duration_ms",
        F.when(failed, F.concat(F.lit("HTTP "), F.col("status_code").cast("string"))).alias("detail"),
        "method", "path", "status_code")


def performance_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resource samples with a cumulative IO counter (running sum of ``value`` per host)."""
    ev = _events(spark, sf_dir, ["view"]).withColumn("host", F.lit(HOST))
    # One counter per host: a bucketed running sum instead of a single-partition window.
    ev = running_sum(ev, ["host"], ["ts", "event_id"], "value", "_counter")
    v = F.col("value")
    counter = F.col("_counter")
    return ev.select(
        "event_id", "ts", F.lit("info").alias("level"), _correlation_id().alias("correlation_id"),
        F.lit("performance").alias("source"), "host",
        F.least(v, F.lit(100.0)).alias("cpu_pct"), (v * 20).alias("rss_mb"),
        F.least(v / 5, F.lit(100.0)).alias("mem_pct"), F.least(v / 10, F.lit(100.0)).alias("disk_pct"),
        counter.alias("io_counter_mb"))


def run_events(spark: SparkSession, sf_dir: str, planted: bool = False) -> DataFrame:
    """Run lifecycle events: queued (started - 5 s), running (started), terminal (finished).

    ``planted`` breaks some lifecycles (G4, G7): no queued event, a second terminal event, a finish
    before the start, no terminal event at all."""
    jl = job_logs(spark, sf_dir).withColumn(
        "k", F.col("rows"))
    m4 = F.pmod(F.col("k"), F.lit(4))
    trig = (F.when(m4 == 0, TRIGGER_BY_K_MOD4[0]).when(m4 == 1, TRIGGER_BY_K_MOD4[1])
            .when(m4 == 2, TRIGGER_BY_K_MOD4[2]).otherwise(TRIGGER_BY_K_MOD4[3]))
    idem = F.when(F.pmod(F.col("k"), F.lit(2)) == 0, F.col("correlation_id"))
    base = jl.select(F.col("event_id").alias("id"), "job", trig.alias("trigger"),
                     "correlation_id", idem.alias("idempotency_key"), "started_at", "finished_at",
                     "status", "rows")
    every = lambda mod: F.lit(planted) & (F.pmod("id", F.lit(mod)) == 0)

    def event(keep, seq, state, at, rows):
        return F.when(keep, F.struct(F.lit(seq).alias("seq"), state.alias("state"), at.alias("event_at"), rows.alias("rows")))

    none = F.lit(None).cast("bigint")
    later = lambda s, c: F.timestamp_add("SECOND", F.lit(s), F.col(c))
    end = F.when(every(EARLY_FINISH_MOD), later(-1, "started_at")).otherwise(F.col("finished_at"))
    events = F.array(event(~every(NO_QUEUED_MOD), 0, F.lit("queued"), later(-5, "started_at"), none),
                     event(F.lit(True), 1, F.lit("running"), F.col("started_at"), none),
                     event(~every(NEVER_ENDS_MOD), 2, F.col("status"), end, F.col("rows")),
                     event(every(TWICE_MOD), 3, F.lit("failed"), later(1, "finished_at"), F.col("rows")))
    return (base.select("id", "job", "trigger", "correlation_id", "idempotency_key", F.explode(F.array_compact(events)).alias("e"))
            .select("id", "job", "trigger", "correlation_id", "idempotency_key", "e.*"))
