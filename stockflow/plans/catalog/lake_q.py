"""Catalogue: the movement table sink (A5-A10, D5 on the table).

Each query loads the fixture journal into a fresh table folder under the session's checkpoint
directory (shared storage on a cluster), runs the operation, and returns the table read back.
"""

from __future__ import annotations

import os
import uuid
from datetime import date

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stockflow.plans import lake
from stockflow.plans.catalog import query
from stockflow.plans.oracle_sql import with_ctes
from stockflow.session import apply_session_conf, ensure_checkpoint_dir, materialize, scratch
from stockflow.sources import fixtures as fx
from stockflow.sources.movements import COMPANIES, finalize, read_movements

def _root(spark, tag):
    return os.path.join(ensure_checkpoint_dir(spark), f"lake-{tag}-{uuid.uuid4().hex}")


def _span(src):
    """First capture day and the day after the last one: a window that holds the whole journal."""
    lo, hi = src.agg(F.min("create_date"), F.max("create_date")).first()
    return lo, lake.day_after(hi)


def _source(spark, sf_dir):
    """The extract written down once, for flows that pull window after window from it: a pull then reads
    the rows of its window instead of putting the whole extract together again."""
    return materialize(fx.movement_source(spark, sf_dir), "extract")


def _loaded(spark, sf_dir, tag, companies=COMPANIES):
    apply_session_conf(spark)
    src = fx.movement_source(spark, sf_dir)
    root = _root(spark, tag)
    since, until = _span(src)
    # A3: all companies in one job, not a loop
    lake.replace_window(spark, root, finalize(read_movements(src, list(companies), since, until)), list(companies), since, until)
    return src, root


@query("a5_ensure_table", with_ctes("SELECT * FROM mov_nopen", "mov_nopen"))
def a5(spark, sf_dir):
    apply_session_conf(spark)
    root = _root(spark, "a5")
    lake.ensure_table(spark, root)
    lake.ensure_table(spark, root)  # idempotent
    empty = lake.read_table(spark, root)
    assert empty.count() == 0
    src = fx.movement_source(spark, sf_dir)
    since, until = _span(src)
    lake.replace_window(spark, root, finalize(read_movements(src, list(COMPANIES), since, until)), COMPANIES, since, until)
    return lake.read_table(spark, root)


@query("a6_replace_window", with_ctes("""
SELECT mov_id, company, item_code, warehouse, doc_date, doc_time, doc_ts, create_date, trans_type, base_entry,
       base_num, doc_line,
       CASE WHEN company = 'HR' AND create_date >= DATE '1996-01-01' AND create_date < DATE '1997-01-01'
            THEN in_qty * 2 ELSE in_qty END AS in_qty, out_qty, trans_value, retail_year
FROM mov_nopen""", "mov_nopen"))
def a6(spark, sf_dir):
    src, root = _loaded(spark, sf_dir, "a6")
    since, until = date(1996, 1, 1), date(1997, 1, 1)
    incoming = finalize(read_movements(src, "HR", since, until)).withColumn("in_qty", F.col("in_qty") * 2)
    lake.replace_window(spark, root, incoming, "HR", since, until)
    lake.replace_window(spark, root, incoming, "HR", since, until)  # idempotent
    assert lake.replace_window(spark, root, incoming.limit(0), "HR", since, until) == 0  # empty: no-op
    return lake.read_table(spark, root)


@query("a7_sync", with_ctes("SELECT * FROM mov_nopen", "mov_nopen"))
def a7(spark, sf_dir):
    apply_session_conf(spark)
    root = _root(spark, "a7")
    with scratch(spark):
        src = _source(spark, sf_dir)
        since, until = _span(src)
        for company in COMPANIES:  # each has its own watermark
            lake.sync(spark, root, src, company, until=since + (until - since) // 2, since=since)
            lake.sync(spark, root, src, company, until=until)  # resumes at the watermark
    return lake.read_table(spark, root)


@query("a8_backfill", with_ctes("SELECT * FROM mov_nopen", "mov_nopen"))
def a8(spark, sf_dir):
    apply_session_conf(spark)
    root = _root(spark, "a8")
    with scratch(spark):
        src = _source(spark, sf_dir)
        report = lake.backfill(spark, root, src, COMPANIES, *_span(src))
    assert len(report) >= 2
    return lake.read_table(spark, root)


@query("a9_read_partitioned", with_ctes("SELECT * FROM mov_nopen WHERE retail_year IN (1996, 1997)", "mov_nopen"))
def a9(spark, sf_dir):
    _, root = _loaded(spark, sf_dir, "a9")
    return lake.read_partitioned(spark, root, [1996, 1997])


@query("a10_compact", with_ctes("SELECT * FROM mov_nopen", "mov_nopen"))
def a10(spark, sf_dir):
    src, root = _loaded(spark, sf_dir, "a10")
    lake.compact(spark, root, "COMERCIAL", *_span(src))
    return lake.read_table(spark, root)


@query("a10_compact_file_counts", with_ctes("""SELECT 'HR' AS company, count(*) AS leaves, CAST(sum(CASE WHEN n > 1 THEN 2 ELSE 1 END) AS BIGINT) AS files_before,
  count(*) AS files_after, CAST(sum(CASE WHEN n > 1 THEN 2 ELSE 0 END) AS BIGINT) AS rewritten, 0 AS rewritten_again, CAST(sum(n) AS BIGINT) AS n
FROM (SELECT count(*) AS n FROM mov_nopen WHERE company = 'HR' GROUP BY strftime(create_date, '%Y-%m')) m""", "mov_nopen"))
def a10_counts(spark, sf_dir):
    """Two loads leave two files in every month; merging them leaves one, and a second call none to do."""
    apply_session_conf(spark)
    src = fx.movement_source(spark, sf_dir)
    root, span = _root(spark, "a10c"), _span(src)
    rows = finalize(read_movements(src, "HR", *span)).withColumn("load_month", lake.load_month())
    order = F.row_number().over(Window.partitionBy("load_month").orderBy("create_date", "mov_id", "doc_line", "in_qty", "out_qty"))
    rows = materialize(rows.withColumn("half", F.pmod(order, F.lit(2))), "halves")
    for k in (0, 1):
        lake._write_leaves(rows.filter(F.col("half") == k).drop("half"), root, "append")
    done = lake.compact(spark, root, "HR", *span)
    again = lake.compact(spark, root, "HR", *span)
    leaves = len(lake._list_dirs(spark, f"{root}/company=HR"))
    return lake.read_table(spark, root).agg(F.count("*").alias("n")).select(
        F.lit("HR").alias("company"), F.lit(leaves).cast("bigint").alias("leaves"), *[F.lit(v).cast("bigint").alias(k) for k, v in done.items()],
        F.lit(again["rewritten"]).alias("rewritten_again"), "n")


@query("d5_between_doc_dates_table", with_ctes(
    "SELECT mov_id, doc_date, retail_year FROM mov_nopen WHERE doc_date BETWEEN DATE '1996-03-01' AND DATE '1997-02-15'",
    "mov_nopen"))
def d5t(spark, sf_dir):
    _, root = _loaded(spark, sf_dir, "d5")
    return lake.between_doc_dates(spark, root, date(1996, 3, 1), date(1997, 2, 15)).select(
        "mov_id", "doc_date", "retail_year")
