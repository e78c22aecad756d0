"""Catalogue: sources (A), enrichment (B), calendar (C), filters/joins (D), aggregates (E),
running stock and rankings (F) over the movement journal."""

from __future__ import annotations

from datetime import date, timedelta

from pyarrow import dataset
from pyspark.sql import functions as F

from stockflow.functions import calendar as cal
from stockflow.functions.movement_fields import doc_ts, mov_id, source_doc_ref, value_direction
from stockflow.operators import aggregates as ag
from stockflow.operators import calendar_ops as co
from stockflow.operators import enrich as en
from stockflow.operators import filters as fl
from stockflow.operators import inventory as inv
from stockflow.operators import reconcile as rc
from stockflow.plans.catalog import query
from stockflow.plans.oracle_sql import (sql_day_of_week, sql_period_name, sql_period_of_week,
                                        sql_quarter_of_week, sql_retail_week, sql_retail_year,
                                        sql_week_start_of, sql_year_start, with_ctes)
from stockflow.schemas import MOVEMENT_COLUMNS
from stockflow.session import apply_session_conf, materialize
from stockflow.sources import extract as ex
from stockflow.sources import fixtures as fx
from stockflow.sources import movements as mv
from stockflow.sources.tables import read_table

KEYS = "company, item_code, warehouse"


def _mov(spark, sf_dir, opening=True):
    apply_session_conf(spark)
    return fx.movements(spark, sf_dir, fx.OPENING_QTY if opening else None)


# ---------------------------------------------------------------- A: sources
A1_SINCE, A1_UNTIL = date(1996, 1, 1), date(1997, 1, 1)


@query("a1_read_movements", with_ctes(
    "SELECT * FROM src WHERE company = 'HR' AND create_date >= DATE '1996-01-01' AND create_date < DATE '1997-01-01'",
    "src"))
def a1(spark, sf_dir):
    apply_session_conf(spark)
    return mv.read_movements(fx.movement_source(spark, sf_dir), "HR", A1_SINCE, A1_UNTIL)


@query("a2_read_stock", with_ctes("SELECT * FROM stock WHERE company = 'CAP'", "stock"))
def a2(spark, sf_dir):
    mov = _mov(spark, sf_dir)
    return mv.read_stock(fx.stock_snapshot(spark, sf_dir, mov), "CAP")


@query("a3_union_companies", with_ctes("SELECT * FROM src", "src"))
def a3(spark, sf_dir):
    apply_session_conf(spark)
    src = fx.movement_source(spark, sf_dir)
    per = {c: src.filter(F.col("company") == c).drop("company") for c in mv.COMPANIES}
    return mv.union_companies(per)


@query("a1_partitioned_extract", with_ctes(
    "SELECT * FROM src WHERE company IN ('HR', 'CAP') AND create_date >= DATE '1996-01-10' AND create_date < DATE '1996-04-01'", "src"))
def a1_partitioned(spark, sf_dir):
    """The extract asked for month by month; the source stands in for the company databases."""
    apply_session_conf(spark)
    src = materialize(fx.movement_source(spark, sf_dir), "extract")
    path = src.inputFiles()[0].rpartition("/")[0].removeprefix("file:")

    def fetch(company, since, until):
        rows = dataset.dataset(path, format="parquet").to_table(filter=(dataset.field("company") == company) & (dataset.field("create_date") >= since)
                                                                & (dataset.field("create_date") < until))
        return rows.to_batches()

    df = ex.read_extract(spark, fetch, mv.COMPANIES, date(1990, 1, 1), date(2030, 1, 1), src.schema)
    return mv.read_movements(df, ["HR", "CAP"], date(1996, 1, 10), date(1996, 4, 1))


@query("a4_empty_movements", with_ctes("SELECT * FROM mov", "mov"))
def a4(spark, sf_dir):
    apply_session_conf(spark)
    # A company without data is the empty frame: a union with it leaves the journal as it is.
    return mv.empty_movements(spark).unionByName(_mov(spark, sf_dir))


@query("a4_empty_pull", f"""SELECT c.company, 0 AS rows_pulled, '{",".join(MOVEMENT_COLUMNS)}' AS columns, true AS types_pinned
FROM (VALUES ('COMERCIAL'), ('CAP'), ('HR')) c(company) WHERE EXISTS (SELECT 1 FROM lineitem)""")
def a4_pull(spark, sf_dir):
    """A window behind the data gives each company an empty frame with the columns and types of a full one."""
    apply_session_conf(spark)
    src = fx.movement_source(spark, sf_dir)
    last = src.agg(F.max("create_date")).first()[0]
    out = None
    for c in mv.COMPANIES:
        pull = mv.finalize(mv.read_movements(src, c, last + timedelta(days=1), last + timedelta(days=31)))
        same = [(f.name, f.dataType) for f in pull.schema] == [(f.name, f.dataType) for f in mv.empty_movements(spark).schema]
        row = mv.empty_movements(spark).unionByName(pull).agg(F.count("*").cast("int").alias("rows_pulled")).select(
            F.lit(c).alias("company"), "rows_pulled", F.lit(",".join(pull.columns)).alias("columns"), F.lit(same).alias("types_pinned"))
        out = row if out is None else out.unionByName(row)
    return out


# ---------------------------------------------------------------- B: enrichment
@query("b1_finalize", with_ctes("SELECT * FROM mov", "mov"))
def b1(spark, sf_dir):
    return _mov(spark, sf_dir)


@query("b2_doc_ts", with_ctes("SELECT mov_id, doc_date, doc_time, doc_ts FROM mov_nopen", "mov_nopen"))
def b2(spark, sf_dir):
    apply_session_conf(spark)
    src = fx.movement_source(spark, sf_dir)
    return src.select(mov_id().alias("mov_id"), "doc_date", "doc_time", doc_ts().alias("doc_ts"))


@query("b3_mov_id", with_ctes(
    "SELECT company, trans_type, base_entry, doc_line, item_code, warehouse, mov_id FROM mov_nopen", "mov_nopen"))
def b3(spark, sf_dir):
    apply_session_conf(spark)
    src = fx.movement_source(spark, sf_dir)
    return src.select("company", "trans_type", "base_entry", "doc_line", "item_code", "warehouse",
                      mov_id().alias("mov_id"))


@query("b4_retail_year", with_ctes(
    f"SELECT DISTINCT doc_date, {sql_retail_year('doc_date')} AS retail_year FROM src", "src"))
def b4(spark, sf_dir):
    apply_session_conf(spark)
    return fx.movement_source(spark, sf_dir).select("doc_date").distinct().select(
        "doc_date", cal.retail_year("doc_date").alias("retail_year"))


_DOC_SQL = ("CASE trans_type " + " ".join(f"WHEN {c} THEN '{d}'" for c, d, _ in en.TRANS_TYPES) + " END")
_DIR_SQL = ("CASE trans_type " + " ".join(f"WHEN {c} THEN '{d}'" for c, _, d in en.TRANS_TYPES) + " END")


@query("b5_classify_trans", with_ctes(
    f"SELECT trans_type, {_DOC_SQL} AS document, {_DIR_SQL} AS direction, count(*) AS n FROM mov GROUP BY ALL",
    "mov"))
def b5(spark, sf_dir):
    return en.classify_trans(_mov(spark, sf_dir)).groupBy("trans_type", "document", "direction").agg(
        F.count(F.lit(1)).alias("n"))


_VDIR = "CASE WHEN trans_value > 0 THEN 'in' WHEN trans_value < 0 THEN 'out' WHEN trans_value = 0 THEN 'none' END"


@query("b6_value_direction", with_ctes(
    f"SELECT mov_id, trans_value, {_VDIR} AS value_direction FROM mov", "mov"))
def b6(spark, sf_dir):
    return _mov(spark, sf_dir).select("mov_id", "trans_value", value_direction().alias("value_direction"))


@query("b7_source_doc_ref", with_ctes(
    "SELECT mov_id, CAST(trans_type AS VARCHAR) || ':' || CAST(base_entry AS VARCHAR) || ':' || "
    "CAST(doc_line AS VARCHAR) AS source_doc_ref FROM mov", "mov"))
def b7(spark, sf_dir):
    return _mov(spark, sf_dir).select("mov_id", source_doc_ref().alias("source_doc_ref"))


@query("b8_movement_quality", with_ctes("""
SELECT company, count(*) AS rows,
       count_if(in_qty < 0 OR out_qty < 0) AS negative_qty,
       count_if(trans_type IS NULL OR base_entry IS NULL OR base_num IS NULL OR doc_line IS NULL
                OR in_qty IS NULL OR out_qty IS NULL OR trans_value IS NULL) AS null_after_cast,
       count_if((in_qty > 0 AND out_qty = 0 AND trans_value < 0) OR (out_qty > 0 AND in_qty = 0 AND trans_value > 0))
         AS value_against_direction,
       count_if(doc_time IS NOT NULL AND (doc_time < 0 OR doc_time // 100 > 23 OR doc_time % 100 > 59)) AS invalid_hhmm
FROM mov GROUP BY company""", "mov"))
def b8(spark, sf_dir):
    return en.movement_quality(_mov(spark, sf_dir))


# ---------------------------------------------------------------- C: calendar
def _ship_dates(spark, sf_dir):
    return read_table(spark, sf_dir, "lineitem", "l_shipdate").select(
        F.col("l_shipdate").cast("date").alias("dt")).distinct()


_C1_COLS = (lambda d: f"""{d} AS dt, {sql_retail_year(d)} AS r_year, {sql_retail_week(d)} AS r_week,
  {sql_period_of_week(sql_retail_week(d))} AS r_period,
  {sql_period_name(sql_period_of_week(sql_retail_week(d)))} AS r_period_name,
  {sql_quarter_of_week(sql_retail_week(d))} AS r_quarter, {sql_day_of_week(d)} AS r_day_of_week,
  {sql_week_start_of(d)} AS r_week_start, CAST({sql_week_start_of(d)} + 6 AS DATE) AS r_week_end""")


@query("c1_retail_date", f"SELECT {_C1_COLS('dt')} FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS dt FROM lineitem) d")
def c1(spark, sf_dir):
    apply_session_conf(spark)
    return co.with_retail_date(_ship_dates(spark, sf_dir), "dt")


@query("c2_retail_week", f"SELECT DISTINCT CAST(o_orderdate AS DATE) AS dt, {sql_retail_week('CAST(o_orderdate AS DATE)')} AS week FROM orders")
def c2(spark, sf_dir):
    apply_session_conf(spark)
    o = read_table(spark, sf_dir, "orders", "o_orderdate").select(F.col("o_orderdate").cast("date").alias("dt")).distinct()
    return o.select("dt", cal.retail_week("dt").alias("week"))


@query("c3_period_of_week", f"""SELECT week, {sql_period_of_week('week')} AS period
FROM (SELECT DISTINCT {sql_retail_week('CAST(l_shipdate AS DATE)')} AS week FROM lineitem) w""")
def c3(spark, sf_dir):
    apply_session_conf(spark)
    w = _ship_dates(spark, sf_dir).select(cal.retail_week("dt").alias("week")).distinct()
    return w.select("week", cal.period_of_week("week").alias("period"))


@query("c4_period_name", f"""SELECT period, {sql_period_name('period')} AS period_name
FROM (SELECT DISTINCT {sql_period_of_week(sql_retail_week('CAST(l_shipdate AS DATE)'))} AS period FROM lineitem) p""")
def c4(spark, sf_dir):
    apply_session_conf(spark)
    p = _ship_dates(spark, sf_dir).select(cal.period_of_week(cal.retail_week("dt")).alias("period")).distinct()
    return p.select("period", cal.period_name("period").alias("period_name"))


@query("c5_quarter_of_week", f"""SELECT week, {sql_quarter_of_week('week')} AS quarter
FROM (SELECT DISTINCT {sql_retail_week('CAST(o_orderdate AS DATE)')} AS week FROM orders) w""")
def c5(spark, sf_dir):
    apply_session_conf(spark)
    o = read_table(spark, sf_dir, "orders", "o_orderdate")
    w = o.select(cal.retail_week(F.col("o_orderdate").cast("date")).alias("week")).distinct()
    return w.select("week", cal.quarter_of_week("week").alias("quarter"))


@query("c6_year_range", f"""SELECT y AS retail_year, {sql_year_start('y')} AS year_start,
  CAST({sql_year_start('y')} + 363 AS DATE) AS year_end
FROM (SELECT DISTINCT {sql_retail_year('CAST(l_shipdate AS DATE)')} AS y FROM lineitem) t""")
def c6(spark, sf_dir):
    apply_session_conf(spark)
    y = _ship_dates(spark, sf_dir).select(cal.retail_year("dt").alias("retail_year")).distinct()
    return y.select("retail_year", cal.year_start("retail_year").alias("year_start"),
                    cal.year_end("retail_year").alias("year_end"))


@query("c7_week_range", f"""SELECT y AS retail_year, w AS week,
  CAST({sql_year_start('y')} + (w - 1) * 7 AS DATE) AS week_start,
  CAST({sql_year_start('y')} + (w - 1) * 7 + 6 AS DATE) AS week_end
FROM (SELECT DISTINCT {sql_retail_year('CAST(l_shipdate AS DATE)')} AS y,
             {sql_retail_week('CAST(l_shipdate AS DATE)')} AS w FROM lineitem) t""")
def c7(spark, sf_dir):
    apply_session_conf(spark)
    d = _ship_dates(spark, sf_dir).select(cal.retail_year("dt").alias("retail_year"),
                                           cal.retail_week("dt").alias("week")).distinct()
    return d.select("retail_year", "week", cal.week_start("retail_year", "week").alias("week_start"),
                    cal.week_end("retail_year", "week").alias("week_end"))


_FIRSTW = "(((p - 1) // 3) * 13 + CASE (p - 1) % 3 WHEN 0 THEN 0 WHEN 1 THEN 4 ELSE 9 END + 1)"
_LASTW = f"({_FIRSTW} + CASE (p - 1) % 3 WHEN 1 THEN 4 ELSE 3 END)"


@query("c8_period_range", f"""SELECT y AS retail_year, p AS period, CAST({_FIRSTW} AS INTEGER) AS first_week,
  CAST({_LASTW} AS INTEGER) AS last_week,
  CAST({sql_year_start('y')} + ({_FIRSTW} - 1) * 7 AS DATE) AS period_start,
  CAST({sql_year_start('y')} + ({_LASTW} - 1) * 7 + 6 AS DATE) AS period_end
FROM (SELECT DISTINCT {sql_retail_year('CAST(l_shipdate AS DATE)')} AS y,
             {sql_period_of_week(sql_retail_week('CAST(l_shipdate AS DATE)'))} AS p FROM lineitem) t""")
def c8(spark, sf_dir):
    apply_session_conf(spark)
    d = _ship_dates(spark, sf_dir).select(cal.retail_year("dt").alias("retail_year"),
                                           cal.period_of_week(cal.retail_week("dt")).alias("period")).distinct()
    fw, lw = cal.period_first_week("period"), cal.period_last_week("period")
    return d.select("retail_year", "period", fw.alias("first_week"), lw.alias("last_week"),
                    cal.week_start("retail_year", fw).alias("period_start"),
                    cal.week_end("retail_year", lw).alias("period_end"))


@query("c9_quarter_range", f"""SELECT y AS retail_year, q AS quarter, CAST((q - 1) * 13 + 1 AS INTEGER) AS first_week,
  CAST(q * 13 AS INTEGER) AS last_week,
  CAST({sql_year_start('y')} + (q - 1) * 91 AS DATE) AS quarter_start,
  CAST({sql_year_start('y')} + q * 91 - 1 AS DATE) AS quarter_end
FROM (SELECT DISTINCT {sql_retail_year('CAST(l_shipdate AS DATE)')} AS y,
             {sql_quarter_of_week(sql_retail_week('CAST(l_shipdate AS DATE)'))} AS q FROM lineitem) t""")
def c9(spark, sf_dir):
    apply_session_conf(spark)
    d = _ship_dates(spark, sf_dir).select(cal.retail_year("dt").alias("retail_year"),
                                           cal.quarter_of_week(cal.retail_week("dt")).alias("quarter")).distinct()
    fw, lw = cal.quarter_first_week("quarter"), cal.quarter_last_week("quarter")
    return d.select("retail_year", "quarter", fw.alias("first_week"), lw.alias("last_week"),
                    cal.week_start("retail_year", fw).alias("quarter_start"),
                    cal.week_end("retail_year", lw).alias("quarter_end"))


_C10_COLS = _C1_COLS("dt").replace("r_", "").replace(" AS dt,", " AS date,").replace("AS year,", "AS year,")


@query("c10_calendar_dim", f"""SELECT {_C10_COLS} FROM (
  SELECT unnest(generate_series(min(CAST(l_shipdate AS DATE)), max(CAST(l_shipdate AS DATE)), INTERVAL 1 DAY))::DATE AS dt
  FROM lineitem) d""")
def c10(spark, sf_dir):
    apply_session_conf(spark)
    li = read_table(spark, sf_dir, "lineitem", "l_shipdate")
    return co.calendar_dim(co.date_bounds(li, "l_shipdate"))


@query("c11_retail_year_windows", with_ctes(f"""
SELECT company, CAST(y AS SMALLINT) AS retail_year, greatest(s, {sql_year_start('y')}) AS win_start,
       least(e, {sql_year_start('y + 1')}) AS win_end
FROM (SELECT company, s, e, unnest(generate_series({sql_retail_year('s')}, {sql_retail_year('e - 1')})) AS y
      FROM (SELECT company, min(create_date) AS s, CAST(max(create_date) + 1 AS DATE) AS e FROM src GROUP BY company) b
      WHERE s < e) x
WHERE greatest(s, {sql_year_start('y')}) < least(e, {sql_year_start('y + 1')})""", "src"))
def c11(spark, sf_dir):
    apply_session_conf(spark)
    b = fx.movement_source(spark, sf_dir).groupBy("company").agg(
        F.min("create_date").alias("start"), F.date_add(F.max("create_date"), 1).alias("end"))
    return co.retail_year_windows(b, by=("company",))


@query("c12_validate_calendar", f"""SELECT dt, {sql_retail_week('dt')} AS week,
  {sql_period_of_week(sql_retail_week('dt'))} AS period, {sql_quarter_of_week(sql_retail_week('dt'))} AS quarter
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS dt FROM orders) d""")
def c12(spark, sf_dir):
    apply_session_conf(spark)
    d = read_table(spark, sf_dir, "orders", "o_orderdate").select(F.col("o_orderdate").cast("date").alias("dt")).distinct()
    wk = cal.retail_week("dt")
    d = d.select("dt", wk.alias("week"), cal.period_of_week(wk).alias("period"), cal.quarter_of_week(wk).alias("quarter"))
    return co.validate_calendar(d)


_RC = lambda d: (f"{sql_retail_year(d)} AS r_year, {sql_retail_week(d)} AS r_week, "  # noqa: E731
                 f"{sql_period_of_week(sql_retail_week(d))} AS r_period, "
                 f"{sql_quarter_of_week(sql_retail_week(d))} AS r_quarter")


@query("c13_retail_rollup", with_ctes(f"""
SELECT company, r_year, r_period, count(*) AS n, sum(in_qty) AS in_qty, sum(out_qty) AS out_qty,
       round(sum(trans_value), 2) AS value
FROM (SELECT *, {_RC('doc_date')} FROM mov) m GROUP BY company, r_year, r_period""", "mov"))
def c13(spark, sf_dir):
    return ag.retail_rollup(_mov(spark, sf_dir), "period")


# ---------------------------------------------------------------- D: filters and joins
@query("d1_window_filter", with_ctes(
    "SELECT mov_id, company, create_date FROM mov WHERE create_date >= DATE '1996-01-01' AND create_date < DATE '1997-01-01'",
    "mov"))
def d1(spark, sf_dir):
    return fl.window_filter(_mov(spark, sf_dir), "create_date", A1_SINCE, A1_UNTIL).select(
        "mov_id", "company", "create_date")


@query("d5_between_doc_dates", with_ctes(
    "SELECT mov_id, doc_date, retail_year FROM mov WHERE doc_date BETWEEN DATE '1996-03-01' AND DATE '1997-02-15'",
    "mov"))
def d5(spark, sf_dir):
    return fl.between_doc_dates(_mov(spark, sf_dir), date(1996, 3, 1), date(1997, 2, 15)).select(
        "mov_id", "doc_date", "retail_year")


@query("d9_missing_in", with_ctes("""
SELECT company, item_code, warehouse, 'lake_only' AS side FROM
  (SELECT DISTINCT company, item_code, warehouse FROM mov) r
  WHERE NOT EXISTS (SELECT 1 FROM stock s WHERE s.company = r.company AND s.item_code = r.item_code AND s.warehouse = r.warehouse)
UNION ALL
SELECT company, item_code, warehouse, 'snapshot_only' FROM (SELECT DISTINCT company, item_code, warehouse FROM stock) s
  WHERE NOT EXISTS (SELECT 1 FROM mov r WHERE s.company = r.company AND s.item_code = r.item_code AND s.warehouse = r.warehouse)
""", "mov", "stock"))
def d9(spark, sf_dir):
    mov = rc.rolled_up(_mov(spark, sf_dir))
    return rc.missing_in(mov, fx.stock_snapshot(spark, sf_dir, mov))


@query("d10_scoped_view", with_ctes("""
SELECT mov_id, warehouse FROM mov WHERE warehouse IN
  (SELECT 'A0' || CAST(r_regionkey AS VARCHAR) FROM region WHERE r_name = 'ASIA')""", "mov"))
def d10(spark, sf_dir):
    mov = _mov(spark, sf_dir)
    grants = read_table(spark, sf_dir, "region", "r_regionkey", "r_name").select(
        F.col("r_name").alias("user"), F.concat(F.lit("A0"), F.col("r_regionkey").cast("string")).alias("scope"))
    return fl.scoped_view(mov, grants, "ASIA", "warehouse").select("mov_id", "warehouse")


@query("d11_inventory_asof", with_ctes(f"""
SELECT p.company, p.item_code, p.warehouse, p.probe_date, sum(m.in_qty - m.out_qty) AS on_hand
FROM (SELECT DISTINCT company, item_code, warehouse, {sql_year_start('retail_year')} AS probe_date FROM mov) p
JOIN mov m ON m.company = p.company AND m.item_code = p.item_code AND m.warehouse = p.warehouse
          AND m.doc_date <= p.probe_date
GROUP BY ALL
UNION ALL
SELECT DISTINCT company, item_code, warehouse, {sql_year_start('retail_year')}, 0.0e0 FROM mov p
WHERE NOT EXISTS (SELECT 1 FROM mov m WHERE m.company = p.company AND m.item_code = p.item_code
                  AND m.warehouse = p.warehouse AND m.doc_date <= {sql_year_start('p.retail_year')})""", "mov"))
def d11(spark, sf_dir):
    mov = _mov(spark, sf_dir)
    probes = mov.select("company", "item_code", "warehouse",
                        cal.year_start("retail_year").alias("probe_date")).distinct()
    return inv.inventory_asof(mov, probes).withColumn("on_hand", F.coalesce("on_hand", F.lit(0.0)))


@query("d12_transfer_pairs", with_ctes("""
SELECT COALESCE(o.company, i.company) AS company, COALESCE(o.item_code, i.item_code) AS item_code,
       COALESCE(o.base_entry, i.base_entry) AS base_entry, COALESCE(o.doc_line, i.doc_line) AS doc_line,
       o.warehouse AS from_wh, i.warehouse AS to_wh, o.out_qty AS qty_out, i.in_qty AS qty_in,
       CASE WHEN o.out_qty IS NULL OR i.in_qty IS NULL THEN 'unmatched'
            WHEN o.out_qty <> i.in_qty THEN 'qty_mismatch' ELSE 'matched' END AS pair_status
FROM (SELECT * FROM mov WHERE trans_type = 67 AND out_qty > 0) o
FULL OUTER JOIN (SELECT * FROM (SELECT * REPLACE (CASE WHEN trans_type = 67 AND in_qty > 0 AND base_entry % 97 = 0 THEN in_qty - 1 ELSE in_qty END AS in_qty)
                 FROM mov) m WHERE trans_type = 67 AND in_qty > 0) i
  ON o.company = i.company AND o.item_code = i.item_code AND o.base_entry = i.base_entry AND o.doc_line = i.doc_line""",
    "mov"))
def d12(spark, sf_dir):
    return rc.transfer_pairs(fx.with_transfer_faults(_mov(spark, sf_dir)))


# ---------------------------------------------------------------- E: aggregates
@query("e1_on_hand", with_ctes(f"SELECT {KEYS}, sum(in_qty - out_qty) AS qty_recon FROM mov GROUP BY ALL", "mov"))
def e1(spark, sf_dir):
    return rc.on_hand(_mov(spark, sf_dir))


@query("e2_watermark", with_ctes("SELECT company, max(create_date) AS watermark FROM mov_nopen GROUP BY company",
                                 "mov_nopen"))
def e2(spark, sf_dir):
    return ag.watermark(_mov(spark, sf_dir, opening=False))


@query("e3_daily_net", with_ctes(f"""SELECT {KEYS}, doc_date, sum(in_qty) AS in_qty, sum(out_qty) AS out_qty,
  sum(in_qty - out_qty) AS net_qty FROM mov GROUP BY ALL""", "mov"))
def e3(spark, sf_dir):
    return ag.daily_net(_mov(spark, sf_dir))


@query("e4_inventory_value", with_ctes(f"""SELECT {KEYS}, round(sum(trans_value), 2) AS stock_value
FROM mov WHERE doc_date <= DATE '1998-01-01' GROUP BY ALL""", "mov"))
def e4(spark, sf_dir):
    return ag.inventory_value(_mov(spark, sf_dir), "1998-01-01")


@query("e5_movement_mix", with_ctes(f"""SELECT trans_type, {_VDIR} AS value_direction, count(*) AS n,
  sum(in_qty) AS in_qty, sum(out_qty) AS out_qty, round(sum(trans_value), 2) AS value,
  {_DOC_SQL} AS document, {_DIR_SQL} AS direction FROM mov GROUP BY ALL""", "mov"))
def e5(spark, sf_dir):
    return ag.movement_mix(_mov(spark, sf_dir))


@query("e6_transfer_netting", with_ctes("""SELECT * FROM (
  SELECT company, base_entry, round(sum(in_qty - out_qty), 4) AS net_qty, round(sum(trans_value), 4) AS net_value,
         count(*) AS legs FROM (SELECT * REPLACE (CASE WHEN trans_type = 67 AND in_qty > 0 AND base_entry % 97 = 0 THEN in_qty - 1 ELSE in_qty END AS in_qty)
                                FROM mov) m WHERE trans_type = 67 GROUP BY ALL) t
WHERE abs(net_qty) > 1e-6 OR abs(net_value) > 1e-6""", "mov"))
def e6(spark, sf_dir):
    return ag.transfer_netting(fx.with_transfer_faults(_mov(spark, sf_dir)))


@query("e7_load_audit", with_ctes(f"""SELECT *, round(back_dated / rows, 6) AS back_dated_share FROM (
  SELECT company, {sql_retail_year('create_date')} AS load_year, count(*) AS rows,
         min(create_date) AS min_create_date, max(create_date) AS max_create_date,
         min(doc_date) AS min_doc_date, max(doc_date) AS max_doc_date,
         count_if(create_date > doc_date) AS back_dated FROM mov GROUP BY ALL) t""", "mov"))
def e7(spark, sf_dir):
    return ag.load_audit(_mov(spark, sf_dir))


@query("e8_mov_id_collisions", with_ctes("""SELECT company, trans_type, base_entry, doc_line, item_code, warehouse,
  count(*) AS n, min(mov_id) AS mov_id FROM mov GROUP BY ALL HAVING count(*) > 1""", "mov"))
def e8(spark, sf_dir):
    return ag.mov_id_collisions(_mov(spark, sf_dir))


@query("e9_distinct_counts", with_ctes(f"""SELECT {sql_retail_year('doc_date')} AS retail_year,
  {sql_period_of_week(sql_retail_week('doc_date'))} AS period, count(DISTINCT item_code) AS items,
  count(DISTINCT warehouse) AS warehouses, count(DISTINCT (trans_type, base_entry)) AS documents
FROM mov GROUP BY ALL""", "mov"))
def e9(spark, sf_dir):
    return ag.distinct_counts(_mov(spark, sf_dir))


_E9_GRAINS = {"period": ag.PERIOD, "quarter": ag.QUARTER, "year": ag.YEAR}
_E9_SQL = " UNION ALL ".join(f"""SELECT '{g}' AS grain, r_year, {'r_quarter' if 'r_quarter' in by else 'CAST(NULL AS INTEGER)'} AS r_quarter,
  {'r_period' if 'r_period' in by else 'CAST(NULL AS INTEGER)'} AS r_period, count(DISTINCT item_code) AS items, count(DISTINCT warehouse) AS warehouses,
  count(DISTINCT (trans_type, base_entry)) AS documents, true AS within_bound FROM coords GROUP BY {', '.join(by)}""" for g, by in _E9_GRAINS.items())


@query("e9_sketch_rollup", with_ctes(f"""SELECT * FROM ({_E9_SQL}) u""", "mov").replace("\nSELECT * FROM (", f""",
coords AS (SELECT *, CAST({sql_retail_year('doc_date')} AS INTEGER) AS r_year, CAST({sql_period_of_week(sql_retail_week('doc_date'))} AS INTEGER) AS r_period,
  CAST(({sql_period_of_week(sql_retail_week('doc_date'))} - 1) // 3 + 1 AS INTEGER) AS r_quarter FROM mov)
SELECT * FROM (""", 1))
def e9_rollup(spark, sf_dir):
    """Exact counts at three grains, and whether the estimates from the stored period sketches, united
    upwards, are within the stated bound of them."""
    mov = materialize(_mov(spark, sf_dir).select("doc_date", "item_code", "warehouse", "trans_type", "base_entry"), "values")
    stored = materialize(ag.distinct_sketches(mov), "sketches")
    counts = materialize(ag.distinct_by_grain(mov, _E9_GRAINS), "counts")
    out = None
    for grain, by in _E9_GRAINS.items():
        est = ag.sketch_counts(ag.roll_sketches(stored, by)).select(*by, *[F.col(k).alias(f"_{k}") for k in ag.SKETCHES])
        # each group has an estimate, but no count where none of its rows has a value
        exact = est.select(*by).dropna().join(counts.filter(F.col("grain") == grain).select(*by, *ag.SKETCHES), by, "left").fillna(0, [*ag.SKETCHES])
        near = [F.abs(F.col(f"_{k}") - F.col(k)) <= F.greatest(F.lit(1.0), F.col(k) * ag.sketch_error()) for k in ag.SKETCHES]
        row = exact.join(est, by).select(F.lit(grain).alias("grain"), *[(F.col(c) if c in by else F.lit(None)).cast("int").alias(c) for c in ag.PERIOD],
                                         *ag.SKETCHES, (near[0] & near[1] & near[2]).alias("within_bound"))
        out = row if out is None else out.unionByName(row)
    return out


@query("e9_distinct_counts_approx")
def e9a(spark, sf_dir):
    return ag.distinct_counts(_mov(spark, sf_dir), approx=True)


@query("e10_value_cube", with_ctes(f"""
SELECT company, r_year, r_quarter, r_period, round(sum(trans_value), 2) AS value, count(*) AS n,
       CAST(grouping(company, r_year, r_quarter, r_period) AS BIGINT) AS gid
FROM (SELECT *, {_RC('doc_date')} FROM mov) m GROUP BY ROLLUP (company, r_year, r_quarter, r_period)""", "mov"))
def e10(spark, sf_dir):
    return ag.value_cube(_mov(spark, sf_dir))


# ---------------------------------------------------------------- F: running stock, ranking
_F1_SQL = f"""SELECT *, sum(net_qty) OVER (PARTITION BY {KEYS} ORDER BY doc_date
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS on_hand
FROM (SELECT {KEYS}, doc_date, sum(in_qty) AS in_qty, sum(out_qty) AS out_qty, sum(in_qty - out_qty) AS net_qty
      FROM mov GROUP BY ALL) d"""


@query("f1_running_on_hand", with_ctes(_F1_SQL, "mov"))
def f1(spark, sf_dir):
    return inv.running_on_hand(_mov(spark, sf_dir))


@query("f2_on_hand_before", with_ctes(f"SELECT *, on_hand - net_qty AS on_hand_before FROM ({_F1_SQL}) f", "mov"))
def f2(spark, sf_dir):
    return inv.on_hand_before(_mov(spark, sf_dir))


@query("f2_on_hand_before_movement", with_ctes(f"""
SELECT mov_id, {KEYS}, doc_ts,
  COALESCE(sum(in_qty - out_qty) OVER (PARTITION BY {KEYS} ORDER BY doc_ts, create_date, base_entry, doc_line, mov_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0e0) AS on_hand_before
FROM mov""", "mov"))
def f2m(spark, sf_dir):
    # doc_ts orders by day first, so the per-day decomposition equals one per-key frame.
    return inv.on_hand_before_movement(_mov(spark, sf_dir)).select(
        "mov_id", "company", "item_code", "warehouse", "doc_ts", "on_hand_before")


@query("f10_top_movers", with_ctes(f"""SELECT * FROM (
  SELECT r_year, r_period, item_code, measure,
         row_number() OVER (PARTITION BY r_year, r_period ORDER BY measure DESC, item_code ASC) AS rank
  FROM (SELECT {sql_retail_year('doc_date')} AS r_year, {sql_period_of_week(sql_retail_week('doc_date'))} AS r_period,
               item_code, sum(out_qty) AS measure FROM mov GROUP BY ALL) a) t WHERE rank <= 5""", "mov"))
def f10(spark, sf_dir):
    return inv.top_movers(_mov(spark, sf_dir), 5, "out_qty")
