"""DuckDB twins of the fixture mapping, used by the independent SQL oracle.

Each CTE below re-derives, in plain SQL over the driver's views, the same movement journal,
stock snapshot, logs and runs that ``stockflow.sources.fixtures`` builds with DataFrames.
``with_ctes(body, *names)`` prepends the CTEs a query body needs (dependencies included).
Floor division is written out because DuckDB's ``//`` and Spark's ``div`` both truncate.
"""

from __future__ import annotations


def fmod(x: str, n: int) -> str:
    return f"((({x}) % {n}) + {n}) % {n}"


def fdiv(x: str, n: int) -> str:
    return f"((({x}) - {fmod(x, n)}) // {n})"


def days_from_anchor(d: str) -> str:
    return f"date_diff('day', DATE '2026-02-01', CAST({d} AS DATE))"


def sql_retail_year(d: str) -> str:
    return f"CAST(2026 + {fdiv(days_from_anchor(d), 364)} AS SMALLINT)"


def sql_retail_week(d: str) -> str:
    return f"CAST({fdiv(fmod(days_from_anchor(d), 364), 7)} + 1 AS INTEGER)"


def sql_period_of_week(w: str) -> str:
    wq = f"(({w}) - 1) % 13"
    return (f"CAST(((({w}) - 1) // 13) * 3 + CASE WHEN {wq} < 4 THEN 1 WHEN {wq} < 9 THEN 2 ELSE 3 END"
            f" AS INTEGER)")


def sql_quarter_of_week(w: str) -> str:
    return f"CAST((({w}) - 1) // 13 + 1 AS INTEGER)"


PERIOD_NAMES_SQL = ("['February','March','April','May','June','July','August','September',"
                    "'October','November','December','January']")


def sql_period_name(p: str) -> str:
    return f"{PERIOD_NAMES_SQL}[{p}]"


def sql_day_of_week(d: str) -> str:
    return f"CAST({fmod(days_from_anchor(d), 7)} + 1 AS INTEGER)"


def sql_week_start_of(d: str) -> str:
    return f"CAST(CAST({d} AS DATE) - CAST({fmod(days_from_anchor(d), 7)} AS INTEGER) AS DATE)"


def sql_year_start(y: str) -> str:
    return f"CAST(DATE '2026-02-01' + CAST((({y}) - 2026) * 364 AS INTEGER) AS DATE)"


def sql_item_code(key: str) -> str:
    text = f"CAST({key} AS VARCHAR)"
    return f"lpad({text}, greatest(CAST(length({text}) AS INTEGER), 7), '0')"


CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *deps: str) -> None:
    CTES[name] = (sql, deps)


def with_ctes(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][0]})" for n in order) + "\n" + body


cte("li_base", """
SELECT l.l_orderkey, l.l_partkey, l.l_linenumber, l.l_quantity, l.l_extendedprice,
       CAST(l.l_shipdate AS DATE) AS doc_date, CAST(o.o_orderdate AS DATE) AS create_date,
       n.n_regionkey,
       CAST(CASE WHEN l.l_linenumber = 7 THEN 69
            WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'O' THEN 20
            WHEN l.l_returnflag = 'R' THEN 16
            WHEN l.l_returnflag = 'A' THEN 15
            WHEN l.l_returnflag = 'N' AND l.l_linestatus = 'O' THEN 13
            WHEN l.l_returnflag = 'N' AND l.l_linestatus = 'F' THEN 67 END AS BIGINT) AS trans_type
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey""")

cte("src", f"""
SELECT CASE l_partkey % 3 WHEN 0 THEN 'COMERCIAL' WHEN 1 THEN 'HR' ELSE 'CAP' END AS company,
       {sql_item_code('l_partkey')} AS item_code,
       'A0' || CAST((n_regionkey + g.leg) % 5 AS VARCHAR) AS warehouse,
       doc_date,
       CAST(CASE WHEN l_linenumber <> 1 THEN (l_orderkey % 24) * 100 + (l_linenumber * 7) % 60 END AS SMALLINT) AS doc_time,
       create_date, trans_type,
       l_orderkey AS base_entry, l_orderkey + 100000 AS base_num, CAST(l_linenumber AS BIGINT) AS doc_line,
       CASE WHEN trans_type = 20 THEN l_quantity * 3
            WHEN trans_type = 16 OR (trans_type = 67 AND g.leg = 1) THEN l_quantity ELSE 0.0e0 END AS in_qty,
       CASE WHEN trans_type IN (13, 15) OR (trans_type = 67 AND g.leg = 0) THEN l_quantity ELSE 0.0e0 END AS out_qty,
       CASE WHEN trans_type IN (20, 16, 69) OR (trans_type = 67 AND g.leg = 1) THEN l_extendedprice
            ELSE -l_extendedprice END AS trans_value
FROM li_base JOIN (VALUES (0), (1)) g(leg) ON g.leg = 0 OR li_base.trans_type = 67""", "li_base")

cte("src_open", """
SELECT * FROM src
UNION ALL
SELECT company, item_code, warehouse, DATE '1994-12-31', CAST(NULL AS SMALLINT), DATE '1994-12-31',
       CAST(59 AS BIGINT), CAST(item_code AS BIGINT) + 900000000, CAST(item_code AS BIGINT) + 900000000,
       CAST(0 AS BIGINT), 60.0e0, 0.0e0, 0.0e0
FROM (SELECT DISTINCT company, item_code, warehouse FROM src) k""", "src")


def _finalize(source: str) -> str:
    t = "COALESCE(CAST(doc_time AS INTEGER), 0)"
    return f"""
SELECT md5(company || '|' || CAST(trans_type AS VARCHAR) || '|' || CAST(base_entry AS VARCHAR) || '|'
           || CAST(doc_line AS VARCHAR) || '|' || item_code || '|' || warehouse) AS mov_id,
       company, item_code, warehouse, doc_date, doc_time,
       CAST(doc_date AS TIMESTAMP) + to_minutes(CAST({fdiv(t, 100)} * 60 + {fmod(t, 100)} AS BIGINT)) AS doc_ts,
       create_date, trans_type, base_entry, base_num, doc_line, in_qty, out_qty, trans_value,
       {sql_retail_year('doc_date')} AS retail_year
FROM {source}"""


cte("mov", _finalize("src_open"), "src_open")
cte("mov_nopen", _finalize("src"), "src")

cte("stock", """
SELECT company, item_code, warehouse,
       qty + CASE WHEN CAST(item_code AS BIGINT) % 97 = 0 THEN 1.0e0 ELSE 0.0e0 END
           + CASE WHEN CAST(item_code AS BIGINT) % 89 = 0 THEN 0.0005e0 ELSE 0.0e0 END AS qty_sap
FROM (SELECT company, item_code, warehouse, SUM(in_qty - out_qty) AS qty FROM mov GROUP BY ALL) a
WHERE CAST(item_code AS BIGINT) % 101 <> 0
UNION ALL
SELECT DISTINCT company, '9999999', 'A00', 5.0e0 FROM mov""", "mov")

_CORR = "md5(CAST(user_id AS VARCHAR) || '|' || CAST(CAST(ts AS DATE) AS VARCHAR))"

cte("ev_k", """
SELECT event_id, ts, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
FROM events""")

cte("job_logs", f"""
SELECT event_id, ts, CASE WHEN value > 100 THEN 'error' ELSE 'info' END AS level,
       {_CORR} AS correlation_id, 'job' AS source,
       CASE WHEN value > 100 THEN 'failed' ELSE 'ok' END AS status,
       ts - to_microseconds(CAST(round(value * 60000000.0e0) AS BIGINT)) AS started_at,
       ts AS finished_at,
       CAST(round(value * 60000000.0e0) AS BIGINT) // 1000 AS duration_ms,
       CAST(NULL AS VARCHAR) AS detail,
       CASE WHEN event_type = 'signup' THEN 'sync-movements' ELSE 'backfill-movements' END AS job,
       k AS rows
FROM ev_k WHERE event_type IN ('signup', 'purchase')""", "ev_k")

cte("api_logs", f"""
SELECT event_id, ts,
       CASE WHEN status_code >= 500 THEN 'error' WHEN status_code >= 400 THEN 'warn' ELSE 'info' END AS level,
       correlation_id, 'api' AS source,
       CASE WHEN status_code >= 400 THEN 'failed' ELSE 'ok' END AS status,
       ts - to_milliseconds(duration_ms) AS started_at, ts AS finished_at, duration_ms,
       CASE WHEN status_code >= 400 THEN 'HTTP ' || CAST(status_code AS VARCHAR) END AS detail,
       method, path, status_code
FROM (SELECT event_id, ts, {_CORR} AS correlation_id,
             CAST(CASE WHEN value > 150 THEN 500 WHEN value > 100 THEN 404 ELSE 200 END AS INTEGER) AS status_code,
             CAST(floor(value * 10) AS BIGINT) AS duration_ms,
             CASE WHEN event_type = 'click' THEN 'GET' ELSE 'POST' END AS method,
             CASE WHEN event_type = 'click' THEN '/v1/logs' ELSE '/v1/jobs' END AS path
      FROM ev_k WHERE event_type IN ('click', 'error')) a""", "ev_k")

cte("perf_logs", f"""
SELECT event_id, ts, 'info' AS level, {_CORR} AS correlation_id, 'performance' AS source,
       'host-1' AS host, least(value, 100.0e0) AS cpu_pct, value * 20 AS rss_mb,
       least(value / 5, 100.0e0) AS mem_pct, least(value / 10, 100.0e0) AS disk_pct,
       SUM(value) OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS io_counter_mb
FROM ev_k WHERE event_type = 'view'""", "ev_k")

cte("run_base", """
SELECT event_id AS id, job,
       CASE k % 4 WHEN 0 THEN 'api' WHEN 1 THEN 'scheduled' WHEN 2 THEN 'cli' ELSE 'manual' END AS trigger,
       correlation_id, CASE WHEN k % 2 = 0 THEN correlation_id END AS idempotency_key,
       started_at, finished_at, status, rows
FROM (SELECT *, rows AS k FROM job_logs) j""", "job_logs")

cte("run_events", """
SELECT id, job, trigger, correlation_id, idempotency_key, 0 AS seq, 'queued' AS state,
       started_at - INTERVAL 5 SECOND AS event_at, CAST(NULL AS BIGINT) AS rows FROM run_base
UNION ALL
SELECT id, job, trigger, correlation_id, idempotency_key, 1, 'running', started_at, CAST(NULL AS BIGINT) FROM run_base
UNION ALL
SELECT id, job, trigger, correlation_id, idempotency_key, 2, status, finished_at, rows FROM run_base""", "run_base")


cte("run_events_planted", """
SELECT id, job, trigger, correlation_id, idempotency_key, 0 AS seq, 'queued' AS state,
       started_at - INTERVAL 5 SECOND AS event_at, CAST(NULL AS BIGINT) AS rows FROM run_base WHERE id % 53 <> 0
UNION ALL
SELECT id, job, trigger, correlation_id, idempotency_key, 1, 'running', started_at, CAST(NULL AS BIGINT) FROM run_base
UNION ALL
SELECT id, job, trigger, correlation_id, idempotency_key, 2, status,
       CASE WHEN id % 61 = 0 THEN started_at - INTERVAL 1 SECOND ELSE finished_at END, rows FROM run_base WHERE id % 67 <> 0
UNION ALL
SELECT id, job, trigger, correlation_id, idempotency_key, 3, 'failed', finished_at + INTERVAL 1 SECOND, rows FROM run_base
WHERE id % 59 = 0""", "run_base")


def _runs_sql(where: str, events: str = "run_events") -> str:
    return f"""
SELECT id, job, status, trigger, rows, CAST(NULL AS VARCHAR) AS detail, correlation_id, idempotency_key,
       COALESCE(created_at, running_at, finished_at) AS created_at, started_at, finished_at,
       date_diff('microsecond', started_at, finished_at) / 1e6 AS duration_s
FROM (SELECT *, CASE WHEN finished_at IS NOT NULL THEN COALESCE(running_at, finished_at) ELSE running_at END AS started_at
      FROM (SELECT id, max(job) AS job, max(trigger) AS trigger, max(correlation_id) AS correlation_id,
                   max(idempotency_key) AS idempotency_key, arg_max(state, seq) AS status,
                   min(event_at) FILTER (WHERE state = 'queued') AS created_at,
                   max(event_at) FILTER (WHERE state = 'running') AS running_at,
                   max(event_at) FILTER (WHERE state IN ('ok', 'failed')) AS finished_at,
                   max(rows) FILTER (WHERE state IN ('ok', 'failed')) AS rows
            FROM {events} {where} GROUP BY id) g) s"""


cte("run_ends", """
SELECT id, max(job) AS job, min(event_at) FILTER (WHERE state = 'queued') AS created_at, min(event_at) FILTER (WHERE state = 'running') AS started_at,
       min(event_at) FILTER (WHERE state IN ('ok', 'failed')) AS finished_at,
       arg_min(state, (event_at, seq)) FILTER (WHERE state IN ('ok', 'failed')) AS ended,
       arg_min(rows, (event_at, seq)) FILTER (WHERE state IN ('ok', 'failed')) AS rows,
       COALESCE(min(event_at) FILTER (WHERE state = 'queued'), min(event_at) FILTER (WHERE state = 'running'), min(event_at)) + INTERVAL 1 HOUR AS due
FROM run_events_planted GROUP BY id""", "run_events_planted")
RUNS_AS_OF = "2024-01-15 12:00:00"
cte("runs", _runs_sql(""), "run_events")
cte("runs_asof", _runs_sql(f"WHERE event_at <= TIMESTAMP '{RUNS_AS_OF}'"), "run_events")
cte("runs_asof_planted", _runs_sql(f"WHERE event_at <= TIMESTAMP '{RUNS_AS_OF}'", "run_events_planted"), "run_events_planted")
cte("unified", """
SELECT 'job' AS type, 0 AS type_rank, event_id, ts, level, correlation_id, source, status, started_at, finished_at,
       duration_ms, detail, job, rows, NULL::VARCHAR AS method, NULL::VARCHAR AS path, NULL::INTEGER AS status_code,
       NULL::VARCHAR AS host, NULL::DOUBLE AS cpu_pct, NULL::DOUBLE AS rss_mb, NULL::DOUBLE AS mem_pct,
       NULL::DOUBLE AS disk_pct, NULL::DOUBLE AS io_counter_mb FROM job_logs
UNION ALL
SELECT 'api', 1, event_id, ts, level, correlation_id, source, status, started_at, finished_at, duration_ms, detail,
       NULL, NULL, method, path, status_code, NULL, NULL, NULL, NULL, NULL, NULL FROM api_logs
UNION ALL
SELECT 'performance', 2, event_id, ts, level, correlation_id, source, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
       NULL, NULL, NULL, host, cpu_pct, rss_mb, mem_pct, disk_pct, io_counter_mb FROM perf_logs""",
    "job_logs", "api_logs", "perf_logs")

# ---------------------------------------------------------------- demand / replenishment
cte("hist", f"""
SELECT *, on_hand - net_qty AS on_hand_before, sales - returns AS net_sales, on_hand - net_qty <= 0 AS stockout
FROM (SELECT *, sum(net_qty) OVER (PARTITION BY company, item_code, warehouse ORDER BY doc_date
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS on_hand
      FROM (SELECT company, item_code, warehouse, doc_date,
                   sum(CASE WHEN trans_type = 15 OR (trans_type = 13 AND out_qty > 0) THEN out_qty ELSE 0.0e0 END) AS sales,
                   sum(CASE WHEN trans_type IN (14, 16) THEN in_qty ELSE 0.0e0 END) AS returns,
                   sum(in_qty - out_qty) AS net_qty
            FROM mov GROUP BY ALL) d) r""", "mov")
cte("ivals", f"""
SELECT * FROM (
  SELECT company, item_code, warehouse, doc_date AS valid_from, net_qty,
         sum(net_qty) OVER (PARTITION BY company, item_code, warehouse ORDER BY doc_date
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS on_hand,
         least(COALESCE(CAST(lead(doc_date) OVER (PARTITION BY company, item_code, warehouse ORDER BY doc_date) - 1 AS DATE),
                  (SELECT max(doc_date) FROM mov)), (SELECT max(doc_date) FROM mov)) AS valid_to
  FROM (SELECT company, item_code, warehouse, doc_date, sum(in_qty - out_qty) AS net_qty FROM mov GROUP BY ALL) d) i
WHERE valid_from <= valid_to""", "mov")
cte("dense", f"""
SELECT company, item_code, warehouse, cycle, on_hand, CAST(doc_date + CAST(i AS INTEGER) AS DATE) AS day, CASE WHEN i = 0 THEN sales ELSE 0.0e0 END AS sales,
       CASE WHEN i = 0 THEN stockout ELSE on_hand <= 0 END AS stockout
FROM (SELECT *, unnest(range(0, date_diff('day', doc_date, upto) + 1)) AS i FROM (
        SELECT *, sum(CASE WHEN net_qty > 0 THEN 1 ELSE 0 END) OVER w AS cycle,
               COALESCE(CAST(lead(doc_date) OVER w - 1 AS DATE), (SELECT max(doc_date) FROM mov)) AS upto
        FROM hist WINDOW w AS (PARTITION BY company, item_code, warehouse ORDER BY doc_date)) h) d""", "hist")
cte("cells", f"""
SELECT company, item_code, warehouse, CAST({sql_retail_year('day')} AS INTEGER) AS r_year, {sql_period_of_week(sql_retail_week('day'))} AS r_period,
       {sql_day_of_week('day')} AS dow, count(*) AS days, count_if(stockout) AS n_out, sum(sales) AS sales,
       sum(CASE WHEN NOT stockout THEN sales ELSE 0.0e0 END) AS in_sales
FROM dense GROUP BY ALL""", "dense")
cte("uncon", """
SELECT company, item_code, warehouse, r_year, r_period, CAST(sum(days) AS BIGINT) AS days, CAST(sum(n_out) AS BIGINT) AS stockout_days,
       sum(sales) AS demand_leave, sum(in_sales) AS demand_discard,
       round(CASE WHEN any_value(mk) IS NULL THEN sum(sales) ELSE sum(in_sales) + sum(n_out * COALESCE(m1, mp, mk)) END, 6) AS demand_v1
FROM (SELECT *, sum(in_sales) OVER a / NULLIF(sum(days - n_out) OVER a, 0) AS m1, sum(in_sales) OVER b / NULLIF(sum(days - n_out) OVER b, 0) AS mp,
             sum(in_sales) OVER c / NULLIF(sum(days - n_out) OVER c, 0) AS mk
      FROM cells WINDOW a AS (PARTITION BY company, item_code, warehouse, r_period, dow),
                        b AS (PARTITION BY company, item_code, warehouse, r_period), c AS (PARTITION BY company, item_code, warehouse)) x
GROUP BY company, item_code, warehouse, r_year, r_period""", "cells")
_SERIES = """
SELECT s.company, s.item_code, s.p, COALESCE(w.qty, 0.0e0) AS qty
FROM (SELECT company, item_code, CAST(unnest(generate_series(first_p, last_p)) AS INTEGER) AS p
      FROM (SELECT company, item_code, min(p) AS first_p FROM {w} GROUP BY ALL) f,
           (SELECT max(p) AS last_p FROM {w}) l) s
LEFT JOIN {w} w ON s.company = w.company AND s.item_code = w.item_code AND s.p = w.p"""


def _demand(tag: str, mov: str) -> None:
    """Weekly demand, lead-time demand, reorder points and last order dates of one journal."""
    cte(f"wsales{tag}", f"""
SELECT company, item_code, CAST({fdiv(days_from_anchor('doc_date'), 7)} AS INTEGER) AS p, sum(out_qty) AS qty
FROM {mov} WHERE trans_type IN (13, 15) GROUP BY ALL""", mov)
    cte(f"series{tag}", _SERIES.format(w=f"wsales{tag}"), f"wsales{tag}")
    cte(f"upto{tag}", f"""SELECT s.*, pr.lt_weeks, sum(qty) OVER (PARTITION BY s.company, s.item_code ORDER BY s.p
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM series{tag} s JOIN priors pr USING (item_code)""", f"series{tag}", "priors")
    cte(f"ltd{tag}", f"""SELECT a.company, a.item_code, a.p, a.lt_weeks, b.cum - a.cum + a.qty AS ltd FROM upto{tag} a
JOIN upto{tag} b ON a.company = b.company AND a.item_code = b.item_code AND b.p = a.p + a.lt_weeks - 1""", f"upto{tag}")
    cte(f"rop{tag}", f"SELECT company, item_code, quantile_cont(ltd, 0.95) AS rop FROM ltd{tag} GROUP BY ALL", f"ltd{tag}")
    cte(f"lod{tag}", f"""
SELECT company, item_code, CAST(season AS INTEGER) AS season, CAST({sql_year_start('season')} + 363 AS DATE) AS season_end,
       CAST({sql_year_start('season')} + 363 - lt_days AS DATE) AS last_order_date
FROM (SELECT DISTINCT company, item_code, 2026 + {fdiv('p', 52)} AS season FROM series{tag}) s
JOIN priors USING (item_code)""", f"series{tag}", "priors")


DEMAND_AS_OF = "1998-06-01"
cte("mov_asof", f"SELECT * FROM mov WHERE doc_date <= DATE '{DEMAND_AS_OF}'", "mov")
_demand("", "mov")
_demand("_asof", "mov_asof")
cte("wsales91", f"""
SELECT company, item_code, CAST({fdiv(days_from_anchor('doc_date'), 91)} AS INTEGER) AS p, sum(out_qty) AS qty
FROM mov WHERE trans_type IN (13, 15) GROUP BY ALL""", "mov")
cte("series91", _SERIES.format(w="wsales91"), "wsales91")
cte("wsales28", f"""
SELECT company, item_code, CAST({fdiv(days_from_anchor('doc_date'), 28)} AS INTEGER) AS p, sum(out_qty) AS qty
FROM mov WHERE trans_type IN (13, 15) GROUP BY ALL""", "mov")
cte("series28", _SERIES.format(w="wsales28"), "wsales28")
cte("origin", f"""
SELECT {sql_item_code('f.l_partkey')} AS item_code,
       CASE n.n_regionkey % 3 WHEN 0 THEN 'NACIONAL' WHEN 1 THEN 'USA' ELSE 'CHINA' END AS origin
FROM (SELECT l_partkey, min(l_suppkey) AS s_suppkey FROM lineitem GROUP BY ALL) f
JOIN supplier s ON f.s_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey""")
cte("priors", """
SELECT item_code, origin, lt_days, lt_min, lt_max, (lt_max - lt_min) / 4.0e0 AS lt_sd,
       CAST(ceil(lt_days / 7) AS INTEGER) AS lt_weeks
FROM (SELECT item_code, origin,
             CASE origin WHEN 'NACIONAL' THEN 15 WHEN 'USA' THEN 30 ELSE 150 END AS lt_days,
             CASE origin WHEN 'NACIONAL' THEN 15 WHEN 'USA' THEN 30 ELSE 120 END AS lt_min,
             CASE origin WHEN 'NACIONAL' THEN 15 WHEN 'USA' THEN 30 ELSE 180 END AS lt_max FROM origin) o""", "origin")
