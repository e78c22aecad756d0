"""Catalogue: demand, replenishment and forecasting."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from stockflow.operators import analogs as an
from stockflow.operators import demand as dm
from stockflow.operators import forecast as fc
from stockflow.operators import replenish as rp
from stockflow.operators import stl as sm
from stockflow.operators import unconstrain as un
from stockflow.plans.catalog import query
from stockflow.plans.oracle_sql import DEMAND_AS_OF as AS_OF
from stockflow.plans.oracle_sql import fdiv, sql_item_code, sql_period_of_week, sql_retail_week, sql_retail_year, with_ctes
from stockflow.session import apply_session_conf
from stockflow.sources import fixtures as fx
from stockflow.sources.tables import read_table

K3 = "company, item_code, warehouse"
Z95 = repr(NormalDist().inv_cdf(0.95))


def _mov(spark, sf_dir):
    apply_session_conf(spark)
    return fx.movements(spark, sf_dir)


def _series(spark, sf_dir):
    return dm.demand_series(_mov(spark, sf_dir))


def _priors(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", "l_partkey", "l_suppkey")
    su = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    na = read_table(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")
    return rp.leadtime_prior(rp.item_origin(li, su, na))


def _part(spark, sf_dir):
    return read_table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_type", "p_retailprice")


def _ltd(spark, sf_dir):
    return rp.leadtime_demand(dm.demand_arrays(_mov(spark, sf_dir)), _priors(spark, sf_dir))


def _rounded(df, names, digits: int = 4):
    """Columns rounded, with a hair on top: else the last bit of a sum decides a half."""
    return df.withColumns({c: F.round(F.col(c) + 1e-9, digits) for c in names})


@query("h1_sales_history", with_ctes("SELECT * FROM hist", "hist"))
def h1(spark, sf_dir):
    return dm.sales_history(_mov(spark, sf_dir))


@query("h2_stockout_days", with_ctes(f"""SELECT {K3}, CAST(sum(valid_to - valid_from + 1) AS BIGINT) AS days,
  CAST(sum(CASE WHEN on_hand <= 0 THEN valid_to - valid_from + 1 ELSE 0 END) AS BIGINT) AS stockout_days
FROM ivals GROUP BY ALL""", "ivals"))
def h2(spark, sf_dir):
    return dm.stockout_days(_mov(spark, sf_dir))


@query("h3_stockout_episodes", with_ctes(f"""SELECT {K3}, min(valid_from) AS start, max(valid_to) AS "end",
  CAST(max(valid_to) - min(valid_from) + 1 AS INTEGER) AS length
FROM (SELECT *, sum(CASE WHEN on_hand <= 0 THEN 0 ELSE 1 END) OVER (PARTITION BY {K3} ORDER BY valid_from
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM ivals) i
WHERE on_hand <= 0 GROUP BY company, item_code, warehouse, island""", "ivals"))
def h3(spark, sf_dir):
    return dm.stockout_episodes(_mov(spark, sf_dir))


_RP = sql_period_of_week(sql_retail_week("doc_date"))


@query("h2_stockout_by_period", with_ctes(f"SELECT {K3}, r_year, r_period, days, stockout_days FROM uncon", "uncon"))
def h2p(spark, sf_dir):
    return un.unconstrain_periods(_mov(spark, sf_dir)).select("company", "item_code", "warehouse", "r_year", "r_period", "days", "stockout_days")


@query("h4_unconstrain_v1", with_ctes("SELECT * FROM uncon", "uncon"))
def h4(spark, sf_dir):
    return un.unconstrain_periods(_mov(spark, sf_dir))


@query("h5_demand_series", with_ctes("SELECT * FROM series", "series"))
def h5(spark, sf_dir):
    return _series(spark, sf_dir)


_ADI = """SELECT company, item_code, periods, nonzero, adi, cv2,
  CASE WHEN adi < 1.32 AND cv2 < 0.49 THEN 'smooth' WHEN cv2 < 0.49 THEN 'intermittent'
       WHEN adi < 1.32 THEN 'erratic' ELSE 'lumpy' END AS demand_class
FROM (SELECT company, item_code, count(*) AS periods, count(CASE WHEN qty > 0 THEN qty END) AS nonzero,
             count(*) / count(CASE WHEN qty > 0 THEN qty END) AS adi,
             (count(CASE WHEN qty > 0 THEN qty END) * sum(CASE WHEN qty > 0 THEN qty * qty END)
              - pow(sum(CASE WHEN qty > 0 THEN qty END), 2)) / pow(sum(CASE WHEN qty > 0 THEN qty END), 2) AS cv2
      FROM {src} GROUP BY ALL) g"""


@query("h6_adi_cv2", with_ctes(_ADI.format(src="series"), "series"))
def h6(spark, sf_dir):
    return dm.adi_cv2_from_sales(_mov(spark, sf_dir))


@query("h6_adi_cv2_quarterly", with_ctes(_ADI.format(src="series91"), "series91"))
def h6q(spark, sf_dir):
    return dm.adi_cv2(dm.demand_series(_mov(spark, sf_dir), grain_days=91))


@query("h7_lifecycle_stage", with_ctes("""SELECT company, item_code, age, recent, prior,
  round(CASE WHEN prior > 0 THEN recent / prior END, 6) AS trend_ratio,
  CASE WHEN age < 8 THEN 'new' WHEN prior <= 0 AND recent > 0 THEN 'growth'
       WHEN prior > 0 AND recent / prior > 1.2 THEN 'growth' WHEN prior > 0 AND recent / prior < 0.8 THEN 'decline'
       ELSE 'mature' END AS stage
FROM (SELECT company, item_code, max(last_p) - min(p) + 1 AS age,
             sum(CASE WHEN p > last_p - 13 THEN qty ELSE 0.0e0 END) AS recent,
             sum(CASE WHEN p <= last_p - 13 AND p > last_p - 26 THEN qty ELSE 0.0e0 END) AS prior
      FROM (SELECT *, (SELECT max(p) FROM series) AS last_p FROM series) s GROUP BY ALL) g""", "series"))
def h7(spark, sf_dir):
    return dm.lifecycle_stage(_series(spark, sf_dir))


def _abc_sql(cum, own, total):
    before = f"round({cum} / {total}, 6) - round({own} / {total}, 6)"
    return f"CASE WHEN {before} < 0.8 THEN 'A' WHEN {before} < 0.95 THEN 'B' ELSE 'C' END"


@query("h8_abc_by_period", with_ctes(f"""SELECT r_year, r_period, company, item_code, value, round(cum / total, 6) AS cum_share,
  {_abc_sql('cum', 'value', 'total')} AS abc, score, {_abc_sql('score_cum', 'score', 'score_total')} AS abc_multi
FROM (SELECT *, sum(value) OVER (PARTITION BY r_year, r_period ORDER BY value DESC, company, item_code
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
             sum(score) OVER (PARTITION BY r_year, r_period ORDER BY score DESC, company, item_code
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS score_cum,
             sum(score) OVER (PARTITION BY r_year, r_period) AS score_total
      FROM (SELECT *, sum(value) OVER w AS total,
                   round((0.6e0 * COALESCE(CAST(value AS DOUBLE) / sum(value) OVER w, 0.0e0) + 0.25e0 * COALESCE(CAST(units AS DOUBLE) / sum(units) OVER w, 0.0e0)
                          + 0.15e0 * COALESCE(CAST(sales_days AS DOUBLE) / sum(sales_days) OVER w, 0.0e0)) * 1e6, 3) AS score
            FROM (SELECT {sql_retail_year('doc_date')} AS r_year, {_RP} AS r_period, company, item_code, round(sum(abs(trans_value)), 2) AS value,
                         sum(out_qty) AS units, count(DISTINCT doc_date) AS sales_days
                  FROM mov WHERE trans_type IN (13, 15) GROUP BY ALL) a WINDOW w AS (PARTITION BY r_year, r_period)) b) c""", "mov"))
def h8(spark, sf_dir):
    return dm.abc_by_period(_mov(spark, sf_dir))


@query("h9_leadtime_prior", with_ctes("SELECT * FROM priors", "priors"))
def h9(spark, sf_dir):
    apply_session_conf(spark)
    return _priors(spark, sf_dir)


@query("h10_receipt_cadence", with_ctes(f"""SELECT {K3}, count(*) AS gaps, round(avg(gap), 6) AS mean_gap,
  round(stddev_pop(gap), 6) AS sd_gap, quantile_cont(gap, 0.5) AS p50_gap, quantile_cont(gap, 0.9) AS p90_gap
FROM (SELECT *, CAST(doc_date - lag(doc_date) OVER (PARTITION BY {K3} ORDER BY doc_date) AS INTEGER) AS gap
      FROM (SELECT DISTINCT {K3}, doc_date FROM mov WHERE trans_type IN (20, 59)) r) g
WHERE gap IS NOT NULL GROUP BY ALL""", "mov"))
def h10(spark, sf_dir):
    return rp.receipt_cadence(_mov(spark, sf_dir))


@query("h11_leadtime_demand", with_ctes("SELECT * FROM ltd", "ltd"))
def h11(spark, sf_dir):
    return _ltd(spark, sf_dir)


@query("h12_reorder_point", with_ctes("SELECT * FROM rop", "rop"))
def h12(spark, sf_dir):
    return rp.reorder_point(_ltd(spark, sf_dir))


@query("h12_uncertain_lead_time", with_ctes("""
SELECT company, item_code, round(max(q) + 1e-9, 4) AS rop, round(max(mean_ltd) + 1e-9, 4) AS mean_ltd,
  round(max(q) - max(mean_ltd) + 1e-9, 4) AS safety_stock
FROM (SELECT company, item_code, v, mean_ltd, CASE WHEN p >= 0.95 AND COALESCE(before_p < 0.95, true) THEN
        CASE WHEN before_p IS NULL OR p <= before_p THEN v ELSE before_v + (v - before_v) * (0.95e0 - before_p) / (p - before_p) END END AS q
      FROM (SELECT *, lag(p) OVER o AS before_p, lag(v) OVER o AS before_v FROM (
              SELECT *, (cumw - w) / nullif(total - last_w, 0) AS p FROM (
                SELECT company, item_code, v, w, sum(w) OVER (PARTITION BY company, item_code ORDER BY v, w ROWS UNBOUNDED PRECEDING) AS cumw,
                  sum(w) OVER g AS total, sum(w * v) OVER g / sum(w) OVER g AS mean_ltd,
                  last_value(w) OVER (PARTITION BY company, item_code ORDER BY v, w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_w
                FROM mix WINDOW g AS (PARTITION BY company, item_code)) y) a
            WINDOW o AS (PARTITION BY company, item_code ORDER BY v, w, cumw)) b) c GROUP BY ALL""", "series", "priors").replace("\nSELECT company, item_code, round(max(q) + 1e-9, 4) AS rop, round(max(mean_ltd)", f""",
gaps AS (SELECT item_code, count(*) AS gaps, avg(gap) AS mean_gap, stddev_pop(gap) AS sd_gap FROM (
  SELECT item_code, CAST(doc_date - lag(doc_date) OVER (PARTITION BY item_code ORDER BY doc_date) AS INTEGER) AS gap
  FROM (SELECT DISTINCT item_code, doc_date FROM mov WHERE trans_type IN (20, 59)) r) g WHERE gap IS NOT NULL GROUP BY ALL),
post AS (SELECT item_code, lt_min, lt_max, CASE WHEN u THEN greatest(least((lt_days / (lt_sd * lt_sd) + mean_gap * gaps / (sd_gap * sd_gap)) / (1 / (lt_sd * lt_sd) + gaps / (sd_gap * sd_gap)), lt_max), lt_min)
    ELSE lt_days END AS lt_days, CASE WHEN u THEN 1 / sqrt(1 / (lt_sd * lt_sd) + gaps / (sd_gap * sd_gap)) ELSE lt_sd END AS lt_sd
  FROM (SELECT *, COALESCE(lt_sd > 0 AND gaps >= 3 AND sd_gap > 0, false) AS u FROM priors LEFT JOIN gaps USING (item_code)) x),
lead AS (SELECT item_code, weeks, w / sum(w) OVER (PARTITION BY item_code) AS w FROM (
  SELECT item_code, weeks, exp(-pow((weeks * 7 - lt_days) / lt_sd, 2) / 2) AS w FROM (SELECT *, unnest(range(CAST(ceil(lt_min / 7) AS BIGINT), CAST(ceil(lt_max / 7) AS BIGINT) + 1)) AS weeks FROM post WHERE lt_sd > 0) a
  UNION ALL SELECT item_code, CAST(ceil(lt_days / 7) AS BIGINT), 1.0e0 FROM post WHERE lt_sd = 0) l),
cums AS (SELECT company, item_code, p, qty, sum(qty) OVER (PARTITION BY company, item_code ORDER BY p) AS cum, count(*) OVER (PARTITION BY company, item_code) AS n FROM series),
mix AS (SELECT a.company, a.item_code, b.cum - a.cum + a.qty AS v, l.w / (a.n - l.weeks + 1) AS w
  FROM cums a JOIN lead l ON a.item_code = l.item_code AND l.weeks <= a.n JOIN cums b ON a.company = b.company AND a.item_code = b.item_code AND b.p = a.p + l.weeks - 1)
SELECT company, item_code, round(max(q) + 1e-9, 4) AS rop, round(max(mean_ltd)""", 1))
def h12_uncertain(spark, sf_dir):
    mov = _mov(spark, sf_dir)
    weights = rp.leadtime_weights(rp.update_prior(_priors(spark, sf_dir), mov))
    return _rounded(rp.uncertain_leadtime(dm.demand_arrays(mov), weights), ["rop", "mean_ltd", "safety_stock"])


@query("h13_safety_stock", with_ctes(f"""SELECT g.company, g.item_code, round(q - m, 6) AS ss_empirical,
  round(sd * {Z95}, 6) AS ss_normal,
  zero_share > 0.5 OR abs(COALESCE(skew, 0.0e0)) > 1 AS normal_doubtful,
  round(sd_week * {Z95} * sqrt(g.lt_weeks), 6) AS ss_textbook,
  round({Z95} * sqrt(g.lt_weeks * sd_week * sd_week + mean_week * mean_week * (lt_sd / 7) * (lt_sd / 7)), 6) AS ss_variable_lead,
  'textbook form assumes independent normal weekly demand' AS textbook_warning
FROM (SELECT company, item_code, quantile_cont(ltd, 0.95) AS q, avg(ltd) AS m, stddev_pop(ltd) AS sd,
             CASE WHEN var_pop(ltd) > 0 THEN (avg(ltd * ltd * ltd) - 3 * avg(ltd) * avg(ltd * ltd) + 2 * pow(avg(ltd), 3))
                  / pow(var_pop(ltd), 1.5) END AS skew,
             avg(CASE WHEN ltd = 0 THEN 1.0e0 ELSE 0.0e0 END) AS zero_share, max(lt_weeks) AS lt_weeks
      FROM ltd GROUP BY ALL) g
JOIN (SELECT company, item_code, stddev_pop(qty) AS sd_week, avg(qty) AS mean_week FROM series GROUP BY ALL) w
  USING (company, item_code) JOIN priors USING (item_code)""", "ltd", "series", "priors"))
def h13(spark, sf_dir):
    return rp.safety_stock(_ltd(spark, sf_dir), _series(spark, sf_dir), _priors(spark, sf_dir))


@query("h14_last_order_date", with_ctes("SELECT * FROM lod", "lod"))
def h14(spark, sf_dir):
    return rp.last_order_date(_series(spark, sf_dir), _priors(spark, sf_dir))


@query("h15_reorder_report", with_ctes(f"""SELECT r.company, r.item_code, p.origin, o.on_hand, r.rop, l.last_order_date,
  CAST(ceil(r.rop + m.mean_qty * 4 - o.on_hand) AS BIGINT) AS recommended_qty
FROM rop_asof r JOIN priors p USING (item_code)
JOIN (SELECT company, item_code, sum(in_qty - out_qty) AS on_hand FROM mov_asof GROUP BY ALL) o
  USING (company, item_code)
JOIN (SELECT * FROM lod_asof WHERE season = {sql_retail_year(f"DATE '{AS_OF}'")}) l USING (company, item_code)
JOIN (SELECT company, item_code, avg(qty) AS mean_qty FROM series_asof GROUP BY ALL) m USING (company, item_code)
WHERE o.on_hand <= r.rop AND DATE '{AS_OF}' <= l.last_order_date""", "rop_asof", "lod_asof", "series_asof", "mov_asof", "priors"))
def h15(spark, sf_dir):
    return rp.reorder_report(_mov(spark, sf_dir), _priors(spark, sf_dir), AS_OF)


@query("h16_policy_params", with_ctes("""SELECT company, item_code, rop AS reorder_point, CAST(ceil(mean_qty * 4) AS DOUBLE) AS order_qty,
  rop + CAST(ceil(mean_qty * 4) AS DOUBLE) AS order_up_to, 4 AS review_periods, round(rop + mean_qty * 4, 6) AS review_up_to
FROM rop JOIN (SELECT company, item_code, avg(qty) AS mean_qty FROM series GROUP BY ALL) m USING (company, item_code)""",
    "rop", "series"))
def h16(spark, sf_dir):
    return rp.policy_params(rp.reorder_point(_ltd(spark, sf_dir)), _series(spark, sf_dir))


@query("h17_service_kpis", with_ctes(f"""
SELECT {K3}, round(n_out / days, 6) AS stockout_rate, round(sales / NULLIF(demand_v1, 0), 6) AS fill_rate,
       round(cycle_service_level, 6) AS cycle_service_level, round(on_hand / NULLIF(sales / days * 7, 0), 6) AS weeks_of_cover,
       round(sales / NULLIF(mean_stock, 0), 6) AS turnover
FROM (SELECT {K3}, count(*) AS days, count_if(stockout) AS n_out, sum(sales) AS sales, sum(on_hand) / count(*) AS mean_stock,
             arg_max(on_hand, day) AS on_hand FROM dense GROUP BY ALL) d
JOIN (SELECT {K3}, 1 - avg(had_out) AS cycle_service_level FROM (
        SELECT {K3}, cycle, max(CAST(stockout AS INTEGER)) AS had_out FROM dense GROUP BY ALL) x GROUP BY ALL) c USING ({K3})
JOIN (SELECT {K3}, sum(demand_v1) AS demand_v1 FROM uncon GROUP BY ALL) u USING ({K3})""", "dense", "uncon"))
def h17(spark, sf_dir):
    return un.service_kpis(_mov(spark, sf_dir))


@query("h18_forecast_error", with_ctes("""SELECT company, item_code, round(avg(f - qty), 6) AS bias,
  round(avg(CASE WHEN qty > 0 THEN abs(f - qty) / qty END), 6) AS mape,
  round(sum(abs(f - qty)) / NULLIF(sum(qty), 0), 6) AS wmape, round(avg(abs(f - qty)) / NULLIF(avg(naive_err), 0), 6) AS mase
FROM (SELECT *, avg(qty) OVER (PARTITION BY company, item_code ORDER BY p ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS f,
             abs(qty - lag(qty) OVER (PARTITION BY company, item_code ORDER BY p)) AS naive_err FROM series) s
WHERE f IS NOT NULL GROUP BY ALL""", "series"))
def h18(spark, sf_dir):
    return dm.forecast_error(dm.moving_average_forecast(dm.demand_arrays(_mov(spark, sf_dir))))


_H19_EMPTY = "'z': NULL::DOUBLE, 'x': NULL::DOUBLE, 'q': 1.0e0, 'd': NULL::DOUBLE"
_H19_FOLD = f"""list_reduce(list_prepend({{'v': 0.0e0, {_H19_EMPTY}}}, list({{'v': qty, {_H19_EMPTY}}} ORDER BY p)), lambda a, e: {{
  'v': 0.0e0,
  'z': CASE WHEN e.v > 0 THEN CASE WHEN a.z IS NULL THEN e.v ELSE a.z + 0.1e0 * (e.v - a.z) END ELSE a.z END,
  'x': CASE WHEN e.v > 0 THEN CASE WHEN a.x IS NULL THEN a.q ELSE a.x + 0.1e0 * (a.q - a.x) END ELSE a.x END,
  'q': CASE WHEN e.v > 0 THEN 1.0e0 ELSE a.q + 1 END,
  'd': CASE WHEN a.d IS NULL THEN CASE WHEN e.v > 0 THEN 1.0e0 ELSE 0.0e0 END
            ELSE a.d + 0.1e0 * (CASE WHEN e.v > 0 THEN 1.0e0 ELSE 0.0e0 END - a.d) END}})"""


@query("h19_croston_sba_tsb", with_ctes(f"""
SELECT company, item_code, round(t.z / t.x, 6) AS croston, round(t.z / t.x * 0.95e0, 6) AS sba, round(t.d * t.z, 6) AS tsb,
       t.q - 1 > 2 * t.x AS obsolete, round(CASE WHEN t.q - 1 > 2 * t.x THEN t.d * t.z ELSE t.z / t.x * 0.95e0 END, 6) AS hybrid
FROM (SELECT company, item_code, {_H19_FOLD} AS t FROM series GROUP BY ALL) s""", "series"))
def h19(spark, sf_dir):
    return fc.croston_family(dm.demand_arrays(_mov(spark, sf_dir)))


@query("h20_ses_holt", with_ctes("""
SELECT company, item_code, round(t.l, 6) AS ses, round(t.hl + t.hb, 6) AS holt
FROM (SELECT company, item_code, list_reduce(
        list_prepend({'y': 0.0e0, 'l': NULL::DOUBLE, 'hl': NULL::DOUBLE, 'hb': NULL::DOUBLE},
                     list({'y': qty, 'l': NULL::DOUBLE, 'hl': NULL::DOUBLE, 'hb': NULL::DOUBLE} ORDER BY p)),
        lambda a, e: {'y': 0.0e0, 'l': CASE WHEN a.l IS NULL THEN e.y ELSE a.l + 0.3e0 * (e.y - a.l) END,
          'hl': CASE WHEN a.l IS NULL THEN e.y ELSE 0.3e0 * e.y + 0.7e0 * (a.hl + a.hb) END,
          'hb': CASE WHEN a.l IS NULL THEN 0.0e0 ELSE 0.1e0 * (0.3e0 * e.y + 0.7e0 * (a.hl + a.hb) - a.hl) + 0.9e0 * a.hb END}) AS t
      FROM series GROUP BY ALL) s""", "series"))
def h20(spark, sf_dir):
    return fc.ses_holt(dm.demand_arrays(_mov(spark, sf_dir))).drop("periods", "ses_one_step")


@query("h21_holt_winters", with_ctes("""
SELECT company, item_code, round(COALESCE(l, m) + 1e-9, 4) AS level, round(COALESCE(b, 0.0e0) + 1e-9, 4) AS trend,
  round(COALESCE(l + b + s[1], m) + 1e-9, 4) AS forecast_next, round(e + 1e-9, 4) AS sse,
  round(CASE WHEN n >= 26 THEN (xl + xb) * xs[1] ELSE m END + 1e-9, 4) AS forecast_next_mul, round(xe + 1e-9, 4) AS sse_mul
FROM hw_items LEFT JOIN (SELECT * FROM hw WHERE t = n) h USING (company, item_code, n)""", "series28").replace(
    "WITH ", "WITH RECURSIVE ", 1).replace("\nSELECT company, item_code, round(COALESCE(l, m)", """,
hw_y AS (SELECT company, item_code, qty AS y, row_number() OVER (PARTITION BY company, item_code ORDER BY p) - 1 AS t FROM series28),
hw_items AS (SELECT company, item_code, count(*) AS n, sum(y) / count(*) AS m, list_sum(list(y ORDER BY t)[1:13]) / 13 AS f,
    list_sum(list(y ORDER BY t)[14:26]) / 13 AS f2, list(y ORDER BY t)[1:13] AS c FROM hw_y GROUP BY ALL),
hw(company, item_code, n, t, l, b, s, e, xl, xb, xs, xe) AS (
  SELECT company, item_code, n, CAST(0 AS BIGINT), f, (f2 - f) / 13, list_transform(c, lambda y: y - f), 0.0e0,
    CASE WHEN f > 0 THEN f END, CASE WHEN f > 0 THEN (f2 - f) / 13 END, CASE WHEN f > 0 THEN list_transform(c, lambda y: y / f) END, CASE WHEN f > 0 THEN 0.0e0 END
  FROM hw_items WHERE n >= 26
  UNION ALL
  SELECT company, item_code, n, t + 1, v, 0.05e0 * (v - l) + (1 - 0.05e0) * b, s[2:13] || [0.2e0 * (y - v) + (1 - 0.2e0) * s[1]], e + (y - (l + b + s[1])) * (y - (l + b + s[1])),
    xv, 0.05e0 * (xv - xl) + (1 - 0.05e0) * xb,
    CASE WHEN xl IS NOT NULL THEN xs[2:13] || [0.2e0 * (CASE WHEN xv > 0 THEN y / xv ELSE xs[1] END) + (1 - 0.2e0) * xs[1]] END,
    xe + (y - (xl + xb) * xs[1]) * (y - (xl + xb) * xs[1])
  FROM (SELECT hw.*, hw_y.y, 0.3e0 * (y - s[1]) + (1 - 0.3e0) * (l + b) AS v,
          0.3e0 * (CASE WHEN xs[1] > 0 THEN y / xs[1] ELSE xl + xb END) + (1 - 0.3e0) * (xl + xb) AS xv
        FROM hw JOIN hw_y USING (company, item_code, t)) z)
SELECT company, item_code, round(COALESCE(l, m)""", 1))
def h21(spark, sf_dir):
    return _rounded(fc.holt_winters(dm.demand_arrays(_mov(spark, sf_dir), grain_days=28), m=13),
                    ["level", "trend", "forecast_next", "sse", "forecast_next_mul", "sse_mul"])


@query("h22_fourier_regression", with_ctes("""
SELECT company, item_code, round(m[7] + m[14] * (first - fin) / 52 + 1e-9, 4) AS intercept, round(m[14] / 52 + 1e-9, 4) AS slope,
  round(m[21] + 1e-9, 4) AS sin_1, round(m[28] + 1e-9, 4) AS cos_1, round(m[35] + 1e-9, 4) AS sin_2, round(m[42] + 1e-9, 4) AS cos_2,
  round(m[7] + m[14] * (last + 1 - fin) / 52 + m[21] * sin(2 * pi() / 52 * (last + 1)) + m[28] * cos(2 * pi() / 52 * (last + 1))
        + m[35] * sin(4 * pi() / 52 * (last + 1)) + m[42] * cos(4 * pi() / 52 * (last + 1)) + 1e-9, 4) AS forecast_next,
  round(CASE WHEN syy - sy * sy / n > 1e-9 * syy THEN (m[7] * m0[7] + m[14] * m0[14] + m[21] * m0[21] + m[28] * m0[28] + m[35] * m0[35] + m[42] * m0[42]
        - sy * sy / n) / (syy - sy * sy / n) END + 1e-9, 4) AS r2, n
FROM gauss WHERE k = 6""", "series").replace("WITH ", "WITH RECURSIVE ", 1).replace("\nSELECT company, item_code, round(m[7]", """,
fx AS (SELECT company, item_code, p, CAST(qty AS DOUBLE) AS y, max(p) OVER () AS fin,
    [1.0e0, (p - max(p) OVER ()) / 52.0e0, sin(2 * pi() / 52 * p), cos(2 * pi() / 52 * p), sin(4 * pi() / 52 * p), cos(4 * pi() / 52 * p), CAST(qty AS DOUBLE)] AS x FROM series),
fl AS (SELECT company, item_code, p, y, fin, unnest(range(42)) AS i, x FROM fx),
fs AS (SELECT company, item_code, i, sum(x[i // 7 + 1] * x[i % 7 + 1]) AS v FROM fl GROUP BY ALL),
fm AS (SELECT company, item_code, list(v ORDER BY i) AS m FROM fs GROUP BY ALL),
gauss(company, item_code, k, m, m0, n, first, last, fin, sy, syy) AS (
  SELECT company, item_code, 0, CASE WHEN n >= 6 THEN m END, m, n, first, last, fin, sy, syy FROM fm JOIN (
    SELECT company, item_code, count(*) AS n, min(p) AS first, max(p) AS last, max(fin) AS fin, sum(y) AS sy, sum(y * y) AS syy FROM fx GROUP BY ALL) USING (company, item_code)
  UNION ALL
  SELECT company, item_code, k + 1, CASE WHEN m[k * 8 + 1] > m0[k * 8 + 1] * 1e-9 THEN list_transform(range(42), lambda i: CASE WHEN i // 7 = k THEN m[k * 7 + i % 7 + 1] / m[k * 8 + 1]
      ELSE m[i + 1] - m[(i // 7) * 7 + k + 1] * (m[k * 7 + i % 7 + 1] / m[k * 8 + 1]) END) END, m0, n, first, last, fin, sy, syy FROM gauss WHERE k < 6)
SELECT company, item_code, round(m[7]""", 1))
def h22(spark, sf_dir):
    x = fc.fourier_regression(_series(spark, sf_dir))
    names = ["sin_1", "cos_1", "sin_2", "cos_2"]
    x = x.withColumns({c: F.get("harmonics", F.lit(i)) for i, c in enumerate(names)}).drop("harmonics")
    return _rounded(x, ["intercept", "slope", *names, "forecast_next", "r2"])


_CAT = f"p_brand AS category, {sql_item_code('p_partkey')} AS item_code"


@query("h23_seasonal_index", with_ctes(f"""SELECT w.category, w.r_week, round(w.week_mean / t.mean, 6) AS seasonal_index
FROM (SELECT category, r_week, avg(qty) AS week_mean FROM sc GROUP BY ALL) w
JOIN (SELECT category, avg(qty) AS mean FROM sc GROUP BY ALL) t USING (category)""", "series").replace(
    "\nSELECT w.category", f""",
sc AS (SELECT s.*, c.category, CAST(((s.p % 52) + 52) % 52 + 1 AS INTEGER) AS r_week FROM series s
       JOIN (SELECT {_CAT} FROM part) c USING (item_code))
SELECT w.category""", 1))
def h23(spark, sf_dir):
    return dm.seasonal_index(_series(spark, sf_dir), _part(spark, sf_dir))


@query("h24_quantile_forecast", with_ctes(f"""SELECT category, r_week, quantile_cont(qty, 0.5) AS q50,
  quantile_cont(qty, 0.9) AS q90 FROM sc GROUP BY ALL""", "series").replace("\nSELECT category", f""",
sc AS (SELECT s.*, c.category, CAST(((s.p % 52) + 52) % 52 + 1 AS INTEGER) AS r_week FROM series s
       JOIN (SELECT {_CAT} FROM part) c USING (item_code))
SELECT category""", 1))
def h24(spark, sf_dir):
    return dm.quantile_forecast(_series(spark, sf_dir), _part(spark, sf_dir))


@query("h25_unconstrain_em")
def h25(spark, sf_dir):
    return un.unconstrain_fits(_mov(spark, sf_dir), with_pd=False).drop("demand_pd", "demand_proportional")


@query("h26_unconstrain_pd")
def h26(spark, sf_dir):
    return un.unconstrain_fits(_mov(spark, sf_dir)).drop("method", "mu", "sigma", "demand_em")


@query("h27_kde_safety_stock")
def h27(spark, sf_dir):
    return fc.kde_safety_stock(_ltd(spark, sf_dir))


@query("h28_cold_start", with_ctes(f"""
SELECT n.company, n.item_code, n.periods,
  round(COALESCE(bt.q * n.px / bt.px, b.q * n.px / b.px, t.q * n.px / t.px, a.q), 6) AS analog_weekly_qty,
  CASE WHEN bt.q IS NOT NULL THEN 'brand+type' WHEN b.q IS NOT NULL THEN 'brand' WHEN t.q IS NOT NULL THEN 'type'
       WHEN a.q IS NOT NULL THEN 'all' END AS analog_level,
  round(COALESCE(r.icept + r.slope * n.px, b.q, a.q), 6) AS attribute_weekly_qty
FROM (SELECT * FROM st WHERE periods < 13) n
LEFT JOIN (SELECT p_brand, p_type, avg(mean_qty) AS q, avg(px) AS px FROM st WHERE periods >= 13 GROUP BY ALL) bt
  ON n.p_brand = bt.p_brand AND n.p_type = bt.p_type
LEFT JOIN (SELECT p_brand, avg(mean_qty) AS q, avg(px) AS px FROM st WHERE periods >= 13 GROUP BY ALL) b ON n.p_brand = b.p_brand
LEFT JOIN (SELECT p_type, avg(mean_qty) AS q, avg(px) AS px FROM st WHERE periods >= 13 GROUP BY ALL) t ON n.p_type = t.p_type
LEFT JOIN (SELECT p_brand, regr_slope(mean_qty, px) AS slope, regr_intercept(mean_qty, px) AS icept FROM st WHERE periods >= 13 GROUP BY ALL) r
  ON n.p_brand = r.p_brand
LEFT JOIN (SELECT avg(mean_qty) AS q FROM st WHERE periods >= 13) a ON true""",
    "series").replace("\nSELECT n.company", f""",
snew AS (SELECT * FROM series WHERE CAST(item_code AS BIGINT) % 41 <> 0 OR p > (SELECT max(p) FROM series) - 10),
st AS (SELECT s.company, s.item_code, count(*) AS periods, avg(qty) AS mean_qty, any_value(p.p_brand) AS p_brand,
              any_value(p.p_type) AS p_type, any_value(p.p_retailprice) AS px
       FROM snew s JOIN (SELECT {sql_item_code('p_partkey')} AS item_code, p_brand, p_type, p_retailprice FROM part) p
       USING (item_code) GROUP BY s.company, s.item_code)
SELECT n.company""", 1))
def h28(spark, sf_dir):
    return rp.cold_start(fx.with_new_items(_series(spark, sf_dir)), _part(spark, sf_dir))


_ANALOGS = f"""
snew AS (SELECT * FROM series WHERE CAST(item_code AS BIGINT) % 41 <> 0 OR p > (SELECT max(p) FROM series) - 10),
st AS (SELECT s.company, s.item_code, count(*) AS periods, any_value(p.p_brand) AS brand, any_value(p.p_type) AS type, any_value(p.p_retailprice) AS px
       FROM snew s JOIN (SELECT {sql_item_code('p_partkey')} AS item_code, p_brand, p_type, p_retailprice FROM part) p
       USING (item_code) GROUP BY s.company, s.item_code),
analogs AS (SELECT * FROM (SELECT n.company, n.item_code, e.item_code AS analog, e.px AS analog_px, n.px,
      CASE WHEN n.brand = e.brand THEN 0 ELSE 1 END + CASE WHEN n.type = e.type THEN 0 ELSE 1 END + abs(n.px - e.px) / greatest(n.px, e.px) AS distance
    FROM st n JOIN st e ON n.company = e.company WHERE n.periods < 13 AND e.periods >= 13) c
  QUALIFY row_number() OVER (PARTITION BY company, item_code ORDER BY distance, analog) <= 5)"""


@query("h28_ranked_analogs", with_ctes("""SELECT a.company, a.item_code, CAST(row_number() OVER (PARTITION BY a.company, a.item_code ORDER BY distance, analog) AS INTEGER) AS rank,
  analog, round(distance, 6) AS distance FROM analogs a""", "series").replace("\nSELECT a.company", f",{_ANALOGS}\nSELECT a.company", 1))
def h28_analogs(spark, sf_dir):
    return an.ranked_analogs(an.item_stats(fx.with_new_items(_series(spark, sf_dir)), _part(spark, sf_dir)), k=5).withColumn("distance", F.round("distance", 6)).drop(
        "analog_price", "price")


@query("h28_analog_profile", with_ctes("""SELECT a.company, a.item_code, w.r_week, round(sum(w.qty * a.px / a.analog_px / (1 + a.distance)) / sum(1 / (1 + a.distance)), 6) AS qty
FROM analogs a JOIN (SELECT company, item_code, CAST(((p % 52) + 52) % 52 + 1 AS INTEGER) AS r_week, avg(qty) AS qty FROM snew GROUP BY ALL) w
  ON w.company = a.company AND w.item_code = a.analog GROUP BY ALL""", "series").replace("\nSELECT a.company", f",{_ANALOGS}\nSELECT a.company", 1))
def h28_profile(spark, sf_dir):
    return an.analog_profile(fx.with_new_items(_series(spark, sf_dir)), _part(spark, sf_dir), k=5)


@query("h28_attribute_model", with_ctes("""SELECT n.company, n.item_code, season, true AS has_forecast
FROM st n, (SELECT CAST(unnest(range(1, 5)) AS VARCHAR) AS season) q WHERE n.periods < 13""", "series").replace("\nSELECT n.company", f",{_ANALOGS}\nSELECT n.company", 1))
def h28_model(spark, sf_dir):
    """Every new item has a forecast for each season; the values are held to held-out items in the tests."""
    done = an.attribute_forecast(fx.with_new_items(_series(spark, sf_dir)), _part(spark, sf_dir))
    return done.select("company", "item_code", "season", (F.col("attribute_weekly_qty").isNotNull() & ~F.isnan("attribute_weekly_qty")).alias("has_forecast"))


@query("h29_newsvendor", with_ctes(
    "SELECT company, item_code, quantile_cont(qty, 0.75) AS order_up_to FROM series GROUP BY ALL", "series"))
def h29(spark, sf_dir):
    return rp.newsvendor(_series(spark, sf_dir), cu=3.0, co=1.0)


@query("h29_newsvendor_by_origin", with_ctes("""
SELECT company, item_code, fraction,
  round(v[CAST(floor((len(v) - 1) * fraction) AS INTEGER) + 1] + ((len(v) - 1) * fraction - floor((len(v) - 1) * fraction))
        * (v[CAST(ceil((len(v) - 1) * fraction) AS INTEGER) + 1] - v[CAST(floor((len(v) - 1) * fraction) AS INTEGER) + 1]), 6)
    AS order_up_to
FROM (SELECT company, item_code, list_sort(list(qty)) AS v FROM series GROUP BY ALL) s
JOIN (SELECT item_code, CASE origin WHEN 'NACIONAL' THEN 0.8e0 WHEN 'USA' THEN 0.85e0 ELSE 0.9e0 END AS fraction FROM priors) f
USING (item_code)""", "series", "priors"))
def h29g(spark, sf_dir):
    arrays = dm.demand_arrays(_mov(spark, sf_dir)).filter("q is not null")
    o = F.col("origin")
    frac = _priors(spark, sf_dir).select(
        "item_code", F.when(o == "NACIONAL", 0.8).when(o == "USA", 0.85).otherwise(0.9).alias("fraction"))
    # an item with several origins has its demand as often
    times = frac.groupBy("item_code").agg(F.count("*").cast("int").alias("n"))
    demand = arrays.join(times, "item_code").withColumn("q", F.flatten(F.array_repeat("q", F.col("n"))))
    return rp.newsvendor_by_group(demand, frac.join(arrays.select("company", "item_code"), "item_code"))


@query("h30_open_to_buy", with_ctes(f"""
SELECT k.category, r_year, r_period, planned, target_close, opening, on_order,
  round(planned + target_close - opening - on_order, 2) AS open_to_buy,
  CAST(DATE '2026-02-01' + CAST((r_year - 2026) * 364 + (fw - 1) * 7 AS INTEGER) - lead_days AS DATE) AS release_date
FROM (SELECT *, lead(planned) OVER (PARTITION BY category ORDER BY r_year, r_period) * 1 AS target_close FROM (
        SELECT *, COALESCE(sum(net) OVER (PARTITION BY category ORDER BY r_year, r_period
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0e0) AS opening,
               lag(sales) OVER (PARTITION BY category, r_period ORDER BY r_year) AS planned,
               CAST((((r_period - 1) // 3) * 13 + CASE (r_period - 1) % 3 WHEN 0 THEN 0 WHEN 1 THEN 4 ELSE 9 END + 1) AS INTEGER) AS fw
        FROM (SELECT c.category, CAST({sql_retail_year('doc_date')} AS INTEGER) AS r_year, {_RP} AS r_period,
                     sum(CASE WHEN trans_type IN (13, 15) THEN out_qty ELSE 0.0e0 END) AS sales,
                     sum(CASE WHEN trans_type = 20 AND {sql_retail_year('create_date')} * 12 + {sql_period_of_week(sql_retail_week('create_date'))}
                              < {sql_retail_year('doc_date')} * 12 + {_RP} THEN in_qty ELSE 0.0e0 END) AS on_order,
                     sum(in_qty - out_qty) AS net
              FROM mov m JOIN (SELECT {_CAT} FROM part) c USING (item_code) GROUP BY ALL) g) h) k
JOIN (SELECT category, CAST(ceil(avg(lt_days)) AS INTEGER) AS lead_days FROM priors JOIN (SELECT {_CAT} FROM part) c USING (item_code) GROUP BY ALL) l
  ON k.category = l.category
WHERE planned IS NOT NULL AND target_close IS NOT NULL""", "mov", "priors"))
def h30(spark, sf_dir):
    return rp.open_to_buy(_mov(spark, sf_dir), _part(spark, sf_dir), _priors(spark, sf_dir))


@query("h31_allocate", with_ctes("""
SELECT company, item_code, warehouse, demand, dc_qty,
  CAST(base + CASE WHEN base < demand AND r <= remainder THEN 1 ELSE 0 END AS BIGINT) AS allocated
FROM (SELECT *, least(dc_qty, total) - sum(base) OVER (PARTITION BY company, item_code) AS remainder,
             row_number() OVER (PARTITION BY company, item_code, base < demand ORDER BY frac DESC, warehouse ASC) AS r
      FROM (SELECT *, least(CAST(floor(dc_qty * demand / total) AS BIGINT), demand) AS base,
                   dc_qty * demand / total - floor(dc_qty * demand / total) AS frac
            FROM (SELECT d.*, dc.dc_qty, sum(demand) OVER (PARTITION BY d.company, d.item_code) AS total
                  FROM (SELECT company, item_code, warehouse, CAST(floor(sum(out_qty)) AS BIGINT) AS demand FROM mov
                        WHERE trans_type IN (13, 15) AND warehouse <> 'A00' GROUP BY ALL) d
                  JOIN (SELECT company, item_code, CAST(greatest(floor(sum(in_qty - out_qty)), 0) AS BIGINT) AS dc_qty
                        FROM mov WHERE warehouse = 'A00' GROUP BY ALL) dc USING (company, item_code)
                  WHERE d.demand > 0) a) b) c""", "mov"))
def h31(spark, sf_dir):
    return rp.allocate(_mov(spark, sf_dir))


@query("h32_two_stage", with_ctes("""
SELECT company, item_code, CAST(t.n AS INTEGER) AS periods, round(t.er / t.n + 1e-9, 6) AS bias_raw, round(t.ea / t.n + 1e-9, 6) AS bias_unconstrained,
       round(t.ar / NULLIF(t.y, 0) + 1e-9, 6) AS wmape_raw, round(t.aa / NULLIF(t.y, 0) + 1e-9, 6) AS wmape_unconstrained
FROM (SELECT company, item_code, list_reduce(
        list_prepend({'raw': 0.0e0, 'adj': 0.0e0, 'o': 0.0e0, 'lr': NULL::DOUBLE, 'la': NULL::DOUBLE, 'n': 0.0e0, 'er': 0.0e0, 'ea': 0.0e0, 'ar': 0.0e0, 'aa': 0.0e0, 'y': 0.0e0},
          list({'raw': raw, 'adj': adj, 'o': o, 'lr': NULL::DOUBLE, 'la': NULL::DOUBLE, 'n': 0.0e0, 'er': 0.0e0, 'ea': 0.0e0, 'ar': 0.0e0, 'aa': 0.0e0, 'y': 0.0e0} ORDER BY p)),
        lambda a, e: {'raw': 0.0e0, 'adj': 0.0e0, 'o': 0.0e0,
          'lr': CASE WHEN a.lr IS NULL THEN e.raw ELSE a.lr + 0.3e0 * (e.raw - a.lr) END,
          'la': CASE WHEN a.la IS NULL THEN e.adj ELSE a.la + 0.3e0 * (e.adj - a.la) END,
          'n': a.n + CASE WHEN a.lr IS NOT NULL AND e.o = 0 THEN 1.0e0 ELSE 0.0e0 END,
          'er': a.er + CASE WHEN a.lr IS NOT NULL AND e.o = 0 THEN a.lr - e.raw ELSE 0.0e0 END,
          'ea': a.ea + CASE WHEN a.lr IS NOT NULL AND e.o = 0 THEN a.la - e.raw ELSE 0.0e0 END,
          'ar': a.ar + CASE WHEN a.lr IS NOT NULL AND e.o = 0 THEN abs(a.lr - e.raw) ELSE 0.0e0 END,
          'aa': a.aa + CASE WHEN a.lr IS NOT NULL AND e.o = 0 THEN abs(a.la - e.raw) ELSE 0.0e0 END,
          'y': a.y + CASE WHEN a.lr IS NOT NULL AND e.o = 0 THEN e.raw ELSE 0.0e0 END}) AS t
      FROM (SELECT company, item_code, r_year * 12 + r_period - 1 AS p, sum(demand_leave) AS raw, sum(demand_v1) AS adj,
                   CAST(sum(stockout_days) AS DOUBLE) AS o FROM uncon GROUP BY ALL) u GROUP BY company, item_code) s
WHERE t.n > 0""", "uncon"))
def h32(spark, sf_dir):
    return un.two_stage(_mov(spark, sf_dir))


@query("h33_decompose", with_ctes("""SELECT company, item_code, p, qty, round(trend, 6) AS trend, round(seasonal, 6) AS seasonal,
  round(qty - trend - seasonal, 6) AS residual
FROM (SELECT *, avg(qty - trend) OVER (PARTITION BY company, item_code, pos) AS seasonal FROM (
  SELECT *, CASE WHEN count(qty) OVER w = 13 THEN avg(qty) OVER w END AS trend, ((p % 13) + 13) % 13 AS pos
  FROM series WINDOW w AS (PARTITION BY company, item_code ORDER BY p ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)) a) b""",
    "series"))
def h33(spark, sf_dir):
    return dm.decompose(dm.demand_arrays(_mov(spark, sf_dir)))


@query("h33_stl", with_ctes("""SELECT company, item_code, p, qty, round(qty + 1e-9, 6) AS recomposed, true AS weight_ok FROM series28""", "series28"))
def h33_stl(spark, sf_dir):
    """The parts add up to the series at every period; their values are held to planted ones in the tests."""
    x = sm.stl(dm.demand_arrays(_mov(spark, sf_dir), grain_days=28), period=13)
    return x.select("company", "item_code", "p", "qty", F.round(F.col("trend") + F.col("seasonal") + F.col("remainder") + 1e-9, 6).alias("recomposed"),
                    F.col("weight").between(0, 1).alias("weight_ok"))


@query("h34_preseason_split", with_ctes(f"""SELECT company, item_code, r_year, r_quarter, plan,
  round(least(lt_days / 91, 1.0e0), 6) AS preseason_share, round(plan * least(lt_days / 91, 1.0e0), 6) AS preseason_qty,
  round(plan * (1 - least(lt_days / 91, 1.0e0)), 6) AS in_season_qty
FROM (SELECT company, item_code, CAST(2026 + {fdiv('p', 52)} AS INTEGER) AS r_year,
             CAST((((p % 52) + 52) % 52) // 13 + 1 AS INTEGER) AS r_quarter, sum(qty) AS plan FROM series GROUP BY ALL) g
JOIN priors USING (item_code)""", "series", "priors"))
def h34(spark, sf_dir):
    return rp.preseason_split(_series(spark, sf_dir), _priors(spark, sf_dir))
