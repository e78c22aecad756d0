"""Catalogue: movement journal, reconciliation."""

from __future__ import annotations

from stockflow.operators import reconcile as rc
from stockflow.plans.catalog import query
from stockflow.plans.oracle_sql import with_ctes
from stockflow.session import apply_session_conf
from stockflow.sources import fixtures as fx


def _prep(spark):
    apply_session_conf(spark)
    return spark


@query("d4_reconcile", with_ctes("""
SELECT COALESCE(r.company, s.company) AS company, COALESCE(r.item_code, s.item_code) AS item_code,
       COALESCE(r.warehouse, s.warehouse) AS warehouse, r.qty_recon, s.qty_sap,
       COALESCE(r.qty_recon, 0.0e0) - COALESCE(s.qty_sap, 0.0e0) AS diff
FROM (SELECT company, item_code, warehouse, SUM(in_qty - out_qty) AS qty_recon FROM mov GROUP BY ALL) r
FULL OUTER JOIN (SELECT company, item_code, warehouse, SUM(qty_sap) AS qty_sap FROM stock GROUP BY ALL) s
  ON r.company = s.company AND r.item_code = s.item_code AND r.warehouse = s.warehouse
WHERE abs(COALESCE(r.qty_recon, 0.0e0) - COALESCE(s.qty_sap, 0.0e0)) > 0.001""", "mov", "stock"))
def d4_reconcile(spark, sf_dir):
    _prep(spark)
    mov = rc.rolled_up(fx.movements(spark, sf_dir))
    return rc.reconcile(mov, fx.stock_snapshot(spark, sf_dir, mov))
