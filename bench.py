"""Headline benchmark: prints one JSON line with per-query wall seconds.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query's result is fully materialised with a no-op sink (``write.format("noop")``), so the
whole plan runs without collecting rows to the driver.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stockflow.plans.catalog import QUERIES, load_all  # noqa: E402
from stockflow.session import build_session  # noqa: E402

HEADLINE = [
    "d4_reconcile",            # golden reconciliation (flagship)
    "e1_on_hand",
    "f1_running_on_hand",
    "f2_on_hand_before_movement",
    "d6_activity_during",      # bucketed interval join
    "h1_sales_history",
    "h2_stockout_days",
    "h6_adi_cv2",
    "h4_unconstrain_v1",       # calendar days without writing them out
    "h8_abc_by_period",
    "h12_reorder_point",
    "h15_reorder_report",
    "h19_croston_sba_tsb",
    "h21_holt_winters",        # per-key fits
    "h22_fourier_regression",
    "h25_unconstrain_em",
    "g1_fold_runs",
    "f6_seek_union",
    "a6_replace_window",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    load_all()
    spark = build_session(f"local[{cpus}]", cpus)
    # warm-up: JVM, parquet footers, code generation
    QUERIES["e2_watermark"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        t = time.time()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total_wall", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else None, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
