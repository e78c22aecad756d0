"""Run every catalogue query against its DuckDB twin: python tests/run_oracle.py [sf_dir] [names...]"""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_check import compare, duck_connect  # noqa: E402

from stockflow.plans.catalog import ORACLE, QUERIES, load_all  # noqa: E402
from stockflow.session import build_session  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    load_all()
    spark = build_session("local[8]", 8)
    con = duck_connect(sf_dir)
    bad = 0
    for name, fn in QUERIES.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in ORACLE:
                ok, msg = compare(df, con, ORACLE[name])
            else:
                n = df.count()
                ok, msg = True, f"rows-only {n}"
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:600]}"
            traceback.print_exc(limit=2)
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:32s} {time.time()-t:6.1f}s {msg}", flush=True)
    print(f"failures: {bad}")


if __name__ == "__main__":
    main()
