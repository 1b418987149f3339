"""Time the DuckDB oracle SQL of every query (single-node reference point).
Usage: python scripts/bench_oracle.py [sf_dir]  -> one JSON line."""

import json
import os
import threading
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from itinera.plans.oracle import SQL  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
con = duckdb.connect()
con.execute("SET threads TO 8")
for t in TABLES:
    con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
LIMIT_S = float(os.environ.get("ORACLE_LIMIT_S", "30"))
out = {}
for name in sorted(SQL):
    runs = []
    for _ in range(3):
        timer = threading.Timer(LIMIT_S, con.interrupt)
        timer.start()
        t0 = time.perf_counter()
        try:
            con.execute(f"CREATE OR REPLACE TEMP TABLE _bench AS {SQL[name]}")
            runs.append(time.perf_counter() - t0)
        except Exception:  # interrupted: record as a lower bound
            runs = [f">{LIMIT_S:.0f}"]
            break
        finally:
            timer.cancel()
    out[name] = runs[0] if isinstance(runs[0], str) else round(statistics.median(runs), 3)
num = [v for v in out.values() if not isinstance(v, str)]
print(json.dumps({"engine": "duckdb", "sf": sf, "value_finished": round(sum(num), 3), "queries": out}))
