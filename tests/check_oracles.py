"""Run every registered query on Spark and its oracle SQL on DuckDB; print a
verdict per query. Usage: python tests/check_oracles.py [sf_dir] [name ...]"""

import sys
import time

sys.path.insert(0, "/root/repo")

from sparklab.plans.compare import compare, duckdb_connection  # noqa: E402
from sparklab.session import get_session  # noqa: E402
import __spark_entry__ as E  # noqa: E402

sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
only = sys.argv[2:]
spark = get_session("local[8]", 8)
con = duckdb_connection(sf_dir)
qs, sqls = E.queries(), E.oracle_sql()
bad = 0
for name, fn in qs.items():
    if only and not any(name.startswith(o) for o in only):
        continue
    t0 = time.time()
    try:
        pdf = fn(spark, sf_dir).toPandas()
    except Exception as e:  # noqa: BLE001
        print(f"{name:28s} SPARK-ERROR {type(e).__name__}: {str(e)[:300]}")
        bad += 1
        continue
    t1 = time.time()
    if name not in sqls:
        print(f"{name:28s} rows={len(pdf)} (no oracle) {t1 - t0:.1f}s")
        continue
    try:
        dpdf = con.execute(sqls[name]).df()
    except Exception as e:  # noqa: BLE001
        print(f"{name:28s} DUCKDB-ERROR {type(e).__name__}: {str(e)[:300]}")
        bad += 1
        continue
    diff = compare(pdf, dpdf)
    status = "OK" if diff is None else "MISMATCH " + diff[:400]
    if diff:
        bad += 1
    print(f"{name:28s} rows={len(pdf):6d} {t1 - t0:5.1f}s {status}")
print("FAILED" if bad else "ALL OK", bad)
