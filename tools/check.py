"""Run every query (or the named ones) beside its SQL: python tools/check.py [folder] [name ...]"""

import sys
import time
import traceback
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent.parent / "tests")]

from compare import connect, difference

import querybook
from gradewell.session import session

folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:]
spark = session(**{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                   "spark.driver.memory": "12g"})
spark.sparkContext.setLogLevel("ERROR")
con = connect(folder)
sqls = querybook.oracle_sql()
bad = 0
for name, query in querybook.queries().items():
    if names and name not in names:
        continue
    start = time.time()
    try:
        got = query(spark, folder).toPandas()
        took = time.time() - start
        if name in sqls:
            want = con.execute(sqls[name]).df()
            diff = difference(got, want)
            state = "ok" if diff is None else f"DIFF {diff}"
        else:
            state = "rows only"
    except Exception as error:
        state, got, took = f"ERROR {str(error)[:1500]}", [], time.time() - start
        if names:
            traceback.print_exc()
    bad += not state.startswith(("ok", "rows"))
    print(f"{name:28s} {len(got):7d} {took:6.2f}s {state}", flush=True)
print("bad:", bad)
