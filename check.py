"""Run registered queries against their SQL and print what differs: python check.py [sf_dir] [names]"""

import sys
import time

from catalog import QUERIES, SQL
from gridtally.session import build_session, release_all
from tests.oracle import compare, duck

sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
wanted = sys.argv[2:]
spark = build_session("check", "local[8]", **{
    "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
spark.sparkContext.setLogLevel("ERROR")
con = duck(sf_dir)
bad = 0
for name, function in QUERIES.items():
    if wanted and not any(w in name for w in wanted):
        continue
    start = time.time()
    try:
        if name in SQL:
            found = compare(function(spark, sf_dir), con, SQL[name])
        else:
            rows = function(spark, sf_dir).collect()
            found = [] if rows else ["no rows"]
            print("   ", name, len(rows), rows[:2])
    except Exception as e:  # report and go on to the next query
        found = [f"{type(e).__name__}: {str(e)[:1500]}"]
    bad += bool(found)
    print(f"{'BAD' if found else 'ok '} {name} {time.time() - start:.1f}s", *found, sep="\n      " if found else " ", flush=True)
print("failed:", bad)
release_all(spark)
