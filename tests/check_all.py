"""Run registered queries against the oracle: python tests/check_all.py [folder] [name ...]."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as entry
from compare import connect, differences
from musterline.session import build_session

folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:]
spark = build_session(
    "check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"}
)
spark.sparkContext.setLogLevel("ERROR")
con = connect(folder)
oracle = entry.oracle_sql()
bad = []
for name, query in entry.queries().items():
    if names and name not in names:
        continue
    start = time.time()
    try:
        df = query(spark, folder)
        if name in oracle:
            problems = differences(df, con, oracle[name])
        else:
            problems = []
            print(f"  {name}: {len(df.collect())} rows, no oracle")
    except Exception as e:  # report and go on
        problems = [f"{type(e).__name__}: {str(e)[:600]}"]
    print(f"{'ok ' if not problems else 'BAD'} {name} {time.time() - start:.2f}s", *problems, flush=True)
    if problems:
        bad.append(name)
print("unmatched oracle keys:", sorted(set(oracle) - set(entry.queries())))
print("bad:", bad)
