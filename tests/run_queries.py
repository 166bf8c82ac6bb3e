"""Run named queries against their SQL: python tests/run_queries.py FOLDER [module-or-key ...]"""

import importlib
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from compare import connect, differences  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from tallymark.catalog.registry import ORACLES, QUERIES  # noqa: E402

folder, wanted = sys.argv[1], sys.argv[2:]
modules = [w for w in wanted if w.startswith("q_")]
if modules:
    for module in modules:
        importlib.import_module(f"tallymark.catalog.{module}")
    keys = [k for k, f in QUERIES.items() if f.__module__.rsplit(".", 1)[1] in modules]
else:
    import __spark_entry__  # noqa: E402

    __spark_entry__.queries()
    keys = wanted or list(QUERIES)

spark = (
    SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
    .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "12g")
    .config("spark.ui.enabled", "false").getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
connection = connect(folder)
bad = []
for key in keys:
    start = time.time()
    try:
        df = QUERIES[key](spark, folder)
        if key in ORACLES:
            problem, n = differences(df, connection, ORACLES[key])
        else:
            problem, n = None, df.count()
    except Exception as error:  # noqa: BLE001
        problem, n = f"{type(error).__name__}: {str(error)[:700]}", -1
    mark = "ok  " if problem is None else "FAIL"
    print(f"{mark} {key} rows={n} {time.time() - start:.1f}s {problem or ''}", flush=True)
    if problem:
        bad.append(key)
print(f"{len(keys)} queries, {len(bad)} failing: {bad}")
