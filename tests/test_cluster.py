"""What must not depend on driver and tasks being one process."""

import os
import subprocess
import sys
from datetime import datetime
from pathlib import Path

from weir.sources import derby, jdbc

REPO = str(Path(__file__).resolve().parents[1])
RUN = """
import sys
from pyspark.sql import SparkSession
from weir.plans import registry
spark = SparkSession.builder.master("local-cluster[2,1,1024]").config("spark.executor.memory", "600m").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", f"file://{sys.argv[1]}").getOrCreate()
want = sorted(map(tuple, spark.read.parquet("/root/testdata/sf0.01/supplier.parquet").collect()))
for name, more in (("jdbc_round_trip", ()), ("jdbc_staged_load", (2,))):
    found = registry.queries()[name](spark, "/root/testdata/sf0.01").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal", *(["calls_that_loaded"] if more else []))
    assert sorted(map(tuple, found.collect())) == [w + more for w in want], name
print("as it should be")
"""


def test_databases_where_tasks_run_elsewhere(tmp_path):
    env = os.environ | {"PYTHONPATH": REPO, "PYSPARK_PYTHON": sys.executable, "PYSPARK_GATEWAY_PORT": ""}
    env.pop("PYSPARK_GATEWAY_PORT")
    done = subprocess.run([sys.executable, "-c", RUN, str(tmp_path / "shared")], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300, check=False)
    assert "as it should be" in done.stdout, done.stderr[-2000:]


def test_files_that_a_database_loads(spark):
    at = datetime(2024, 2, 29, 1, 2, 3, 456789)
    rows = [(1, 'a "b", c', 0.1, at), (2, "", -1e300, at), (3, None, None, None), (4, "  two\nlines  ", 1e-7, at), (5, "é\\", 0.0, at)]
    df = spark.createDataFrame(rows, "K long, S string, X double, T timestamp")
    url = derby.new_database(spark)
    jdbc.write_table(df.limit(0), url, "ODD", "overwrite", properties=derby.PROPERTIES)
    jdbc.write_table(df.repartition(3), url, "ODD", "append", properties=derby.PROPERTIES, expected=5, bulk=derby.IMPORT)
    assert [jdbc.load_once(df.limit(2), url, '"odd"', "r", derby.PROPERTIES) for _ in range(2)] == [True, False]
    found = jdbc.read_sharded(spark, derby.packed(spark, url), "ODD", "K", 2, derby.PROPERTIES)
    assert sorted(map(tuple, found.collect())) == rows
