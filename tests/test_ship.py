"""Python jobs run from any working directory: workers get the package."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CODE = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate())
import __spark_entry__ as E
for name in ("fingerprint", "map_struct"):
    assert E.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
print("ran")
"""


def test_jobs_run_from_a_foreign_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert "ran" in out.stdout, out.stderr[-2000:]
