"""Executors do not need the package on their path."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
import __spark_entry__ as contract
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
q, sf = contract.queries(), "/root/testdata/sf0.001"
print("rows", contract.entry(spark).count(), q["row_mapper_python"](spark, sf).count(),
      q["sync_files"](spark, sf).count())
"""


def test_queries_run_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, text=True,
                         capture_output=True, timeout=300)
    counts = [line for line in out.stdout.splitlines() if line.startswith("rows")]
    assert counts and all(int(n) > 0 for n in counts[0].split()[1:]), out.stderr[-2000:]
