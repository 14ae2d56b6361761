"""Jobs run from a folder in which the executors cannot import the package."""

import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
import __spark_entry__ as driver
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
for name in ("archive_scan", "manifest", "script_files"):
    assert driver.queries()[name](spark, sys.argv[2]).count() > 0
print("all right")
"""


def test_package_travels_with_the_job(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    command = [sys.executable, "-c", SCRIPT, root, "/root/testdata/sf0.001"]
    done = subprocess.run(command, cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "all right" in done.stdout, done.stderr[-2000:]
