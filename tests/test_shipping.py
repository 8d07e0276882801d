"""The package reaches the executors of a driver that was started elsewhere."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROGRAM = """
import sys, tempfile
sys.path.append({root!r})
import __spark_entry__ as entry
from pyspark.sql import SparkSession
spark = (
    SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
    .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp")).getOrCreate()
)
print("rows", entry.queries()["decode_topic"](spark, "/root/testdata/sf0.001").count())
"""


def test_codecs_run_for_a_driver_started_elsewhere(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", PROGRAM.format(root=ROOT)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert int(done.stdout.split("rows")[1]) > 0
