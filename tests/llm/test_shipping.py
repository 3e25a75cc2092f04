"""The queries run wherever the driver was started: workers get the package from it."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_workers_find_the_package_from_another_folder(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", 2).getOrCreate()
import __spark_entry__ as entry
for name in ("op1_token_counts", "op3_maxscore", "op7_radix_dedup"):
    print(name, entry.queries()[name](spark, "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.stdout.split() == ["op1_token_counts", "200", "op3_maxscore", "50", "op7_radix_dedup", "200"], done.stderr[-2000:]
