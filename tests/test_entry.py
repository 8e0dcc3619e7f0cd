"""The entry file from an unrelated folder: tasks run there without a copy of the package."""

import subprocess
import sys

SCRIPT = """
import sys
sys.path.append(sys.argv[1])
import __spark_entry__ as e
sys.path.remove(sys.argv[1])
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
for name in ("entity_review", "dense_topk"):
    assert e.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
print("done")
"""


def test_queries_run_from_another_folder(tmp_path):
    repo = __file__.rsplit("/tests/", 1)[0]
    run = subprocess.run([sys.executable, "-c", SCRIPT, repo], cwd=tmp_path, capture_output=True, text=True, timeout=300, check=False)
    assert run.stdout.endswith("done\n"), run.stderr[-2000:]
