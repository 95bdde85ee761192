"""The entry module must import without Spark's ML jar, and Python workers
must find the package wherever the job was started."""
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(code: str, cwd) -> str:
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=cwd, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout


def test_import_needs_no_files(tmp_path):
    code = f"""
import builtins, sys, zipfile
sys.path.insert(0, {REPO!r})
def no(*a, **b): raise AssertionError("a file lookup at import")
zipfile.ZipFile = no
import glob; glob.glob = no
import __spark_entry__ as e
assert len(e.queries()) >= 75 and len(e.oracle_sql()) >= 60
print("ok")
"""
    assert "ok" in run(code, tmp_path)


def test_workers_find_the_package(tmp_path):
    code = f"""
import sys
sys.path.append({REPO!r})
import __spark_entry__ as e
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
for name in ("rouge_l", "rouge_stemmed", "evaluate_model", "wordpiece"):
    assert e.queries()[name](spark, "/root/testdata/sf0.001").count() > 0, name
print("ok")
"""
    assert "ok" in run(code, tmp_path)
