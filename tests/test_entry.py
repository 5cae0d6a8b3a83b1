"""The entry module in foreign surroundings: missing optional libraries, plain sessions."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(code: str, cwd) -> str:
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=cwd, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
    return done.stdout.strip().splitlines()[-1]


def test_a_missing_optional_library_takes_no_other_query_with_it(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
for name in ("tokenizers", "sentencepiece", "zstandard", "regex"):
    sys.modules[name] = None  # importing it fails
import __spark_entry__ as e
names = set(e.queries())
print(len(names), len([n for n in names if n[:2] == "op" and n[2].isdigit()]), set(e.oracle_sql()) <= names)
"""
    count, own, sql = run(code, tmp_path).split()
    assert int(count) >= 184 and own == "0" and sql == "True"


def test_python_workers_find_the_package_in_a_plain_session(tmp_path):
    code = f"""
import importlib.util, sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
    "spark.checkpoint.dir", {str(tmp_path)!r} + "/ckpt").config("spark.sql.shuffle.partitions", "4").getOrCreate()
spec = importlib.util.spec_from_file_location("entry", {ROOT!r} + "/__spark_entry__.py")
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
print(entry.queries()["ts.backtest_signal"](spark, "/root/testdata/sf0.001").count() > 0)
"""
    assert run(code, tmp_path) == "True"
