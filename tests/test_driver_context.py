"""The entry file used the way an outside driver may use it: loaded by file
path from another working folder, with a plain session. Executor-side Python
(the workbook parser and writer) must work without the package installed
on the workers."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false").getOrCreate())
# Loaded by file path, without the repository on sys.path.
spec = importlib.util.spec_from_file_location("entry_mod", {REPO!r} + "/__spark_entry__.py")
E = importlib.util.module_from_spec(spec)
spec.loader.exec_module(E)
print("ROWS", E.queries()["workbook_roundtrip"](spark, "/root/testdata/sf0.001").count())
print("ENTRY", E.entry(spark).count() > 0)
"""


def test_workbook_query_from_another_folder():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    with tempfile.TemporaryDirectory() as cwd:
        out = subprocess.run(
            [sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True, timeout=600
        )
    assert out.returncode == 0, out.stderr[-2000:]
    assert "ROWS 10" in out.stdout and "ENTRY True" in out.stdout
