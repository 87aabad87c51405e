"""The driver contract works from any working directory (workers import the shipped package)."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("spark_entry", {os.path.join(REPO, "__spark_entry__.py")!r})
m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
n = m.queries()["folder_union_by_header"](spark, "/root/testdata/sf0.001").count()
print("ROWS", n)
"""


def test_queries_run_from_another_directory():
    cwd = tempfile.mkdtemp(prefix="md-elsewhere-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True,
                         timeout=600)
    assert "ROWS 150" in out.stdout, out.stderr[-2000:]


def test_scratch_folders_can_be_removed(spark):
    import os
    from urllib.parse import urlparse

    from medallion.session import remove_scratch, scratch_path

    remove_scratch(spark)
    path = scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    local = urlparse(path).path
    assert os.path.isdir(local)
    assert remove_scratch(spark) == 1 and not os.path.exists(local)
    assert remove_scratch(spark) == 0
