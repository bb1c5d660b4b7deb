import os
import subprocess
import sys

from tests.conftest import ROOT

SCRIPT = """
from pyspark.sql import SparkSession
from readloom.operators.ranks import with_place
from readloom.sources.shared import ensure_checkpoints, new_path, shared_dir
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
folder = shared_dir(spark)
assert folder == shared_dir(spark) and new_path(spark, "x").startswith(folder + "/readloom/x-")
ensure_checkpoints(spark)
assert [r["rank"] for r in with_place(spark.range(3), "id").collect()] == [0, 1, 2] and shared_dir(spark) == folder
print("fine")
"""


def test_a_session_without_a_folder(tmp_path):
    """No ``spark.checkpoint.dir`` in a local session: one folder for all, found again."""
    env = os.environ | {"PYTHONPATH": ROOT, "TMPDIR": str(tmp_path)}
    out = subprocess.run([sys.executable, "-c", SCRIPT], capture_output=True, text=True, env=env, timeout=120, cwd=tmp_path)
    assert out.stdout.strip().endswith("fine"), out.stderr[-2000:]
