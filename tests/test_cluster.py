import os
import subprocess
import sys
from pathlib import Path

import pytest

from ratecraft import session

ROOT = Path(__file__).resolve().parents[1]
CODE = """
import importlib.util, sys
spec = importlib.util.spec_from_file_location("__spark_entry__", sys.argv[1])
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false")
         .getOrCreate())
print("rows", entry.queries()["met_14_content_serendipity"](spark, "/root/testdata/sf0.001").count())
"""


def test_kernels_run_from_another_folder(tmp_path):
    """The executors' Python gets the package from Spark, not from the working folder or a search path."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", CODE, str(ROOT / "__spark_entry__.py")], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=600)
    assert "rows 1" in out.stdout, out.stderr[-2000:]


class _Session:
    """What ``shared_folder`` looks at, of a cluster that names no folder."""

    class conf:
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:
        applicationId, master = "app-1", "spark://host:7077"


def test_a_cluster_must_name_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(_Session())


def test_stored_copies_can_be_dropped(spark):
    kept = session.stored_copy(spark.range(3))
    path = kept._stored_at
    assert kept.count() == 3 and session.exists(spark, path)
    session.forget(kept)
    assert not session.exists(spark, path)
