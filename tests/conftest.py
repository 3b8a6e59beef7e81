import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="kiln-test-")
    s = (SparkSession.builder.master("local[*]")
         .appName("kiln-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.checkpoint.dir", scratch)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from kiln.session import scratch_root
    scratch_root(s)
    yield s
    s.stop()


@pytest.fixture
def tmp(tmp_path):
    return str(tmp_path)
