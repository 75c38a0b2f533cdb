import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from fxlake.session import configure

    s = (SparkSession.builder.master("local[4]")
         .appName("fxlake-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="fxlake-test-ckpt-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    configure(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="fxlake-test-")
