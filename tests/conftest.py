import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    ckpt = tempfile.mkdtemp(prefix="stratus-test-ckpt-")
    s = (
        SparkSession.builder.master("local[4]")
        .appName("stratus-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", ckpt)
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(ckpt)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="stratus-test-")
