import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMOKE = "/root/testdata/sf0.001"
SF_SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    builder = (
        SparkSession.builder.master("local[8]")
        .appName("ebbflow-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    # tests only: a checkpoint folder of our own where the session names none
    if not session.conf.get("spark.checkpoint.dir", None) and session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ebbflow-test-ckpt-"))
    yield session


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="ebbflow-test-")
