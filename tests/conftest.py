import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from ledgerflow.session import PLAN_CONF, checkpoint_dir

    builder = (
        SparkSession.builder.master("local[*]")
        .appName("ledgerflow-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
    )
    for k, v in PLAN_CONF.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture
def scratch():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="ledgerflow-test-", dir="/tmp")
