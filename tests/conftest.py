import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from shelfwise.session import SESSION_DEFAULTS

    session = (
        SparkSession.builder.master("local[*]")
        .config(map=SESSION_DEFAULTS)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from shelfwise.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(session)
    yield session


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="shelfwise-test-")
