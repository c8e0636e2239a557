import os

import pytest
from pyspark.sql import SparkSession

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8,3]")
        .appName("asterloom-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(base / "shared"))
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def with_conf(spark):
    """Set session options for one test."""
    before = {}

    def apply(**options):
        for name, value in options.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key))
            spark.conf.set(key, value)

    yield apply
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture(scope="session")
def sf_dir():
    path = f"{TESTDATA}/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no test tables")
    return path
