import os

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master(os.environ.get("TEST_MASTER", "local[8]"))
        .appName("marquee-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session configuration for one test."""
    changed = {}

    def set_conf(name, value):
        changed.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield set_conf
    for name, value in changed.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)
