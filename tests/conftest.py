import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from closebook.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("closebook-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", str(root / "shared"))
        .config("spark.sql.warehouse.dir", str(root / "warehouse"))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield configure(session)
    session.stop()


@pytest.fixture(autouse=True)
def settings_as_before(spark):
    """No test runs under settings that an earlier one left."""
    before = dict(spark.conf.getAll)
    yield
    after = dict(spark.conf.getAll)
    for key, value in after.items():
        if before.get(key) != value and spark.conf.isModifiable(key):
            spark.conf.set(key, before[key]) if key in before else spark.conf.unset(key)
    for key in before.keys() - after.keys():
        spark.conf.set(key, before[key])
