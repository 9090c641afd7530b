import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("ledgerlake-tests", cpus=4, partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate a column builder on single text values."""
    from pyspark.sql import functions as F

    def evaluate(build, *values, dtype="string"):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
        result = rows.select("i", build(F.col("v")).alias("r")).orderBy("i").collect()
        return [r["r"] for r in result]
    return evaluate
