import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from caseweave.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "8g")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate an expression over single text values: one(expression, values) -> list."""
    def run(expression, values, kind="string"):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
        return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]
    return run
