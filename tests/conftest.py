import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from lexmill.session import local_session

    return local_session("4", memory="4g")


@pytest.fixture
def values(spark):
    """Evaluate column expressions over one-column rows and return the results in order."""
    from pyspark.sql import functions as F

    def run(items, expr, schema="i long, v string"):
        df = spark.createDataFrame(list(enumerate(items)), schema)
        return [r.out for r in df.select("i", expr(F.col("v")).alias("out")).orderBy("i").collect()]

    return run
