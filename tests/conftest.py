import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from shelfmark.session import local_session

    return local_session(8, "tests", **{"spark.driver.memory": "8g"})


@pytest.fixture
def one(spark):
    """Evaluate a function of literal columns on one row."""
    from pyspark.sql import functions as F

    def run(fn, *values, kinds=None):
        kinds = kinds or [None] * len(values)
        columns = [F.lit(v) if k is None else F.lit(v).cast(k) for v, k in zip(values, kinds)]
        return spark.range(1).select(fn(*columns).alias("x")).first()["x"]

    return run
