import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from rankloom.session import local_session

    session = local_session("tests", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def hot(spark):
    """Treat every group above five rows as too large for one task."""
    from rankloom.operators.skew import HOT_ROWS_CONF

    spark.conf.set(HOT_ROWS_CONF, "5")
    yield
    spark.conf.unset(HOT_ROWS_CONF)


@pytest.fixture(scope="session")
def scores(spark):
    """Three groups of very different size, with ties and gaps."""
    rows = []
    for group, size in (("big", 60), ("mid", 9), ("one", 1)):
        for i in range(size):
            a = None if i % 17 == 5 else float((i * 7) % 13)
            rows.append((group, f"i{i:02d}", a, float((i * 5) % 11), 2.5))
    return spark.createDataFrame(rows, "g string, item string, a double, b double, flat double").cache()
