import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from parity import make_duck, make_spark  # noqa: E402

SF = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    s = make_spark("8")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    return make_duck(SF)


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture()
def shuffled_joins(spark):
    """Take the salted paths a large cluster would take."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)
