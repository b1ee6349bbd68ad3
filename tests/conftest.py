import os

import pytest

from tidemark.session import local_session

SF_DIR = os.environ.get("TIDEMARK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    spark = local_session(8, "tests")
    yield spark
    spark.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def set_option(key, value):
        before[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)

    yield set_option
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("test tables not present")
    return SF_DIR


@pytest.fixture
def executed(spark):
    """Run a frame and give the plan that adaptive execution ended with."""

    def run(df):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        return plan.split("== Initial Plan ==")[0]

    return run
