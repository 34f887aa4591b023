import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(4, memory="4g")


@pytest.fixture
def frame(spark):
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make


def rows(df):
    """Rows as a sorted list of tuples, NULLs included."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
