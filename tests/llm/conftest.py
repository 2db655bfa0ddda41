import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import cases  # noqa: E402


@pytest.fixture(scope="session")
def docs(spark):
    return cases.documents(spark).repartition(3).persist()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], cases.SCHEMA)
