import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]


@pytest.fixture(scope="session")
def spark():
    from panelcast.runtime import local_session

    return local_session(4, "tests", **{"spark.sql.shuffle.partitions": "4"})


@pytest.fixture
def table(spark):
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make
