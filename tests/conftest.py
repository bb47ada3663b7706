import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidemark.config import local_session
    s = local_session("*", shuffle_partitions=8, app="tidemark-tests", driver_memory="4g")
    yield s
    s.stop()


@pytest.fixture(scope="module", autouse=True)
def own_views():
    """Temporary views of a module's tests end with it: any database lists them."""
    yield
    from pyspark.sql import SparkSession
    s = SparkSession.getActiveSession()
    for t in s.catalog.listTables() if s else []:
        if t.isTemporary:
            s.catalog.dropTempView(t.name)


@pytest.fixture()
def scratch(spark):
    from tidemark.config import scratch_path
    return scratch_path(spark, "test")
