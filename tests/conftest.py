import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session

    s = local_session(cores="*", app="tidemark-tests", shuffle_partitions=8)
    yield s


@pytest.fixture()
def docs(spark):
    """Build a one-column ``value`` DataFrame from Python objects (JSON documents) or raw lines."""

    def make(*items):
        rows = [(i if isinstance(i, str) else json.dumps(i),) for i in items]
        return spark.createDataFrame(rows, "value string")

    return make


@pytest.fixture()
def store(spark, tmp_path):
    from tidemark.sources.store import TableStore

    return TableStore(spark, str(tmp_path / "store"), buckets=4)
