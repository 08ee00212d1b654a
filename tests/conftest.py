import json

import pytest

from itemflow.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus="8", partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """One-column DataFrame ``v`` of the given texts."""

    def make(*texts):
        return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")

    return make


@pytest.fixture
def lines(spark):
    """Raw export lines from Python items (or raw text)."""

    def make(*items):
        rows = [(x if isinstance(x, str) else json.dumps({"Item": x}),) for x in items]
        return spark.createDataFrame(rows, "raw string")

    return make
