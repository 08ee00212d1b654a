import os

import pytest

DATA = os.environ.get("ITEMFLOW_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    return DATA


@pytest.fixture
def docs(spark):
    """Documents of the given texts, with ids from 0 and columns whose names clash with those of the operators."""

    def make(*texts):
        rows = [(i, t, "en", None) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, n_words string, shard int")

    return make
