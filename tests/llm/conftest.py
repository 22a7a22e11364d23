import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from edge_docs import SCHEMA, edge_rows  # noqa: E402


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, int(i not in (9, 10, 11)), 0) for i in (1, 4, 5, 6, 7, 8, 9, 10, 11)]
    return spark.createDataFrame(rows + [(4, 1, 0), (None, 1, 0), (99, 0, 1), (2, None, None)],
                                 "doc_id long, quality int, toxic int")
