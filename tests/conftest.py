from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ordergrain.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("ordergrain-tests", cores=8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def table(spark):
    """Build a DataFrame from a DDL schema and rows."""

    def build(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return build
