from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from talkloom.session import local_session

    session = local_session(cores=4, memory="6g", partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def value(spark):
    """The single value of a column expression."""
    return lambda column: spark.range(1).select(column.alias("x")).first()["x"]
