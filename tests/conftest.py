import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from demandloom.schemas import DEMAND, SALES  # noqa: E402
from demandloom.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    yield session
    session.stop()


@pytest.fixture
def make_sales(spark):
    """Rows of (day offset, store, item, quantity, price, total)."""

    def build(rows):
        start = dt.date(2024, 1, 1)
        return spark.createDataFrame(
            [(None if d is None else start + dt.timedelta(d), *rest) for d, *rest in rows], SALES
        )

    return build


@pytest.fixture
def make_demand(spark):
    """Rows of (day offset, store, item, demand, price)."""

    def build(rows):
        start = dt.date(2024, 1, 1)
        return spark.createDataFrame([(start + dt.timedelta(d), *rest) for d, *rest in rows], DEMAND)

    return build
