"""Every registered query against its SQL on the given tables."""

import pytest

from sunledger.plans import CATALOG
from tests.oracle import SF_ROOT, connect, problems

SF = f"{SF_ROOT}/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(CATALOG))
def test_query_equals_sql(spark, con, name):
    assert problems(spark, name, SF, con) == []


def test_inventory_is_covered():
    counts = {"S": 8, "P": 20, "J": 14, "A": 33, "W": 28, "K": 3, "U": 4, "T": 8, "M": 6, "C": 2}
    wanted = {f"{k}{i}" for k, n in counts.items() for i in range(1, n + 1)}
    assert wanted == {i for q in CATALOG.values() for i in q.covers}
