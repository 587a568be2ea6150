"""Every query with an SQL twin agrees with it on the smallest data."""

import pytest

from check_queries import compare, connect
from tidemark import catalog

PLANS, SQL = catalog.spark_queries(), catalog.sql_queries()
FAST = [n for n in PLANS if n in SQL]


def test_names_and_columns_are_aligned():
    assert set(SQL) <= set(PLANS)
    assert not any(n.startswith("op") and n[2:3].isdigit() for n in PLANS)


@pytest.mark.parametrize("name", FAST)
def test_query(spark, sf, name):
    assert compare(spark, connect(sf), sf, name, PLANS[name], SQL[name]).split()[0] in ("ok", "EMPTY")
