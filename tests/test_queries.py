"""Every registered query against its SQL on the source tables."""

from __future__ import annotations

import pytest
from conftest import SF_DIR
from oracle_check import connect, difference

import __spark_entry__ as contract


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(contract.QUERIES) == set(contract.SQL)
    assert set(contract.SQL) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(contract.QUERIES))
def test_query(name, spark, duck):
    frame = contract.queries()[name](spark, SF_DIR)
    assert difference(frame, duck, contract.oracle_sql()[name]) == ""
