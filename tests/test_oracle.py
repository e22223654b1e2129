"""Every registered query against its DuckDB SQL on the smallest test data."""

from __future__ import annotations

import pytest

from compare import compare, connect
from conftest import SMALL
from ledgerloom.registry import ORACLE, QUERIES


@pytest.fixture(scope="session")
def duck():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_answer(spark, duck, name):
    assert compare(spark, duck, name, QUERIES[name], ORACLE[name], SMALL) is None


def test_entry(spark):
    from __spark_entry__ import entry

    assert entry(spark).count() > 0
