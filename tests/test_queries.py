"""Every registered query against its SQL on the smallest scale."""

from __future__ import annotations

import pytest
from oracle_check import connect, differences

from daybook.plans.catalogue import QUERIES
from daybook.plans.oracle import ORACLE


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, small, name):
    assert differences(spark, con, QUERIES[name], ORACLE[name], small) == []


def test_entry(spark):
    from __spark_entry__ import entry

    assert entry(spark).columns[:3] == ["date", "year", "rank"]
