"""Every registered query against its SQL over the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from fixtures import registered
from tools.check_against_sql import ordered, sql_rows

SMALL = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()


def test_every_query_has_sql():
    assert set(registered.queries()) <= set(ORACLE) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    df = entry.queries()[name](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    columns, _, expected = sql_rows(SMALL, ORACLE[name])
    assert sorted(df.columns) == sorted(columns)
    assert ordered(df.columns, rows) == ordered(columns, expected)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
