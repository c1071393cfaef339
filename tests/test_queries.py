"""Every registered query at the smallest scale: against its SQL twin, or for rows where it has none."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from gritmill.workload import load_all
from gritmill.workload.registry import QUERIES, SQL
from oracle import connect, differences

SF = "/root/testdata/sf0.001"
load_all()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_agrees_with_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, SQL[name]) == []


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SQL])
def test_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(QUERIES) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
