"""The registered queries at the smallest scale: all are there, and those with SQL agree with it."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from gritmill.llm.queries import QUERIES, SQL
from oracle import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees_with_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), SQL[name]) == []


def test_one_query_for_each_operator():
    names = entry.queries().keys()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)} and set(QUERIES) | {"pipeline"} <= set(names)
