"""Queries of the training-data operators equal their SQL twins; all of them run."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from windrow.llm import oracle, queries

SQL = oracle.statements()


def test_all_are_registered():
    assert set(SQL) <= set(queries.catalog()) <= set(entry.queries())
    assert sorted({n.split("_")[0] for n in queries.catalog()}) == sorted(f"op{i}" for i in range(1, 14))
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, sf, name):
    assert differences(queries.catalog()[name](spark, sf), connect(sf), SQL[name]) == []
