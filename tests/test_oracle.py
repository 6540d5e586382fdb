"""Every query that has a SQL twin equals it."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from plans import plan
from windrow.checks import oracle
from windrow.checks.queries import catalog

QUERIES, SQL = catalog(), oracle.statements()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    text = plan(df)
    assert not [word for word in ("CartesianProduct", "NestedLoop", "Python", "Pandas") if word in text]
    assert df.limit(1).count() == 1
    assert differences(df, con, SQL[name]) == []


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_calendar_does_not_depend_on_the_session_zone(spark, sf, con):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = QUERIES["gold_calendar"](spark, sf)
        assert differences(df, con, SQL["gold_calendar"]) == []
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
