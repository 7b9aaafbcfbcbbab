"""Every registered query against its SQL counterpart: columns, types and rows."""

import pytest

import __spark_entry__ as entry_points
from bookloom.queries.oracle import ORACLE
from bookloom.queries.registry import QUERIES
from compare import connect, spark_table, spark_types, sql_table, sql_types

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLE) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    assert spark_types(df) == sql_types(duck, ORACLE[name])
    assert spark_table(df) == sql_table(duck, ORACLE[name])


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert {r.channel for r in rows} == {"facebook_paid_ads", "youtube_paid_ads", "tiktok_paid_ads"}
