"""Every registered query against DuckDB on the sf0.01 tables."""

import math
from decimal import Decimal

import pytest

import __spark_entry__ as driver
from tables import SF_DIR

QUERIES = driver.queries()
ORACLE = driver.oracle_sql()


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(plain(r[i]) for i in order)) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    got = result.collect()
    assert got, "a registered query gives rows on the test tables"
    if name not in ORACLE:
        return
    relation = duck.sql(ORACLE[name])
    assert sorted(result.columns) == sorted(relation.columns)
    expected = rows_of(relation.columns, relation.fetchall())
    assert rows_of(result.columns, got) == expected


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert driver.entry(spark).count() == 10
