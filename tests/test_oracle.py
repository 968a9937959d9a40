"""Every registered query against DuckDB on the same tables, value by value."""

from __future__ import annotations

import functools

import pytest

import __spark_entry__ as registry
from orderloom.context import cut_lineage
from tests.conftest import SF_DIR

DUCK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


def rows_by_name(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(str(row[i]) for i in order) for row in rows)


def test_every_query_has_an_oracle():
    own = {*registry.SILVER, *registry.GOLD, *registry.REPORTS}
    assert own <= registry.queries().keys()
    assert own <= registry.oracle_sql().keys() <= registry.queries().keys()


def test_entry_returns_rows(spark):
    result = registry.entry(spark)
    assert result.columns == ["segment", "customers", "avg_spend", "avg_orders", "avg_recency_days"]
    assert result.count() > 0


@pytest.fixture(scope="module")
def gold(spark):
    """Gold tables stored on first use, so each report does not build them again."""
    return functools.cache(lambda table: cut_lineage(registry.GOLD[table](spark, SF_DIR)))


@pytest.mark.parametrize("name", sorted({**registry.SILVER, **registry.GOLD, **registry.REPORTS}))
def test_matches_duckdb(spark, duck, gold, name):
    if name in registry.REPORTS:
        report, tables = registry.REPORTS[name]
        result = report(*map(gold, tables))
    else:
        result = registry.queries()[name](spark, SF_DIR)
    expected = duck.execute(registry.oracle_sql()[name])
    names = [column[0] for column in expected.description]
    kinds = {column[0]: str(column[1]).replace(" ", "") for column in expected.description}
    assert {c: DUCK_TYPES.get(t, t.upper()) for c, t in result.dtypes} == kinds
    assert rows_by_name(result.columns, result.collect()) == rows_by_name(names, expected.fetchall())
