"""Every registered query against its SQL, run by DuckDB on the same tables."""

from pathlib import Path

import pytest

import __spark_entry__ as contract

duckdb = pytest.importorskip("duckdb")
SQL = contract.oracle_sql()
QUERIES = contract.queries()


@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    for table in Path(sf).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i].lower())

    def text(value):
        if isinstance(value, bool) or value is None:
            return str(value)
        return repr(float(value)) if isinstance(value, float) else str(value)

    return sorted(tuple(text(row[i]) for i in order) for row in rows)


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf, duck, name):
    result = QUERIES[name](spark, sf)
    found = canonical(result.collect(), result.columns)
    reply = duck.execute(SQL[name])
    columns = [c[0] for c in reply.description]
    assert sorted(c.lower() for c in result.columns) == sorted(c.lower() for c in columns)
    assert found == canonical(reply.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_other_queries_return_rows(spark, sf, name):
    assert not QUERIES[name](spark, sf).isEmpty()


def test_entry(spark):
    assert contract.entry(spark).count() == 3
