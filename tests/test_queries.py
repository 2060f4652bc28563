"""Every registered query against DuckDB on the smallest test tables."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from mercaloom.expected_sql import expected_sql
from mercaloom.plans import catalog
from tests.conftest import rows_of

# the training-data queries have tests of their own
QUERIES = catalog.queries()
ORACLE = expected_sql()
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "tinyint": "TINYINT",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck(small):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{small}/{table}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLE) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, small, duck, name):
    got = QUERIES[name](spark, small)
    expected = duck.sql(ORACLE[name])
    columns = sorted(got.columns)
    assert columns == sorted(expected.columns)
    types = dict(zip(expected.columns, map(str, expected.types)))
    for column, dtype in got.dtypes:
        assert TYPES.get(dtype, dtype.upper()) == types[column], column
    chosen = ", ".join(f'"{c}"' for c in columns)
    wanted = duck.sql(f"select {chosen} from ({ORACLE[name]})").fetchall()
    assert rows_of(got) == sorted(
        tuple("~" if v is None else str(v) for v in row) for row in wanted
    )


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.columns == [
        "category_en",
        "customer_state",
        "revenue",
        "sales_lines",
        "late_rate",
    ]
    assert result.count() > 0
