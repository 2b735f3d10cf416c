"""Every registered query against its SQL equivalent in DuckDB."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from hazeline.oracle import ORACLE
from hazeline.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = "customer events".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS FROM '{SF_DIR}/{table}.parquet'")
    return connection


def canonical(rows):
    def value(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v)
        return repr(v)

    return sorted(tuple(map(value, row)) for row in rows)


DUCK_TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "float": "FLOAT", "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    result = duck.sql(ORACLE[name])
    columns = sorted(frame.columns)
    assert columns == sorted(result.columns)
    ordered = frame.select(*[f"`{c}`" for c in columns])
    quoted = ", ".join(f'"{c}"' for c in columns)
    expected = result.project(quoted)
    assert [DUCK_TYPES[t] for _, t in ordered.dtypes] == [str(t) for t in expected.types]
    assert canonical(ordered.collect()) == canonical(expected.fetchall())


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()


def test_entry_point_has_them_all():
    assert QUERIES.items() <= entry_point.queries().items()
    assert ORACLE.items() <= entry_point.oracle_sql().items()


def test_entry_ranks_twenty_readings(spark):
    rows = entry_point.entry(spark).collect()
    assert len(rows) == 20
    assert [r.AQI for r in rows] == sorted((r.AQI for r in rows), reverse=True)
