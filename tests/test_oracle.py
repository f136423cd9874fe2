"""Every registered query against its DuckDB statement on the smallest data."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from showlake.plans.change_oracle import DERIVED_COLUMNS
from showlake.plans.change_queries import CHANGES
from showlake.plans.queries import READS
from showlake.sources.derive import HELPERS, RAW, platform_tables

SF = "/root/testdata/sf0.001"
OWN = {**READS, **CHANGES}
QUERIES = {name: query for name, query in entry_points.queries().items() if name in OWN}
ORACLES = {name: sql for name, sql in entry_points.oracle_sql().items() if name in OWN}

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "smallint": "SMALLINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
    "array<string>": "VARCHAR[]",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in RAW:
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) == set(OWN)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(row)) for row in df.select(*[f"`{c}`" for c in columns]).collect())
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    assert sorted(names) == columns
    expected = sorted(repr(tuple(row[names.index(c)] for c in columns)) for row in result.fetchall())
    assert got == expected
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema}
    assert {c: TYPES.get(t, t.upper()) for c, t in spark_types.items()} == types


def test_derived_columns(spark):
    tables = platform_tables(spark, SF)
    assert {n: tables[n].columns for n in tables if n not in HELPERS} == DERIVED_COLUMNS


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["content_id", "title", "view_count"]
