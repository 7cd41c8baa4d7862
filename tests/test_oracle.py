"""Every registered query against its SQL, value by value, on whole tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
GIVEN = "region nation customer supplier part orders lineitem".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in GIVEN:
        con.execute(
            f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'"
        )
    return con


def canonical(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan" if math.isnan(value) else repr(value + 0.0))
    return (1, str(value))


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(row[i]) for i in order) for row in rows)


# DuckDB type names for the Spark types that occur.
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


# The operators for training data have tests of their own.
NAMES = sorted(
    set(registry.queries()) - (set(registry.llm.QUERIES) | {"pipeline"} if registry.llm else set())
)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF_DIR)
    relation = duck.sql(registry.oracle_sql()[name])
    expected_types = dict(zip(relation.columns, map(str, relation.types), strict=True))
    assert {c: TYPES[t] for c, t in df.dtypes} == expected_types
    assert bag(df.columns, [tuple(r) for r in df.collect()]) == bag(
        relation.columns, relation.fetchall()
    )


def test_every_query_has_sql():
    assert set(NAMES) <= registry.oracle_sql().keys() <= registry.queries().keys()


def test_entry(spark):
    df = registry.entry(spark)
    assert df.columns == ["c_r_name", "s_year", "revenue", "n_lines"]
    assert df.count() > 0
