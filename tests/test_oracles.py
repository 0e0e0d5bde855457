"""Every registered query against its SQL: names, types and all values."""

import pytest

import __spark_entry__ as driver
from compare import connect, differences, duckdb_bag, duckdb_types, spark_bag
from conftest import SF_DIR

QUERIES = driver.queries()
ORACLES = driver.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_learning_query_has_an_oracle():
    from lectern.catalog.oracles import all_oracles
    from lectern.catalog.queries import all_queries

    assert set(all_queries()) == set(all_oracles())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    columns, rows = spark_bag(df)
    expected_columns, expected = duckdb_bag(con, ORACLES[name])
    assert columns == expected_columns
    assert dict(df.dtypes) == duckdb_types(con, ORACLES[name])
    assert sum(rows.values()) > 0
    assert rows == expected, differences(rows, expected)


def test_entry(spark):
    ranked = driver.entry(spark)
    assert ranked.columns == [
        "enrollment_rank",
        "course_id",
        "course_name",
        "learner_count",
    ]
    assert ranked.count() > 0
