"""Every catalogue query against its SQL."""

import duckdb
import pytest

import __spark_entry__
from toolcat.plans import harvest_queries, queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES.split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def as_rows(frame, columns):
    values = frame[columns].astype(object)
    return sorted(map(repr, values.where(values.notna(), None).values.tolist()))


@pytest.mark.parametrize("name", sorted(queries.queries() | harvest_queries.queries()))
def test_query_equals_sql(spark, oracle, name):
    made, sql = queries.queries() | harvest_queries.queries(), queries.oracle_sql() | harvest_queries.oracle_sql()
    got, want = made[name](spark, SF).toPandas(), oracle.sql(sql[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert as_rows(got, sorted(got.columns)) == as_rows(want, sorted(got.columns))


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
