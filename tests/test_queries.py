import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, canonical
from snapflow.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))  # those for training text are tested beside their operators
def test_query_equals_oracle(spark, duck, name):
    got = canonical(queries()[name](spark, SF).toPandas())
    assert got
    if name in oracle_sql():
        assert got == canonical(duck.execute(oracle_sql()[name]).df())
