"""Every query against its SQL twin on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def plain(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].astype(object)
    df = df.where(df.notna(), None)
    text = lambda v: None if v is None else f"{v:.6f}" if isinstance(v, float) else str(v)
    df = df.apply(lambda column: column.map(text))
    return df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, sql, name):
    got = entry.queries()[name](spark, SF_DIR).toPandas()
    statement = entry.oracle_sql().get(name)
    if statement is None:
        assert len(got) > 0
        return
    want = sql.execute(statement).df()
    assert sorted(got.columns) == sorted(want.columns)
    pd.testing.assert_frame_equal(plain(got), plain(want))


def test_every_statement_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
