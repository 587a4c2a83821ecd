from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as book
from check import rows_of
from querybook.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def test_every_query_has_sql():
    assert set(QUERIES) <= set(book.oracle_sql())
    assert set(book.oracle_sql()) <= set(book.queries())


def test_entry(spark):
    assert book.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equal_to_sql(spark, con, name):
    df = book.queries()[name](spark, SF)
    cur = con.execute(book.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, cur.fetchall())
