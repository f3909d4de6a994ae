"""Every registered query against its SQL on the smallest test tables."""

import math
import pathlib

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not pathlib.Path(FOLDER).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return db


def plain(value):
    if isinstance(value, float):
        return "null" if math.isnan(value) else repr(round(value, 9))
    return "null" if value is None else str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([plain(r[i]) for i in order] for r in rows)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_equals_its_sql(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    got = table(df.columns, df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got[1]
        return
    result = duck.execute(sql)
    assert got == table([c[0] for c in result.description], result.fetchall())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
