"""Every registered query with SQL, run side by side at the smallest scale."""

import datetime as dt
import os

import pytest

import __spark_entry__ as entry_module

SF = entry_module.SMALL
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not there")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple("" if r[i] is None else str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    df = entry_module.queries()[name](spark, SF)
    cursor = duck.execute(entry_module.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    assert got == canonical(columns, cursor.fetchall())
    assert got


def test_every_sql_has_its_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    df = entry_module.entry(spark)
    assert len(df.columns) == 53 and df.count() > 0


@pytest.mark.parametrize("name", ["label_changepoint", "label_changepoint_binseg"])
def test_the_step_is_labelled_everywhere(spark, name):
    rows = entry_module.queries()[name](spark, SF).collect()
    assert len(rows) == 10
    assert {r["onset_date"] for r in rows} == {dt.date(1998, 5, 1)}
