"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


def rows(df: pd.DataFrame) -> list[tuple]:
    df = df.reindex(sorted(df.columns), axis=1)

    def one(v):
        if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and v != v):
            return "null"
        return f"{v:.9g}" if isinstance(v, float) else str(int(v)) if isinstance(v, int) and not isinstance(v, bool) else str(v)

    return sorted(tuple(map(one, r)) for r in df.astype(object).where(df.notna(), None).itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_equals_sql(name, spark, duck):
    got, want = entry.queries()[name](spark, SF).toPandas(), duck.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["zona", "zona_nombre", "votantes", "mesas", "escuelas"] and df.count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
