"""Every query with SQL gives the rows that DuckDB gives."""

import os

import duckdb
import pandas as pd
import pytest

from volsurf.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(df):
    df = df[sorted(df.columns)]
    plain = [tuple("" if pd.isna(v) else repr(round(float(v), 6)) if isinstance(v, float) else str(v) for v in r) for r in df.itertuples(index=False)]
    return sorted(plain)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(spark, duck, name):
    ours, theirs = QUERIES[name](spark, SF).toPandas(), duck.execute(ORACLE_SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours.astype(object)) == rows(theirs.astype(object))
    assert len(ours)


def test_names():
    assert set(ORACLE_SQL) <= set(QUERIES)
