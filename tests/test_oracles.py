"""Every catalog query against its SQL, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    yield con
    con.close()


def comparable(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_bool_dtype(df[c]):
            df[c] = df[c].astype(str)
        elif pd.api.types.is_numeric_dtype(df[c]):
            df[c] = df[c].astype(float)
        else:
            df[c] = df[c].map(lambda x: None if pd.isna(x) else str(x))
    return df.sort_values(list(df.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, sf_dir, duck, name):
    found = contract.queries()[name](spark, sf_dir).toPandas()
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert len(found)
        return
    expected = duck.execute(sql).df()
    pd.testing.assert_frame_equal(comparable(found), comparable(expected), check_dtype=False, rtol=0, atol=2e-6)


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
