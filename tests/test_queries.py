"""Every registered query of the reference's operators against its SQL in DuckDB."""

import math

import duckdb
import pandas as pd
import pytest

from snapfold import plans

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def told(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return "-"
    if isinstance(v, bool) or type(v).__name__.startswith("bool"):
        return str(bool(v))
    if isinstance(v, float) or type(v).__name__.startswith("float"):
        return f"{float(v):.9g}"
    return str(int(v)) if type(v).__name__.startswith(("int", "uint")) else str(v)


def rows(df):
    columns = sorted(df.columns)
    return columns, sorted(tuple(told(v) for v in r) for r in df[columns].itertuples(index=False))


@pytest.fixture(scope="session")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def test_each_has_sql():
    assert set(plans.QUERIES) == set(plans.ORACLES)


@pytest.mark.parametrize("name", list(plans.QUERIES))
def test_query(spark, sf_dir, duck, name):
    got, expected = plans.QUERIES[name](spark, sf_dir).toPandas(), duck.execute(plans.ORACLES[name]).df()
    for c in got.columns:  # whole numbers that hold nulls come as floats from one side
        if c in expected and pd.api.types.is_float_dtype(expected[c]) != pd.api.types.is_float_dtype(got[c]) and pd.api.types.is_numeric_dtype(got[c]) and pd.api.types.is_numeric_dtype(expected[c]):
            got[c], expected[c] = got[c].astype(float), expected[c].astype(float)
    assert rows(got) == rows(expected)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
