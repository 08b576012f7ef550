"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from conftest import SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if hasattr(v, "item") and not hasattr(v, "__len__"):
        v = v.item()
    if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    got = _rows(E.queries()[name](spark, SMALL).toPandas())
    want = _rows(con.execute(E.oracle_sql()[name]).df())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
