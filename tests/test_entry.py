"""Driver contract: entry runs, every query has an oracle, and each query
equals its DuckDB oracle on the smallest scale factor."""

from __future__ import annotations

import datetime as dt
import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_mod
from conftest import SF_SMALL
from sensorflow.plans.oracle import ORACLE
from sensorflow.plans.queries import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _cell(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return str(int(v)) if v.is_integer() and abs(v) < 2 ** 53 else repr(v + 0.0)
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat() + "T00:00:00"
    if hasattr(v, "item"):
        return _cell(v.item())
    return str(v)


def _digest(df):
    cols = sorted(df.columns)
    return sorted(tuple(_cell(v) for v in r) for r in df[cols].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["fenster_start", "fenster_ende", "avg_absolute", "avg_gx", "avg_gy",
                          "avg_gz", "n_samples"]
    assert df.count() > 0


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_mod.queries())
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got = entry_mod.queries()[name](spark, SF_SMALL).toPandas()
    want = duck.execute(entry_mod.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _digest(got) == _digest(want)
