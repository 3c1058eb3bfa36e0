"""Every registered query against its DuckDB oracle on sf0.001."""

import datetime
import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
MODEL = {"train_ova_model", "learning_curve", "feature_importance", "save_feature_report"}


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if isinstance(v, datetime.datetime):
        return v
    if isinstance(v, datetime.date):
        return datetime.datetime(v.year, v.month, v.day)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    key = lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t)
    return cols, sorted(rows, key=key)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "labels"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


# the library's own queries; those of the subpackage llm have tests/llm
OWN = set(E.catalog.build())


def test_every_query_has_an_oracle_or_is_a_model_step():
    q, s = E.queries(), E.oracle_sql()
    assert OWN - set(s) == MODEL
    assert set(s) <= set(q)


@pytest.mark.parametrize("name", sorted(OWN & set(E.oracle_sql())))
def test_query_matches_oracle(spark, con, name):
    sp = E.queries()[name](spark, SF).toPandas()
    dd = con.execute(E.oracle_sql()[name]).df()
    c1, r1 = _rows(sp)
    c2, r2 = _rows(dd)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert set(df.columns) >= {"label", "var", "iv", "iv_strength"}
