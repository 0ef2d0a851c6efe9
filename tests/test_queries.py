"""Every registered query against its DuckDB SQL on the smallest driver tables."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as entry
from statmart.plans import oracle, registry
from statmart.sources.testdata import TABLES

SF = "/root/testdata/sf0.001"
QUERIES = registry.QUERIES
ORACLE = oracle.ORACLE


def _norm(v):
    try:
        import pandas as pd
        if v is pd.NA or v is pd.NaT:
            return None
    except ImportError:
        pass
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        return _norm(v.item())
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    out = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return cols, sorted(out, key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    out = df.collect()
    assert 0 < len(out) <= 10 and "points_per_million" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got_cols, got = _rows(QUERIES[name](spark, SF).toPandas())
    want_cols, want = _rows(duck.execute(ORACLE[name]).fetchdf())
    assert got_cols == want_cols
    assert len(got) == len(want)
    assert got == want


def test_ieee_ratios_tell_nan_from_null(spark, duck):
    """The row comparison takes NaN for NULL, so the special values are counted by name here."""
    from statmart.plans.registry import LIVE_RATIOS
    df = entry.queries()["live_metrics_ieee"](spark, SF)
    kinds = {"nulls": "{0} IS NULL", "nans": "isnan({0})", "up": "{0} = CAST('Infinity' AS DOUBLE)"}
    asked = [f"count(CASE WHEN {test.format(c)} THEN 1 END)" for c in LIVE_RATIOS for test in kinds.values()]
    got = tuple(df.selectExpr(*[f"{a} AS c{i}" for i, a in enumerate(asked)]).first())
    expected = duck.execute(f"SELECT {', '.join(asked)} FROM ({entry.oracle_sql()['live_metrics_ieee']})").fetchone()
    assert got == expected
