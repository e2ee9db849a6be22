"""Every query with an oracle must agree with DuckDB at sf0.001 (the driver
checks sf0.01); queries without one must at least run."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from quarry.plans import QUERIES as PLANS
from quarry.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
QUERIES = E.queries()
ORACLE = E.oracle_sql()
# Hundreds of fits each: their operators are tested on small frames in
# test_models.py, and the driver runs the queries themselves.
MANY_FITS = {"gbt_cv", "grid_search", "module_classification", "k_select", "subset_cluster", "anomaly_counts",
             "joint_anomalies", "period_anomalies", "subset_assign", "gbt_importance", "attribution_mean"}


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = con.execute(ORACLE[name]).df()
    assert _rows(got) == _rows(want)


@pytest.mark.parametrize("name", sorted(set(PLANS) - set(ORACLE) - MANY_FITS))
def test_runs(spark, name):
    df = QUERIES[name](spark, SF).cache()
    assert df.count() > 0
    for key in ("vec_id", "doc_id"):
        if key in df.columns:  # assignments and predictions: every id once
            assert df.select(key).distinct().count() == df.count()
    df.unpersist()


def test_entry(spark):
    assert E.entry(spark).count() > 0
