"""Plan-shape guarantees: pushdown into the scan, and no query plans a
cartesian product, a nested-loop join or a row-at-a-time Python UDF."""

import pytest

import __spark_entry__ as E
from quarry.plans import QUERIES as PLANS

SF = "/root/testdata/sf0.001"
# model fits run many jobs while building; their final plans are trivial selects
SLOW = {"gbt_cv", "grid_search", "module_classification", "gbt_predictions", "gbt_importance", "subset_cluster",
        "k_select", "period_anomalies", "ocsvm_points", "joint_anomalies", "window_anomalies", "anomaly_counts",
        "importance_check", "iforest_check", "kmeans_check", "model_round_trip", "iforest_points", "kmeans_assign",
        "kmeans_profile", "gmm_assign", "ward_two_phase",
        "gbt_fold_check", "gbt_leaf_check", "attribution_check", "attribution_rows", "attribution_mean",
        "permutation_importance", "ward_linkage", "ward_check", "gmm_check", "ocsvm_check", "subset_assign",
        "subset_check"}
QUERIES = E.queries()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_time_slices_push_down(spark):
    p = _plan(QUERIES["time_slice_counts"](spark, SF))
    assert "GreaterThanOrEqual(ts," in p and "LessThan(o_orderdate," in p


def test_lab_scan_prunes_columns(spark):
    p = _plan(QUERIES["null_profile"](spark, SF))
    assert "l_returnflag" not in p.split("ReadSchema")[1].split("\n")[0]


@pytest.mark.parametrize("name", sorted(set(PLANS) - SLOW))
def test_no_cartesian_or_row_udf(spark, name):
    p = _plan(QUERIES[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in p, f"{name} plans {bad}"


@pytest.mark.parametrize("name", ["dist_profile", "box_stats", "hist_auto", "hist_p99", "peak_impute_grouped",
                                  "peak_impute_closed", "tiered_plan", "adaptive_bins", "median_binarise",
                                  "mode_impute"])
def test_no_percentile_or_mode_over_rows(spark, name, capsys):
    """Quantiles and modes come from counted values, also in the steps that
    run on the way (the sketch over distinct values is percentile_approx)."""
    import quarry.operators.quantile as qu
    assert "F.percentile(" not in open(qu.__file__).read() and "F.mode(" not in open(qu.__file__).read()
    QUERIES[name](spark, SF).explain()
    plan = capsys.readouterr().out
    assert " percentile(" not in plan and " mode(" not in plan and "CartesianProduct" not in plan
