"""Profiles, histograms and imputation on hand frames."""

import numpy as np
from pyspark.sql import functions as F

from quarry.operators import encode as en
from quarry.operators import impute as im
from quarry.operators import profile as pr
from quarry.operators.common import long_form


def test_fixed_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(60.0,), (0.0,), (61.0,), (-1.0,)], "x double")
    h = {r["bin"]: r["n"] for r in pr.fixed_histogram(df, "x", 0.0, 60.0, 60).collect()}
    assert len(h) == 60 and h[59] == 1 and h[0] == 1 and sum(h.values()) == 2


def test_auto_histogram_matches_numpy(spark):
    rng = np.random.default_rng(7)
    for data in (rng.normal(10, 3, 500), rng.exponential(2.0, 300), np.array([1.0, 1.0, 2.0, 5.0, 5.0, 9.5])):
        df = spark.createDataFrame([(float(v),) for v in data], "x double")
        got = sorted((r["bin"], r["n"]) for r in pr.auto_histogram(df, ["x"]).collect())
        counts, _ = np.histogram(data, bins="auto")
        want = [(i, int(c)) for i, c in enumerate(counts) if c > 0]
        assert got == want


def test_peak_fill_closed_vs_half_open(spark):
    # [null, 0, 1, 1]: the peak is the last bin; closed fills 1.0,
    # half-open excludes the upper edge, finds the bin empty and falls back to the mean
    df = spark.createDataFrame([(1, None), (2, 0.0), (3, 1.0), (4, 1.0)], "id int, x double")
    closed = im.peak_impute(df, ["x"], closed=True).where("id = 1").first()["x"]
    half = im.peak_impute(df.withColumn("g", F.lit("a")), ["x"], group="g").where("id = 1").first()["x"]
    assert closed == 1.0
    assert abs(half - 2.0 / 3.0) < 1e-12


def test_peak_fill_values_long(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [1, 2, 2, 2, 3, 10]], "g string, x double")
    f = im.peak_fill_values(long_form(df, ["g"], ["x"]), ["g", "feature"]).first()
    assert f["peak_lo"] <= 2.0 < f["peak_hi"]


def test_mixed_text_code(spark):
    df = spark.createDataFrame([(None,), ("Negative",), ("0",), ("0.3",), ("x",), (" negative ",)], "t string")
    got = [r[0] for r in df.select(en.mixed_text_code(F.col("t"), blank_as=1)).collect()]
    assert got == [1, 0, 0, 1, 0, 0]
    got0 = [r[0] for r in df.select(en.mixed_text_code(F.col("t"))).collect()]
    assert got0[0] == 0


def test_scaling_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, c double")
    m = en.minmax_scale(df, ["a", "c"]).collect()
    z = en.zscore(df, ["a", "c"]).collect()
    assert [r["c"] for r in m] == [0.0, 0.0] and [r["c"] for r in z] == [0.0, 0.0]
    assert sorted(r["a"] for r in m) == [0.0, 1.0] and sorted(r["a"] for r in z) == [-1.0, 1.0]


def test_risk_band(spark):
    df = spark.createDataFrame([(0.0,), (0.3,), (0.7,), (1.0,)], "p double")
    assert [r[0] for r in df.select(en.risk_band(F.col("p"))).collect()] == [None, "low", "medium", "high"]


def test_null_profile_tiers(spark):
    rows = [(None if i < 7 else 1.0, None if i < 2 else 1.0) for i in range(10)]
    df = spark.createDataFrame(rows, "a double, b double")
    p = {r["feature"]: (r["missing"], r["tier"], r["severity"]) for r in pr.null_profile(df, ["a", "b"]).collect()}
    assert p["a"] == (7, "high", "red") and p["b"] == (2, "low", "orange")


def test_dedupe_names():
    from quarry.operators.columns import dedupe_names, unify_brackets
    assert dedupe_names(["x", "y", "x", "x"]) == ["x", "y", "x.1", "x.2"]
    assert unify_brackets(["a（b）"]) == ["a(b)"]


def test_exact_quantiles_against_numpy(spark):
    """Hot values, one value, one row, hot keys; more distinct values than buckets."""
    from quarry.operators.quantile import counted, exact_quantiles, modes, order_statistic
    rng = np.random.default_rng(9)
    data = {"many": rng.normal(50, 10, 3000).tolist(), "hot": [1.0] * 2000 + rng.uniform(0, 2, 500).tolist(),
            "same": [7.0] * 40, "one": [3.5], "two": [1.0, 2.0], "none": [None, None]}
    rows = [(k, v) for k, vs in data.items() for v in [*vs, None]]
    df = spark.createDataFrame(rows, "k string, x double")
    qs = (0.0, 0.01, 0.25, 1 / 3, 0.5, 0.9, 1.0)
    counts = counted(df, ["k"])
    got = {r["k"]: r for r in exact_quantiles(counts, ["k"], qs).collect()}
    assert "none" not in got
    for k, vs in data.items():
        if k != "none":
            assert got[k]["total"] == len(vs)
            np.testing.assert_allclose(got[k]["q"], np.quantile(vs, qs), rtol=1e-12)
    mode = {r["k"]: r["mode"] for r in modes(counts, ["k"]).collect()}
    assert mode["hot"] == 1.0 and mode["two"] == 1.0
    for share in (0.0, 0.5, 0.95, 1.0):
        value = order_statistic(df.where("k = 'many'"), "x", share).first()["value"]
        assert value == sorted(data["many"])[min(int(share * 3000), 2999)]
