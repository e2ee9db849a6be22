"""Hand frames for the window operators (FIXTURES.md section 3)."""

from pyspark.sql import functions as F

from quarry.operators import timeseries as ts

DAY = 86400


def _series(spark, values, step=900):
    rows = [("s", i * step, i, len(values), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "series string, t long, slot long, n long, v double")


def test_window_count_strict_end(spark):
    # N=20, w=7, step=5 -> windows start at 0, 5, 10 (15 + 7 = 22 > 20; 10 + 7 = 17 < 20)
    df = _series(spark, [float(i) for i in range(20)])
    w = ts.sliding_windows(df, ["v"], configs=[(7, 5)])
    ks = sorted(r["k"] for r in w.select("k").distinct().collect())
    assert ks == [0, 1, 2]
    assert w.count() == 21


def test_window_count_formula(spark):
    for n, w_, s in [(7, 7, 1), (8, 7, 1), (30, 7, 1), (100, 15, 5), (100, 30, 10)]:
        df = _series(spark, [1.0] * n)
        k = ts.sliding_windows(df, ["v"], configs=[(w_, s)]).select("k").distinct().count()
        assert k == max(0, (n - w_ - 1) // s + 1)


def test_include_last(spark):
    df = _series(spark, [1.0] * 7)
    assert ts.sliding_windows(df, ["v"], configs=[(7, 1)]).count() == 0
    assert ts.sliding_windows(df, ["v"], configs=[(7, 1)], include_last=True).count() == 7


def test_gap_fill_linear_and_ends(spark):
    rows = [("s", 7, 1, 0, j, v) for j, v in enumerate([None, 1.0, None, 3.0, None])]
    win = spark.createDataFrame(rows, "series string, w int, step int, k long, j long, v double")
    out = ts.window_gap_fill(win, "v").orderBy("j").select("v").collect()
    assert [r["v"] for r in out] == [1.0, 1.0, 2.0, 3.0, 3.0]


def test_gap_fill_drops_empty_window(spark):
    rows = [("s", 7, 1, 0, j, None) for j in range(3)] + [("s", 7, 1, 1, j, 1.0) for j in range(3)]
    win = spark.createDataFrame(rows, "series string, w int, step int, k long, j long, v double")
    out = ts.window_gap_fill(win, "v")
    assert sorted({r["k"] for r in out.collect()}) == [1]


def test_tod_mean_fill(spark):
    # null at day 0, values 2 and 4 at +-15 days, 9 at 16 days -> 3
    base = 20 * DAY
    rows = [("s", base, None), ("s", base - 15 * DAY, 2.0), ("s", base + 15 * DAY, 4.0), ("s", base + 16 * DAY, 9.0)]
    df = spark.createDataFrame(rows, "series string, t long, v double")
    out = {r["t"]: r["v_filled"] for r in ts.tod_mean_fill(df, "v").collect()}
    assert out[base] == 3.0


def test_periodic_feature(spark):
    rows = [("s", 0, 1.0), ("s", DAY, None), ("s", 2 * DAY, 5.0)]
    df = spark.createDataFrame(rows, "series string, t long, v double")
    out = {r["t"]: r["periodic"] for r in ts.periodic_feature(df, "v").collect()}
    assert out[0] == 0.0          # no earlier instant
    assert out[2 * DAY] is None   # one earlier instant is null
    assert out[DAY] == 1.0


def test_slice_counts_half_open(spark):
    rows = [("2024-01-01 00:00:00",), ("2024-01-07 23:59:59",), ("2024-01-08 00:00:00",)]
    df = spark.createDataFrame(rows, "ts string").select(F.col("ts").cast("timestamp_ntz").alias("ts"))
    c = {r["slice"]: r["n"] for r in ts.slice_counts(df, "ts", [("w1", "2024-01-01", "2024-01-08")]).collect()}
    assert c == {"w1": 2}


def test_entry_independent_of_session_zone(spark):
    import __spark_entry__ as E
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        a = sorted(tuple(r) for r in E.entry(spark).collect())
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        b = sorted(tuple(r) for r in E.entry(spark).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert a == b and len(a) > 0


def test_unknown_attribute_rejected(spark):
    import pytest
    df = _series(spark, [1.0] * 10)
    with pytest.raises(ValueError):
        ts.sliding_windows(df, ["nope"])
