"""The scale helpers agree with their single-task definitions."""

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators.common import running_totals, top_k


def test_running_totals_match_global_window(spark):
    rng = np.random.default_rng(11)
    rows = [(float(s), int(a), int(b)) for s, a, b in zip(rng.permutation(2000), rng.integers(0, 5, 2000),
                                                          rng.integers(0, 3, 2000))]
    df = spark.createDataFrame(rows, "s double, a long, b long")
    got = {r["s"]: (r["cum_a"], r["cum_b"]) for r in running_totals(df, "s", ["a", "b"], buckets=7).collect()}
    w = Window.orderBy("s").rowsBetween(Window.unboundedPreceding, 0)
    want = {r["s"]: (r["ca"], r["cb"]) for r in df.select("s", F.sum("a").over(w).alias("ca"),
                                                           F.sum("b").over(w).alias("cb")).collect()}
    assert got == want
    desc = {r["s"]: r["cum_a"] for r in running_totals(df, "s", ["a"], buckets=5, descending=True).collect()}
    wd = Window.orderBy(F.col("s").desc()).rowsBetween(Window.unboundedPreceding, 0)
    assert desc == {r["s"]: r["c"] for r in df.select("s", F.sum("a").over(wd).alias("c")).collect()}


def test_top_k_matches_row_number(spark):
    rng = np.random.default_rng(4)
    rows = [(int(g), int(v), i) for i, (g, v) in enumerate(zip(rng.integers(0, 3, 3000), rng.integers(0, 100, 3000)))]
    df = spark.createDataFrame(rows, "g long, v long, id long")
    order = [F.col("v").desc(), F.col("id")]
    got = {(r["g"], r["rank"], r["id"]) for r in top_k(df, ["g"], order, 5, salt_on=["id"]).collect()}
    w = Window.partitionBy("g").orderBy(*order)
    want = {(r["g"], r["rank"], r["id"]) for r in df.withColumn("rank", F.row_number().over(w))
            .where("rank <= 5").collect()}
    assert got == want
