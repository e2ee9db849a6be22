"""Association rules, curves and fold helpers against brute force."""

import itertools
import math

import numpy as np
from pyspark.sql import functions as F

from quarry.operators import evaluate as ev
from quarry.operators import mining as mi

BASKETS = [["a", "b", "c"], ["a", "b"], ["a", "c"], ["b", "c"], ["a", "b", "c", "d"], ["a", "d"]]


def _bdf(spark):
    rows = [(i, it) for i, b in enumerate(BASKETS) for it in b]
    return mi.baskets(spark.createDataFrame(rows, "tid long, item string"))


def _brute_itemsets(min_support, max_len):
    n = len(BASKETS)
    items = sorted({i for b in BASKETS for i in b})
    out = {}
    for k in range(1, max_len + 1):
        for combo in itertools.combinations(items, k):
            c = sum(1 for b in BASKETS if set(combo) <= set(b))
            if c / n >= min_support:
                out[combo] = c
    return out


def test_apriori_matches_brute_force(spark):
    got = {tuple(r["items"]): r["count"] for r in mi.apriori(_bdf(spark), 0.3, 3).collect()}
    assert got == _brute_itemsets(0.3, 3)


def test_fpgrowth_equals_apriori(spark):
    b = _bdf(spark)
    a = {tuple(r["items"]): r["count"] for r in mi.apriori(b, 0.3, 3).collect()}
    f = {tuple(r["items"]): r["count"] for r in mi.fpgrowth(b, 0.3, 3).collect()}
    assert a == f


def test_rules_all_splits_and_conviction(spark):
    fi = mi.apriori(_bdf(spark), 0.3, 3)
    r = mi.association_rules(fi, "confidence", 0.0).collect()
    sets = _brute_itemsets(0.3, 3)
    n_expected = sum(2 ** len(s) - 2 for s in sets if len(s) >= 2)
    assert len(r) == n_expected
    for row in r:
        if row["confidence"] >= 1.0:
            assert math.isinf(row["conviction"])
        a, c = tuple(row["antecedents"]), tuple(row["consequents"])
        x = tuple(sorted(a + c))
        assert abs(row["confidence"] - sets[x] / sets[a]) < 1e-12


def test_curve_auc_matches_mann_whitney(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 300)
    s = np.round(rng.normal(size=300) + y, 1)          # many ties
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, score double")
    auc = ev.auc_from_curve(ev.score_curve(df)).first()["roc_auc"]
    pos, neg = s[y == 1], s[y == 0]
    mw = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert abs(auc - mw) < 1e-12


def test_stratified_folds_sizes(spark):
    rows = [(i, 1 if i % 7 == 0 else 0) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, y int")
    f = ev.stratified_folds(df, "y", "id", k=10).groupBy("y", "fold").count().collect()
    for cls in (0, 1):
        sizes = [r["count"] for r in f if r["y"] == cls]
        assert max(sizes) - min(sizes) <= 1
    assert sum(r["count"] for r in f) == 1000


def test_confusion_zero_division(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "y int, yhat int")
    m = ev.binary_metrics(ev.confusion(df, "y", "yhat")).first()
    assert m["precision"] == 0.0 and m["f1"] == 0.0


def test_t_pvalue_reference_value():
    from quarry.functions.stats import t_two_sided_p
    # t = 2.0, df = 10 -> two-sided p = 0.07338803477...
    assert abs(t_two_sided_p(2.0, 10.0) - 0.0733880347707) < 1e-9
    assert abs(t_two_sided_p(0.0, 5.0) - 1.0) < 1e-12


def test_fanout_aggregate_equals_materialised_join(spark):
    rows = [(1, "a", 1), (1, "b", 0), (2, "a", 1), (2, "a", 0), (3, "b", 1)]
    o = spark.createDataFrame(rows, "code long, priority string, deceased int")
    pairs = o.alias("x").join(o.alias("y"), "code").groupBy(F.col("x.priority")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("y.deceased").alias("d"))
    want = {r[0]: (r["n"], r["d"]) for r in pairs.collect()}
    a = o.groupBy("code", "priority").agg(F.count(F.lit(1)).alias("na"))
    b = o.groupBy("code").agg(F.count(F.lit(1)).alias("nb"), F.sum("deceased").alias("db"))
    got = {r[0]: (r["n"], r["d"]) for r in a.join(b, "code").groupBy("priority").agg(
        F.sum(F.col("na") * F.col("nb")).alias("n"), F.sum(F.col("na") * F.col("db")).alias("d")).collect()}
    assert got == want
