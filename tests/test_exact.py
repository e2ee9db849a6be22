"""Ranks between sketch bounds, Student's t tail, Ward's linkage, one-hot
baskets: against plain computations."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions.stats import log_gamma, t_tail, t_two_sided_p
from quarry.operators import cluster, common, evaluate, mining, quantile

QS = (0.0, 0.01, 0.25, 0.5, 1 / 3, 0.75, 0.99, 1.0)


@pytest.mark.parametrize("accuracy", [10_000, 40])
@pytest.mark.parametrize("kind", ["ties", "normal", "skewed"])
def test_quantiles_of_rows(spark, monkeypatch, accuracy, kind):
    """A coarse sketch makes most rows lie outside the bounds."""
    monkeypatch.setattr(quantile, "ACCURACY", accuracy)
    rnd = np.random.default_rng(5)
    draw = {"ties": lambda n: rnd.integers(0, 9, n) * 1.0, "normal": lambda n: rnd.normal(size=n),
            "skewed": lambda n: np.exp(rnd.normal(0, 3, n))}[kind]
    values = {"x": draw(3000), "y": draw(7), "z": draw(1), "w": draw(41)}
    rows = [(k, float(v)) for k, vs in values.items() for v in vs] + [("x", None), ("none", None)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(4)
    got = {r["k"]: r for r in quantile.row_quantiles(df, ["k"], QS).collect()}
    assert got.keys() == values.keys()
    for k, v in values.items():
        assert got[k]["total"] == len(v) and (got[k]["mn"], got[k]["mx"]) == (v.min(), v.max())
        assert np.allclose(got[k]["q"], np.quantile(v, QS), rtol=1e-12, atol=1e-12)
    every = np.concatenate(list(values.values()))
    assert np.allclose(quantile.quantile_row(df, "x", QS), np.quantile(every, QS), rtol=1e-12, atol=1e-12)
    for share in (0.0, 0.5, 0.95, 1.0):
        want = np.sort(every)[min(int(share * len(every)), len(every) - 1)]
        assert quantile.order_statistic(df, "x", share).first()["value"] == want


def test_quantiles_of_nothing(spark):
    none = spark.createDataFrame([(None,)], "x double")
    assert quantile.quantile_row(none, "x", QS) == [None] * len(QS)
    assert quantile.order_statistic(none, "x", 0.5).collect() == []
    assert quantile.row_quantiles(none.withColumn("k", F.lit(1)), ["k"], QS).collect() == []


def test_quantile_plans(spark, capsys):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").cast("double").alias("x"))
    quantile.row_quantiles(df, [], QS).explain()
    quantile.row_quantiles(df, ["k"], QS).explain()
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_log_gamma_and_t_tail(spark):
    xs = [0.5, 1.0, 1.5, 2.0, 7.25, 100.5, 30000.0]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").select(log_gamma(F.col("x"))).collect()]
    assert np.allclose(got, [math.lgamma(x) for x in xs], rtol=1e-12, atol=1e-11)

    def density(v, df):
        return math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(df * math.pi) * (
            1 + v * v / df) ** (-(df + 1) / 2)

    cases = [(t, df) for t in (0.0, 0.3, -1.0, 2.5, 9.0) for df in (1.0, 2.5, 10.0, 400.0)]
    frame = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, t double, df double")
    got = [r[0] for r in frame.orderBy("i").select(t_tail(F.col("t"), F.col("df"))).collect()]
    for p, (t, df) in zip(got, cases, strict=True):
        v = np.linspace(0, abs(t), 20001)
        d = [density(x, df) for x in v]
        assert abs(p - (1 - 2 * np.trapezoid(d, v))) < 1e-7 and abs(p - t_two_sided_p(t, df)) < 1e-10
    odd = spark.createDataFrame([(None, 1.0), (1.0, None), (1.0, 0.0)], "t double, df double")
    assert [r[0] for r in odd.select(t_tail(F.col("t"), F.col("df"))).collect()] == [None] * 3


def plain_ward(cent, weights):
    """All pairs at every step."""
    parts = {i: (np.array(c, float), float(w)) for i, (c, w) in enumerate(zip(cent, weights, strict=True))}
    out = []
    for step in range(len(cent) - 1):
        best = min((math.sqrt(2 * wa * wb / (wa + wb)) * np.linalg.norm(ca - cb), a, b) for a, (ca, wa) in parts.items()
                   for b, (cb, wb) in parts.items() if a < b)
        h, a, b = best
        (ca, wa), (cb, wb) = parts.pop(a), parts.pop(b)
        parts[len(cent) + step] = ((ca * wa + cb * wb) / (wa + wb), wa + wb)
        out.append((a, b, h, wa + wb))
    return np.array(out)


@pytest.mark.parametrize("n", [2, 3, 17, 40])
def test_linkage_equals_all_pairs(n):
    rnd = np.random.default_rng(n)
    cent, weights = rnd.normal(size=(n, 4)), rnd.integers(1, 9, n)
    links, want = cluster.ward_linkage(cent, weights), plain_ward(cent, weights)
    assert np.allclose(links, want) and (np.diff(links[:, 2]) >= -1e-12).all()
    for k in (1, 2, min(5, n), n):
        label = cluster.cut_linkage(links, n, k)
        group = {i: {i} for i in range(n)}
        for step, (a, b, _, _) in enumerate(want[:n - k]):
            group[n + step] = group.pop(int(a)) | group.pop(int(b))
        assert {frozenset(np.flatnonzero(label == x).tolist()) for x in set(label)} == set(map(frozenset, group.values()))


def test_one_hot_baskets(spark):
    rows = [(1, ["a", "b"]), (2, ["b", "c", "d"]), (3, ["b"]), (4, [])]
    df = spark.createDataFrame(rows, "tid int, items array<string>")
    model, encoded = mining.encode_baskets(df)
    assert model.vocabulary[0] == "b"
    assert {r["item"]: r["n"] for r in mining.encoded_item_sums(model, encoded).collect()} == {"a": 1, "b": 3, "c": 1, "d": 1}
    assert {r["tid"]: r["size"] for r in mining.encoded_sizes(encoded).collect()} == {1: 2, 2: 3, 3: 1, 4: 0}
    with pytest.raises(ValueError):
        mining.encode_baskets(df, vocabulary=4)


def test_adaptive_support_falls_back(spark):
    """No pair reaches 10 of 12 baskets, so the second support (5 of 12) holds."""
    rows = [(i, ["a", "b"] if i < 6 else ["c", f"x{i}"]) for i in range(12)]
    df = spark.createDataFrame(rows, "tid int, items array<string>").withColumn("size", F.size("items"))
    got = {tuple(r["items"]): r["count"] for r in mining.adaptive_itemsets(df, 2).collect()}
    assert got == {("a",): 6, ("b",): 6, ("c",): 6, ("a", "b"): 6}
    stats = mining.basket_stats(df).first()
    assert (stats["baskets"], stats["mean_len"], stats["max_len"], stats["distinct_items"]) == (12, 2.0, 2, 9)
    assert mining.basket_stats(df.where("tid < 0")).first()["baskets"] == 0


@pytest.mark.parametrize("bounds", [[], [0.0], [-1.0, 0.0, 2.5, 7.0]])
def test_buckets_by_binary_search(spark, bounds):
    xs = [-5.0, -1.0, -0.5, 0.0, 2.5, 2.6, 7.0, 9.0, None, float("nan")]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double")
    got = [r["b"] for r in common.in_buckets(df, "x", bounds, "b").orderBy("i").collect()]
    assert got == [0 if x is None or x != x else sum(b <= x for b in bounds) for x in xs]


def test_silhouette_of_pairs(spark):
    rnd = np.random.default_rng(2)
    v, label = rnd.normal(size=(40, 3)), rnd.integers(0, 3, 40)
    d = ((v[:, None] - v[None]) ** 2).sum(axis=2)
    s = []
    for i in range(40):
        a = d[i][label == label[i]].sum() / (sum(label == label[i]) - 1)
        b = min(d[i][label == x].mean() for x in set(label.tolist()) - {label[i]})
        s.append((b - a) / max(a, b))
    df = spark.createDataFrame([(int(x), r.tolist()) for x, r in zip(label, v, strict=True)], "label int, v array<double>")
    assert abs(evaluate.silhouette(df, "label", "v") - np.mean(s)) < 1e-9
