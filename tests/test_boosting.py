"""Boosted trees against a plain booster over the same bins, and what must
hold of folds, penalties, attribution and permutation."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import boosting as bo
from quarry.operators import evaluate as ev

COLS = ["a", "b", "c"]


def data(spark, n=240, seed=3):
    rnd = np.random.default_rng(seed)
    x = rnd.normal(size=(n, 3)).round(2)
    y = (x[:, 0] + x[:, 1] ** 2 + rnd.normal(0, 0.7, n) > 0.8).astype(int)
    rows = [(i * 3 + 1, int(y[i]), i % 4, *(None if (i + j) % 17 == 0 else float(v) for j, v in enumerate(x[i])))
            for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, y int, fold int, a double, b double, c double").repartition(3)


def plain_fit(rows, edges, p):
    """One model by plain loops over nodes, features and bins."""
    bins = np.array([[0 if v is None else 1 + int(sum(v > e for e in edges[j])) for j, v in enumerate(r[3:])]
                     for r in rows])
    y = np.array([r[1] for r in rows])
    use = np.array([r[2] != p.fold for r in rows])
    w = np.where(y == 1, p.pos_weight, 1.0) * use
    margin = np.zeros(len(rows))
    t = lambda g: np.sign(g) * max(abs(g) - p.l1, 0)
    for _ in range(p.trees):
        q = 1 / (1 + np.exp(-margin))
        g, h = w * (q - y), w * q * (1 - q)
        step = np.zeros(len(rows))
        todo = [(np.arange(len(rows)), 0)]
        while todo:
            at, level = todo.pop()
            total_g, total_h = g[at].sum(), h[at].sum()
            best = (1e-10, None)
            if level < p.depth and total_h > 0:
                for j in range(3):
                    for b in range(bo.BINS + 1):
                        left = at[bins[at, j] <= b]
                        gl, hl = g[left].sum(), h[left].sum()
                        gr, hr = total_g - gl, total_h - hl
                        if hl < p.min_child or hr < p.min_child:
                            continue
                        gain = 0.5 * (t(gl) ** 2 / (hl + p.l2) + t(gr) ** 2 / (hr + p.l2)
                                      - t(total_g) ** 2 / (total_h + p.l2)) - p.gamma
                        if gain > best[0] + 1e-12:
                            best = (gain, (j, b))
            if best[1] is None:
                step[at] = -t(total_g) / (total_h + p.l2) * p.rate
            else:
                j, b = best[1]
                todo += [(at[bins[at, j] <= b], level + 1), (at[bins[at, j] > b], level + 1)]
        margin = margin + step
    return {r[0]: m for r, m in zip(rows, margin, strict=True)}


def margins(state, models):
    return [{r["key"]: np.frombuffer(r["margin"])[m] for r in state.collect()} for m in range(models)]


def test_models_fitted_together_equal_plain_ones(spark):
    rows, df = data(spark)
    base = bo.Params(trees=3, depth=3, subsample=1.0, colsample=1.0, rate=0.3)
    from dataclasses import replace
    params = [base, replace(base, fold=1, depth=2), replace(base, fold=3, l1=1.0, l2=3.0), replace(base, gamma=2.0, trees=2),
              replace(base, min_child=6.0, pos_weight=1.0)]
    forest, state = bo.fit(df, "id", "y", COLS, params, "fold")
    for got, p in zip(margins(state, len(params)), params, strict=True):
        want = plain_fit(rows, forest.edges, p)
        assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in want) < 1e-9


def test_margins_are_written_on_the_way(spark, monkeypatch):
    """The same whether margins are written after every tree or at the end, and
    wherever the rows are."""
    _, df = data(spark, 80)
    params = [bo.Params(trees=5, depth=2, subsample=0.7, colsample=0.7)]
    whole = margins(bo.fit(df, "id", "y", COLS, params)[1], 1)[0]
    monkeypatch.setattr(bo, "CUT_EVERY", 1)
    step = margins(bo.fit(df.coalesce(1), "id", "y", COLS, params)[1], 1)[0]
    assert whole.keys() == step.keys() and all(abs(whole[k] - step[k]) < 1e-9 for k in whole)


def test_columns_of_a_module_only(spark):
    _, df = data(spark, 120)
    forest, _ = bo.fit(df, "id", "y", COLS, [bo.Params(trees=4, columns=("b",)), bo.Params(trees=4)])
    shares = {r["feature"]: r["importance"] for r in forest.importance(df.sparkSession, 0).collect()}
    assert shares == {"a": 0.0, "b": 1.0, "c": 0.0}
    table = forest.table(df.sparkSession, 1)
    assert table.where("tree = 0 AND node = 0").count() == 1 and table.where("gain <= 0").count() == 0


def test_attribution_adds_up_and_ignores_unused_features(spark):
    _, df = data(spark, 120)
    forest, state = bo.fit(df, "id", "y", COLS, [bo.Params(trees=6, depth=3, columns=("a", "b"))])
    rows = bo.predict(forest, df, "id", ["y"], attribution=True).collect()
    trained = margins(state, 1)[0]
    for r in rows:
        assert abs(r["base"] + r["contrib_a"] + r["contrib_b"] + r["contrib_c"] - r["margin"]) < 1e-9
        assert r["contrib_c"] == 0.0 and abs(trained[r["id"]] - r["margin"]) < 1e-9


def test_every_row_is_out_of_one_fold(spark):
    _, df = data(spark, 80)
    params = [bo.Params(trees=2, depth=2, fold=f) for f in range(4)]
    _, state = bo.fit(df, "id", "y", COLS, params, "fold")
    rows = bo.out_of_fold(state, params).collect()
    assert len(rows) == 80 and all(r["model"] == r["fold"] for r in rows) and len({r["key"] for r in rows}) == 80


def test_metrics_of_groups(spark):
    rnd = np.random.default_rng(1)
    rows = [(g, int(rnd.random() < 0.4), float(rnd.choice([0.1, 0.3, 0.5, 0.7, round(rnd.random(), 3)]))) for g in (1, 2, 3)
            for _ in range(60)]
    got = {r["g"]: r for r in ev.grouped_metrics(spark.createDataFrame(rows, "g int, y int, score double"), ["g"]).collect()}
    for g in (1, 2, 3):
        y, s = (np.array([r[i] for r in rows if r[0] == g]) for i in (1, 2))
        pairs = s[y == 1][:, None] - s[y == 0][None]
        assert abs(got[g]["roc_auc"] - ((pairs > 0) + 0.5 * (pairs == 0)).mean()) < 1e-9
        f1 = {t: 2 * (y[s >= t] == 1).sum() / ((s >= t).sum() + y.sum()) for t in s}
        best = max(f1.values())
        assert abs(got[g]["max_f1"] - best) < 1e-6 and abs(f1[got[g]["threshold"]] - best) < 1e-9
        assert abs(got[g]["accuracy"] - ((s >= 0.5) == y).mean()) < 1e-9


def test_permuted_columns_keep_their_values(spark):
    rows = [(i, i * i, i % 3) for i in range(50)]
    df = spark.createDataFrame(rows, "id long, a long, b long")
    got = ev.permuted(df, "id", ["a", "b"]).collect()
    assert sorted(r["a_permuted"] for r in got) == sorted(r[1] for r in rows)
    assert sorted((r["id"], r["a"], r["b"]) for r in got) == rows
    assert sum(r["a"] == r["a_permuted"] for r in got) < 5
    one = ev.permuted(df.where("id = 7"), "id", ["a"]).collect()
    assert [(r["id"], r["a_permuted"]) for r in one] == [(7, 49)]


@pytest.mark.parametrize("value", [None, float("nan")])
def test_null_features_go_left(spark, value):
    _, df = data(spark, 60)
    forest, _ = bo.fit(df, "id", "y", COLS, [bo.Params(trees=2, depth=2)])
    odd = spark.createDataFrame([(1, value, value, value), (2, -1e9, -1e9, -1e9)], "id long, a double, b double, c double")
    a, b = (r["margin"] for r in bo.predict(forest, odd, "id").orderBy("id").collect())
    assert a == b


def test_a_constant_feature_loses_nothing(spark):
    """Permuting it changes no score, whatever the model."""
    _, df = data(spark, 100)
    df = df.withColumn("c", F.lit(1.5))
    forest, _ = bo.fit(df, "id", "y", COLS, [bo.Params(trees=4, depth=3)])
    turned = ev.permuted(df, "id", ["c", "a"])
    before = {r["id"]: r["margin"] for r in bo.predict(forest, df, "id").collect()}
    same = bo.predict(forest, turned.drop("c").withColumnRenamed("c_permuted", "c"), "id").collect()
    other = bo.predict(forest, turned.drop("a").withColumnRenamed("a_permuted", "a"), "id").collect()
    assert all(before[r["id"]] == r["margin"] for r in same)
    assert any(before[r["id"]] != r["margin"] for r in other)


def test_grid_makes_all_combinations():
    made = bo.grid(bo.Params(), depth=(2, 4), rate=(0.1,), gamma=(0.0, 0.5))
    assert len(made) == 4 and {(p.depth, p.gamma) for p in made} == {(2, 0.0), (2, 0.5), (4, 0.0), (4, 0.5)}
    assert all(p.trees == 100 for p in made) and F is not None


def test_all_levels_in_a_stage_equal_a_job_each(spark, monkeypatch):
    """The same trees and margins, in a number of jobs that the levels do not
    raise; models that differ in the number of trees only share them."""
    from dataclasses import replace
    _, df = data(spark)
    base = bo.Params(trees=6, depth=4, subsample=0.8, colsample=0.7, rate=0.3)
    params = [base, replace(base, trees=2), replace(base, fold=2, depth=2), replace(base, min_child=5.0, columns=("a", "c"))]
    spark.sparkContext.setJobGroup("gang", "levels in one stage")
    try:
        forest, state = bo.fit(df, "id", "y", COLS, params, "fold")
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("gang"))
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert jobs < 24  # six trees of four levels
    monkeypatch.setattr(bo, "slots", lambda spark: 0)
    other, each = bo.fit(df, "id", "y", COLS, params, "fold")
    for a, b in zip(margins(state, 4), margins(each, 4), strict=True):
        assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)
    for m, p in enumerate(params):
        for a, b in zip(forest.trees[:p.trees], other.trees[:p.trees], strict=True):
            assert (a.feature[m] == b.feature[m]).all() and (a.bin[m] == b.bin[m]).all()
            assert np.allclose(a.value[m], b.value[m]) and np.allclose(a.cover[m], b.cover[m])


def test_more_tasks_than_rows(spark):
    """Tasks of a stage without rows keep step with the others."""
    _, df = data(spark, 3)
    _, state = bo.fit(df, "id", "y", COLS, [bo.Params(trees=2, depth=2, min_child=0.01)])
    assert state.count() == 3


def test_models_take_turns_where_memory_is_short(spark, monkeypatch):
    """More rows than a task can hold with all models: a stage after the other,
    the same trees and margins to the bit, and no job a level."""
    from dataclasses import replace
    _, df = data(spark)
    base = bo.Params(trees=6, depth=4, subsample=0.8, colsample=0.7, rate=0.3)
    params = [base, replace(base, fold=2, depth=2, trees=4), replace(base, trees=2), replace(base, min_child=5.0)]
    forest, state = bo.fit(df, "id", "y", COLS, params, "fold")
    rows = 240 // bo.slots(spark)
    monkeypatch.setattr(bo, "GANG_BYTES", rows * (9 * 3 + 40 + 8 * 4 + 44))
    spark.sparkContext.setJobGroup("turns", "a stage a model")
    try:
        other, each = bo.fit(df, "id", "y", COLS, params, "fold")
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("turns"))
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert bo._at_once(rows, 3, 4) == 1 and jobs < 24  # six trees of four levels
    assert margins(state, 4) == margins(each, 4)
    for a, b in zip(forest.trees, other.trees, strict=True):
        assert all((getattr(a, c) == getattr(b, c)).all() for c in ("feature", "bin", "value", "cover", "gain"))
