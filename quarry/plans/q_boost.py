"""Boosted trees: fits, folds, grid, modules, importances, attribution (K1,
K3, K4, K14-K17).  Fits have no SQL form; companions check what is exact about
them: folds, leaf values, sums of contributions, permuted columns."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ..operators import boosting as bo
from ..operators import classify as cl
from ..operators import evaluate as ev
from ..operators.encode import risk_band
from ..session import cut_lineage
from .q_models import _split
from .registry import register
from .sqlfix import DOC_SPLIT, with_

MODEL = bo.Params()  # 100 trees, depth 5, rate 0.1, samples of 0.8, positive weight 3
FOLDS = 10
SMALL = replace(MODEL, trees=20)  # where only what holds of any fit is looked at
# The grid's two numbers of trees (the other values are all 16 combinations;
# README on the time that larger numbers take).
GRID_TREES = (20, 50)
# Feature modules of the documents (K17): named subsets of the text features.
MODULES = {"all": tuple(cl.TEXT_FEATURES), "length": ("n_chars", "n_words", "n_lines"),
           "characters": ("upper_share", "digit_share", "punct_share"), "language": ("lang_code", "n_chars")}
METRICS = ["accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc"]


def _r(c, n=6):
    return F.round(c, n)


def _part(spark, sf_dir, split):
    return _split(spark, sf_dir).where(F.col("split") == split).drop("split")


def _folded(spark, sf_dir, k=FOLDS):
    return cut_lineage(ev.stratified_folds(_part(spark, sf_dir, "train"), "y", "doc_id", k=k))


def _fit_one(spark, sf_dir, params=MODEL):
    forest, state = bo.fit(_part(spark, sf_dir, "train"), "doc_id", "y", cl.TEXT_FEATURES, [params])
    state.unpersist()
    return forest


@register("gbt_predictions")
def gbt_predictions(spark, sf_dir):
    """K1 + K16: boosted trees trained on the stratified 80 %, predictions with
    probability, correctness and risk band on the held-out 20 %."""
    p = bo.predict(_fit_one(spark, sf_dir), _part(spark, sf_dir, "test"), "doc_id", ["y"])
    called = (F.col("probability") >= 0.5).cast("int")
    return p.select("doc_id", F.col("y").alias("true_label"), called.alias("predicted_label"),
                    _r(F.col("probability")).alias("probability"), (F.col("y") == called).alias("correct"),
                    risk_band(F.col("probability")).alias("risk_level"))


@register("gbt_importance")
def gbt_importance(spark, sf_dir):
    """Each feature's share of the trained model's gains, descending."""
    return _fit_one(spark, sf_dir).importance(spark).orderBy(F.col("importance").desc(), "feature")


def _cross_validated(spark, sf_dir, model=MODEL):
    params = [replace(model, fold=f) for f in range(FOLDS)]
    rows = _folded(spark, sf_dir)
    forest, state = bo.fit(rows, "doc_id", "y", cl.TEXT_FEATURES, params, "fold")
    return cut_lineage(bo.out_of_fold(state, params))


@register("gbt_cv")
def gbt_cv(spark, sf_dir):
    """K2 + K4: ten stratified folds on the training part, fitted together;
    metrics per fold, their mean and population std."""
    per = ev.grouped_metrics(_cross_validated(spark, sf_dir), ["fold"], score="probability")
    per = cut_lineage(per.select(F.col("fold").cast("string").alias("fold"), *METRICS))
    mean = per.agg(*[F.avg(c).alias(c) for c in METRICS]).withColumn("fold", F.lit("mean"))
    std = per.agg(*[F.stddev_pop(c).alias(c) for c in METRICS]).withColumn("fold", F.lit("std"))
    return per.unionByName(mean).unionByName(std)


FOLD_SQL = f"""
folds AS (SELECT *, (row_number() OVER (PARTITION BY y ORDER BY ('0x' || md5(doc_id || ':42')[1:12])::BIGINT, doc_id) - 1)
                    % {FOLDS} AS fold
          FROM doc_split WHERE split = 'train')"""


@register("gbt_fold_check", with_(DOC_SPLIT, FOLD_SQL) + """
SELECT fold::INTEGER AS fold, count(*) AS rows, sum(y)::BIGINT AS positives, sum(doc_id)::BIGINT AS ids,
       true AS in_range, true AS metrics_hold FROM folds GROUP BY fold""")
def gbt_fold_check(spark, sf_dir):
    """K4: every row is predicted once, by the model that has not seen its
    fold, and the reported accuracy and F1 are those of the prediction table."""
    rows = _cross_validated(spark, sf_dir, SMALL)
    called = F.col("probability") >= 0.5
    tp = F.count_if(called & (F.col("y") == 1))
    again = rows.where("model = fold").groupBy("fold").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("y").alias("positives"), F.sum("key").alias("ids"),
        F.min((F.col("probability") > 0) & (F.col("probability") < 1)).alias("in_range"),
        F.avg((called == (F.col("y") == 1)).cast("double")).alias("_a"),
        (2 * tp / (F.count_if(called) + F.count_if(F.col("y") == 1))).alias("_f"))
    told = ev.grouped_metrics(rows, ["fold"], score="probability").select("fold", "accuracy", "f1")
    holds = (F.abs(F.col("accuracy") - F.col("_a")) < 1e-9) & (F.abs(F.col("f1") - F.col("_f")) < 1e-9)
    return again.join(told, "fold").select("fold", "rows", "positives", "ids", "in_range", holds.alias("metrics_hold"))


@register("gbt_leaf_check", with_(DOC_SPLIT) + """
SELECT tree::INTEGER AS tree, rows, 0 AS wrong FROM range(0, 3) AS t(tree),
       (SELECT count(*) AS rows FROM doc_split WHERE split = 'train')""")
def gbt_leaf_check(spark, sf_dir):
    """K1: every leaf's value recomputed from the rows that reach it, with L1
    and L2 penalties: rows per tree and leaves that differ."""
    params = bo.Params(trees=3, depth=4, subsample=1.0, colsample=1.0, l1=0.5, l2=2.0, gamma=0.1)
    train = _part(spark, sf_dir, "train")
    forest, _ = bo.fit(train, "doc_id", "y", cl.TEXT_FEATURES, [params])
    n = len(cl.TEXT_FEATURES)

    def leaves(batches):
        for batch in batches:
            bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, n)
            y, margin = batch.column("y").to_numpy(), np.zeros((len(bins), 1))
            for t, tree in enumerate(forest.trees):
                leaf = tree.walk(bins, np.zeros((len(bins), 1), np.int64), tree.depth)[:, 0]
                q = 1 / (1 + np.exp(-margin[:, 0]))
                w = np.where(y == 1, params.pos_weight, 1.0)
                yield pa.RecordBatch.from_pydict({"tree": np.full(len(y), t, np.int32), "leaf": leaf, "g": w * (q - y),
                                                  "h": w * q * (1 - q), "value": tree.value[0, leaf]})
                margin = margin + tree.value[0, leaf][:, None]

    rows = forest.binned(train, ["y"]).mapInArrow(leaves, "tree int, leaf long, g double, h double, value double")
    g, h = F.col("g"), F.col("h")
    want = -F.signum(g) * F.greatest(F.abs(g) - params.l1, F.lit(0.0)) / (h + params.l2) * params.rate
    by_leaf = rows.groupBy("tree", "leaf", "value").agg(F.sum("g").alias("g"), F.sum("h").alias("h"),
                                                        F.count(F.lit(1)).alias("n"))
    return by_leaf.groupBy("tree").agg(F.sum("n").alias("rows"),
                                       F.count_if(F.abs(F.col("value") - want) > 1e-9).cast("int").alias("wrong"))


@register("grid_search")
def grid_search(spark, sf_dir):
    """K3: depth x rate x gamma x number of trees, 32 points on ten folds, all
    320 models fitted together; mean ROC AUC and mean of the largest F1."""
    points = bo.grid(MODEL, depth=(2, 4, 6, 8), rate=(0.01, 0.1), gamma=(0.0, 0.5), trees=GRID_TREES)
    params = [replace(p, fold=f) for p in points for f in range(FOLDS)]
    _, state = bo.fit(_folded(spark, sf_dir), "doc_id", "y", cl.TEXT_FEATURES, params, "fold")
    rows = bo.out_of_fold(state, params).withColumn("point", (F.col("model") / FOLDS).cast("int"))
    per = ev.grouped_metrics(rows, ["point", "fold"], score="probability").groupBy("point").agg(
        F.avg("roc_auc").alias("roc_auc"), F.avg("max_f1").alias("max_f1"))
    got = {r["point"]: (r["roc_auc"], r["max_f1"]) for r in per.collect()}  # a row per grid point
    best = max(got, key=lambda i: (got[i][1], -i))
    return spark.createDataFrame(
        [(p.depth, p.rate, p.gamma, p.trees, *got[i], i == best) for i, p in enumerate(points)],
        "max_depth int, step_size double, gamma double, trees int, roc_auc double, max_f1 double, best boolean")


@register("module_classification")
def module_classification(spark, sf_dir):
    """Per feature module a grid of depth and rate on ten folds, all
    modules fitted together; the point with the best mean F1, its threshold on
    the out-of-fold predictions, and the metrics and cells there."""
    points = [(m, replace(p, columns=c)) for m, c in MODULES.items()
              for p in bo.grid(replace(MODEL, trees=GRID_TREES[1]), depth=(2, 4), rate=(0.01, 0.1))]
    params = [replace(p, fold=f) for _, p in points for f in range(FOLDS)]
    _, state = bo.fit(_folded(spark, sf_dir), "doc_id", "y", cl.TEXT_FEATURES, params, "fold")
    rows = cut_lineage(bo.out_of_fold(state, params).withColumn("point", (F.col("model") / FOLDS).cast("int")))
    per = ev.grouped_metrics(rows, ["point", "fold"], score="probability").groupBy("point").agg(
        F.avg("max_f1").alias("f1"))
    mean = {r["point"]: r["f1"] for r in per.collect()}
    chosen = {m: max((i for i, (x, _) in enumerate(points) if x == m), key=lambda i: (mean[i], -i)) for m in MODULES}
    named = F.create_map(*[F.lit(x) for m, i in chosen.items() for x in (i, m)])
    at = {i: points[i][1] for i in chosen.values()}
    best = rows.where(F.col("point").isin(*at)).withColumn("module", F.element_at(named, F.col("point")))
    whole = ev.grouped_metrics(best, ["module"], score="probability").select("module", "roc_auc", "pr_auc", "max_f1",
                                                                             "threshold")
    whole = spark.createDataFrame([tuple(r) for r in whole.collect()], whole.schema)  # a row per module
    t, p = F.col("y") == 1, F.round("probability", 6) >= F.col("threshold")
    cells = best.join(F.broadcast(whole.select("module", "threshold")), "module").groupBy("module").agg(
        F.count_if(~t & ~p).alias("tn"), F.count_if(~t & p).alias("fp"), F.count_if(t & ~p).alias("fn"),
        F.count_if(t & p).alias("tp"))
    depth = F.create_map(*[F.lit(x) for m, i in chosen.items() for x in (m, at[i].depth)])
    rate = F.create_map(*[F.lit(x) for m, i in chosen.items() for x in (m, at[i].rate)])
    return whole.join(cells, "module").select(
        "module", F.element_at(depth, F.col("module")).alias("max_depth"),
        F.element_at(rate, F.col("module")).alias("step_size"), "roc_auc", "pr_auc", "max_f1", "threshold", "tn", "fp",
        "fn", "tp")


def _contributions(spark, sf_dir):
    return bo.predict(_fit_one(spark, sf_dir, SMALL), _part(spark, sf_dir, "test"), "doc_id", ["y"], attribution=True)


@register("attribution_check", with_(DOC_SPLIT) + """
SELECT count(*) AS rows, sum(doc_id)::BIGINT AS ids, 0 AS off FROM doc_split WHERE split = 'test'""")
def attribution_check(spark, sf_dir):
    """Base and contributions add up to the margin on every row."""
    rows = _contributions(spark, sf_dir)
    total = sum((F.col(f"contrib_{c}") for c in cl.TEXT_FEATURES), F.col("base"))
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.sum("doc_id").alias("ids"),
                    F.count_if(F.abs(total - F.col("margin")) > 1e-9).cast("int").alias("off"))


@register("attribution_rows")
def attribution_rows(spark, sf_dir):
    """Per scored row its margin, base and a contribution per feature."""
    rows = _contributions(spark, sf_dir)
    return rows.select("doc_id", *[_r(F.col(c)).alias(c) for c in rows.columns if c == "margin" or c == "base"
                                   or c.startswith("contrib_")])


@register("attribution_mean")
def attribution_mean(spark, sf_dir):
    """Mean absolute contribution per feature, largest first."""
    rows = _contributions(spark, sf_dir)
    means = rows.agg(*[F.avg(F.abs(F.col(f"contrib_{c}"))).alias(c) for c in cl.TEXT_FEATURES])
    return means.unpivot([], cl.TEXT_FEATURES, "feature", "mean_abs").orderBy(F.col("mean_abs").desc(), "feature")


@register("permutation_check", with_(DOC_SPLIT) + "\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, count(*) AS rows, count(DISTINCT {c}) AS values, round(sum({c}), 6) AS total, "
    f"round(sum({c} * {c}), 4) AS squares FROM doc_split WHERE split = 'test'" for c in cl.TEXT_FEATURES))
def permutation_check(spark, sf_dir):
    """A permuted column holds the values it held."""
    rows = ev.permuted(_part(spark, sf_dir, "test"), "doc_id", cl.TEXT_FEATURES)
    long = rows.unpivot(["doc_id"], [f"{c}_permuted" for c in cl.TEXT_FEATURES], "feature", "x")
    return long.groupBy(F.regexp_replace("feature", "_permuted$", "").alias("feature")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("x").alias("values"), _r(F.sum("x")).alias("total"),
        _r(F.sum(F.col("x") * F.col("x")), 4).alias("squares"))


@register("permutation_importance")
def permutation_importance(spark, sf_dir):
    """K14, no refit: what ROC AUC on the held-out part loses when a feature's
    values are permuted; a constant feature loses nothing."""
    forest = _fit_one(spark, sf_dir, SMALL)
    rows = cut_lineage(ev.permuted(_part(spark, sf_dir, "test"), "doc_id", cl.TEXT_FEATURES))
    frames = [rows.select("doc_id", "y", F.lit(c or "").alias("feature"), *[
        F.col(f"{x}_permuted" if x == c else x).alias(x) for x in cl.TEXT_FEATURES]) for c in (None, *cl.TEXT_FEATURES)]
    every = frames[0]
    for f in frames[1:]:
        every = every.unionByName(f)
    auc = ev.grouped_metrics(bo.predict(forest, every, "doc_id", ["y", "feature"]), ["feature"], score="probability")
    auc = cut_lineage(auc.select("feature", "roc_auc"))
    base = auc.where("feature = ''").first()["roc_auc"]
    return auc.where("feature <> ''").select("feature", (F.lit(base) - F.col("roc_auc")).alias("auc_drop")).orderBy(
        F.col("auc_drop").desc(), "feature")
