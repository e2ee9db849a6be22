"""Model-free evaluation kernels on given labels and scores (K2, K5, K7,
K9-K13, A26, A33, C3).

Curves are built over the *distinct* scores: a grouped count per score (map
side combined), then running totals by the bucketed prefix sum of
``common.running_totals`` - no global window, no collect.  ROC AUC is the
trapezoid of that curve, equal to the Mann-Whitney statistic with ties
averaged; PR AUC is the trapezoid over recall with the (0, 1) start point.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import join_small, long_form, running_totals, stats_row


# ---------------------------------------------------------------- curves

def score_curve(df: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    """Per distinct score (descending): pos, neg, cum_pos / cum_neg (score >= s),
    and the class totals P, N as columns."""
    d = cut_lineage(df.groupBy(score).agg(F.sum(F.col(y)).cast("bigint").alias("pos"),
                                          F.sum(1 - F.col(y)).cast("bigint").alias("neg")))
    tot = stats_row(d, P=F.sum("pos"), N=F.sum("neg"))
    c = running_totals(d, score, ["pos", "neg"], descending=True)
    return c.withColumn("P", tot["P"]).withColumn("N", tot["N"])


def roc_points(curve: DataFrame, score: str = "score") -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score."""
    return curve.select(F.col(score).alias("threshold"), (F.col("cum_neg") / F.col("N")).alias("fpr"),
                        (F.col("cum_pos") / F.col("P")).alias("tpr"))


def pr_points(curve: DataFrame, score: str = "score") -> DataFrame:
    """(threshold, precision, recall) for every distinct score."""
    return curve.select(F.col(score).alias("threshold"),
                        (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
                        (F.col("cum_pos") / F.col("P")).alias("recall"))


def auc_from_curve(curve: DataFrame) -> DataFrame:
    """ROC AUC and PR AUC (trapezoid rules) in one aggregation."""
    P, N = F.col("P"), F.col("N")
    roc = F.col("neg") / N * (2 * F.col("cum_pos") - F.col("pos")) / (2 * P)
    tp0 = F.col("cum_pos") - F.col("pos")
    fp0 = F.col("cum_neg") - F.col("neg")
    prec = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    prec0 = F.when(tp0 + fp0 == 0, F.lit(1.0)).otherwise(tp0 / (tp0 + fp0))
    pr = (F.col("pos") / P) * (prec + prec0) / 2
    return curve.agg(F.sum(roc).alias("roc_auc"), F.sum(pr).alias("pr_auc"))


def best_f1_threshold(curve: DataFrame, score: str = "score") -> DataFrame:
    """Threshold maximising 2pr/(p+r+1e-8) over the real thresholds
    (trap B17), the smallest threshold on ties."""
    p = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    r = F.col("cum_pos") / F.col("P")
    f1 = 2 * p * r / (p + r + 1e-8)
    return curve.select(score, f1.alias("f1"), p.alias("precision"), r.alias("recall")).agg(
        F.max_by(F.struct(F.col(score).alias("threshold"), "f1", "precision", "recall"),
                 F.struct(F.col("f1"), -F.col(score))).alias("b")).select("b.*")


def fold_curves(df: DataFrame, fold: str, y: str = "y", score: str = "score") -> DataFrame:
    """``score_curve`` of every value of ``fold`` at once: one count per (fold,
    score) and one running total, however many folds there are."""
    d = cut_lineage(df.groupBy(fold, score).agg(F.sum(F.col(y)).cast("bigint").alias("pos"),
                                                F.sum(1 - F.col(y)).cast("bigint").alias("neg")))
    totals = d.groupBy(fold).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return join_small(running_totals(d, score, ["pos", "neg"], descending=True, by=[fold]), totals, [fold])


def fold_roc(df: DataFrame, fold: str, y: str = "y", score: str = "score") -> DataFrame:
    """(fold, x, v): false- and true-positive rates of every fold, each curve
    with its start (0, 0)."""
    c = fold_curves(df, fold, y, score).select(
        fold, (F.col("cum_neg") / F.col("N")).alias("x"), (F.col("cum_pos") / F.col("P")).alias("v"))
    return c.unionByName(df.select(fold).distinct().select(fold, F.lit(0.0).alias("x"), F.lit(0.0).alias("v")))


def interpolate(points: DataFrame, fold: str, n: int) -> DataFrame:
    """X11: (fold, i, v) of curves at x = i / (n - 1), linear between the last
    point at or before x and the first one after it (numpy's ``interp``).

    Points are first reduced to one per (fold, grid cell) from either side, so
    the windows see at most ``n`` rows per fold however long a curve is."""
    last, x = n - 1, F.col("x")
    p = F.struct("x", "v")
    # the first grid place at or after a point, and the last one before it
    after = F.ceil(x * last).cast("int")
    after = F.when((after > 0) & ((after - 1) / last >= x), after - 1).when(after / last < x, after + 1).otherwise(after)
    lo = points.groupBy(fold, after.alias("i")).agg(F.max(p).alias("lo"))
    hi = points.groupBy(fold, (after - 1).alias("i")).agg(F.min(p).alias("hi"))
    grid = points.select(fold).distinct().select(fold, F.explode(F.sequence(F.lit(0), F.lit(last))).alias("i"))
    both = grid.join(lo, [fold, "i"], "left").join(hi, [fold, "i"], "left")
    w = Window.partitionBy(fold).orderBy("i")
    both = both.select(fold, "i", F.max("lo").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("lo"),
                       F.min("hi").over(w.rowsBetween(0, Window.unboundedFollowing)).alias("hi"))
    slope = (F.col("hi.v") - F.col("lo.v")) / (F.col("hi.x") - F.col("lo.x"))
    v = F.when(F.col("hi").isNull(), F.col("lo.v")).otherwise(
        F.col("lo.v") + slope * (F.col("i") / last - F.col("lo.x")))
    return both.select(fold, "i", v.alias("v"))


def mean_curve(points: DataFrame, fold: str, n: int = 100) -> DataFrame:
    """K4: (i, mean, std) over the folds' interpolated curves."""
    return interpolate(points, fold, n).groupBy("i").agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"))


def grouped_curve(df: DataFrame, keys: Sequence[str], y: str = "y", score: str = "score", digits: int = 6) -> DataFrame:
    """``score_curve`` of many groups at once (models, folds): per group and
    distinct score, rounded to ``digits`` decimals, so that a group of
    probabilities has 10^digits + 1 points at most however many rows."""
    keys = list(keys)
    d = df.groupBy(*keys, F.round(score, digits).alias(score)).agg(
        F.sum(F.col(y)).cast("bigint").alias("pos"), F.sum(1 - F.col(y)).cast("bigint").alias("neg"))
    down = Window.partitionBy(*keys).orderBy(F.col(score).desc()).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    return d.select("*", F.sum("pos").over(down).alias("cum_pos"), F.sum("neg").over(down).alias("cum_neg"),
                    F.sum("pos").over(whole).alias("P"), F.sum("neg").over(whole).alias("N"))


def grouped_metrics(df: DataFrame, keys: Sequence[str], y: str = "y", score: str = "score") -> DataFrame:
    """Per group: accuracy, precision, recall and f1 at 0.5, ROC and PR AUC
    (trapezoids), and the largest F1 (2pr / (p + r + 1e-8)) with its threshold,
    the smallest one on ties."""
    keys = list(keys)
    t, p = F.col(y) == 1, F.col(score) >= 0.5
    cells = df.groupBy(*keys).agg(F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"),
                                  F.count_if(t & ~p).alias("fn"), F.count_if(~t & ~p).alias("tn"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    prec, rec = _safe_div(tp, tp + fp), _safe_div(tp, tp + fn)
    at_half = cells.select(*keys, ((tp + tn) / (tp + tn + fp + fn)).alias("accuracy"), prec.alias("precision"),
                           rec.alias("recall"), _safe_div(2 * prec * rec, prec + rec).alias("f1"))
    up, down = F.col("cum_pos"), F.col("cum_neg")
    precise, called = up / (up + down), _safe_div(up, F.col("P"))
    tp0, fp0 = up - F.col("pos"), down - F.col("neg")
    before = F.when(tp0 + fp0 == 0, F.lit(1.0)).otherwise(tp0 / (tp0 + fp0))
    f1 = 2 * precise * called / (precise + called + 1e-8)
    curve = grouped_curve(df, keys, y, score).groupBy(*keys).agg(
        F.sum(_safe_div(F.col("neg") * (2 * up - F.col("pos")), 2 * F.col("P") * F.col("N"))).alias("roc_auc"),
        F.sum(_safe_div(F.col("pos"), F.col("P")) * (precise + before) / 2).alias("pr_auc"),
        F.max(F.struct(f1.alias("f1"), (-F.col(score)).alias("s"))).alias("_b"))
    return at_half.join(curve, keys).select(*at_half.columns, "roc_auc", "pr_auc", F.col("_b.f1").alias("max_f1"),
                                            (-F.col("_b.s")).alias("threshold"))


def permuted(df: DataFrame, key: str, cols: Sequence[str], seed: int = 42) -> DataFrame:
    """``df`` with a column <c>_permuted beside each of ``cols``: the values in
    a seeded order of the keys, turned by a distance of the column's own.  The
    order is a rank over hashes, so no task holds all rows; each column is one
    join by rank."""
    ranked = cut_lineage(hash_rank(df, key, seed))
    n = ranked.count()
    out = ranked
    for i, c in enumerate(cols):
        turn = 1 + (i * 7919 + seed) % max(1, n - 1)
        other = ranked.select(((F.col("rank") + turn) % max(1, n)).alias("rank"), F.col(c).alias(f"{c}_permuted"))
        out = out.join(other, "rank")
    return out.drop("rank")


# ---------------------------------------------------------------- thresholded metrics

def confusion(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """The four cells as one row (every cell present, zeros included)."""
    t, p = F.col(y) == 1, F.col(yhat) == 1
    return df.agg(F.count_if(~t & ~p).alias("tn"), F.count_if(~t & p).alias("fp"),
                  F.count_if(t & ~p).alias("fn"), F.count_if(t & p).alias("tp"))


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def binary_metrics(conf: DataFrame) -> DataFrame:
    """K9 (threshold part): accuracy, precision, recall, F1 with zero_division = 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    prec = _safe_div(tp, tp + fp)
    rec = _safe_div(tp, tp + fn)
    return conf.select((tp + tn) / (tp + tn + fp + fn), prec, rec,
                       _safe_div(2 * prec * rec, prec + rec)).toDF("accuracy", "precision", "recall", "f1")


def class_report(conf: DataFrame) -> DataFrame:
    """Per class precision / recall / f1 / support, macro and weighted averages."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    p1, r1 = _safe_div(tp, tp + fp), _safe_div(tp, tp + fn)
    p0, r0 = _safe_div(tn, tn + fn), _safe_div(tn, tn + fp)
    f1 = _safe_div(2 * p1 * r1, p1 + r1)
    f0 = _safe_div(2 * p0 * r0, p0 + r0)
    s1, s0 = tp + fn, tn + fp
    n = s0 + s1
    rows = F.array(
        F.struct(F.lit("0").alias("label"), p0.alias("precision"), r0.alias("recall"), f0.alias("f1"),
                 s0.alias("support")),
        F.struct(F.lit("1").alias("label"), p1.alias("precision"), r1.alias("recall"), f1.alias("f1"),
                 s1.alias("support")),
        F.struct(F.lit("macro avg").alias("label"), ((p0 + p1) / 2).alias("precision"), ((r0 + r1) / 2).alias("recall"),
                 ((f0 + f1) / 2).alias("f1"), n.alias("support")),
        F.struct(F.lit("weighted avg").alias("label"), ((p0 * s0 + p1 * s1) / n).alias("precision"),
                 ((r0 * s0 + r1 * s1) / n).alias("recall"), ((f0 * s0 + f1 * s1) / n).alias("f1"),
                 n.alias("support")))
    return conf.select(F.explode(rows).alias("r")).select("r.*")


# ---------------------------------------------------------------- two-group comparison

def two_group_compare(df: DataFrame, group: str, cols: Sequence[str], with_p: bool = False) -> DataFrame:
    """Per feature, group means / sample stds (group 0 'alive', 1
    'deceased'), mean_diff = m1 - m0, Welch t = (m0 - m1)/sqrt(v0/n0 + v1/n1)
    (so the sign is opposite to mean_diff, as in the reference), Welch df,
    Cohen's d = mean_diff / std0 (0 when std0 = 0); p-value optional."""
    long = long_form(df, [group], cols).where(F.col("x").isNotNull())
    g = long.groupBy("feature").agg(*[
        e for k in (0, 1) for e in (
            F.count_if(F.col(group) == k).alias(f"n{k}"),
            F.avg(F.when(F.col(group) == k, F.col("x"))).alias(f"m{k}"),
            F.var_samp(F.when(F.col(group) == k, F.col("x"))).alias(f"v{k}"))])
    se2 = F.col("v0") / F.col("n0") + F.col("v1") / F.col("n1")
    t = (F.col("m0") - F.col("m1")) / F.sqrt(se2)
    dof = se2 * se2 / ((F.col("v0") / F.col("n0")) ** 2 / (F.col("n0") - 1)
                       + (F.col("v1") / F.col("n1")) ** 2 / (F.col("n1") - 1))
    s0 = F.sqrt(F.col("v0"))
    out = g.select("feature", F.col("m0").alias("alive_mean"), s0.alias("alive_std"),
                   F.col("m1").alias("deceased_mean"), F.sqrt(F.col("v1")).alias("deceased_std"),
                   (F.col("m1") - F.col("m0")).alias("mean_diff"), t.alias("t_statistic"), dof.alias("df"),
                   F.when(s0 == 0, F.lit(0.0)).otherwise((F.col("m1") - F.col("m0")) / s0).alias("cohen_d"))
    if with_p:
        from ..functions.stats import t_tail
        out = out.withColumn("p_value", t_tail(F.col("t_statistic"), F.col("df")))
    return out


# ---------------------------------------------------------------- folds and sampling

def seeded_hash(key: Column, seed: int, digits: int = 12) -> Column:
    """The first hex digits of the MD5 of ``key:seed`` as a number (48 bits):
    an order that any engine can reproduce."""
    text = F.concat_ws(":", key.cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, digits), 16, 10).cast("long")


def hash_rank(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """0-based ``rank`` of each row in a seeded hash order of its key, by the
    bucketed running count: no task orders the whole table."""
    d = df.withColumn("_h", seeded_hash(F.col(key), seed).cast("double")).withColumn("_one", F.lit(1))
    c = running_totals(d, "_h", ["_one"], tiebreak=[key])
    return c.withColumn("rank", F.col("cum__one") - 1).drop("_h", "_one", "cum__one")


def stratified_rank(df: DataFrame, y: str, key: str, seed: int = 42) -> DataFrame:
    """0-based rank of each row inside its class in a seeded hash order,
    computed with the bucketed running count (a class holding most rows is
    still spread over many tasks)."""
    # one sortable key, exact as a double: the class (a small integer), then 48 bits of the seeded hash
    d = df.withColumn("_h", F.col(y).cast("double") * 2.0 ** 48 + seeded_hash(F.col(key), seed))
    d = d.withColumn("_one", F.lit(1))
    c = running_totals(d, "_h", ["_one"], tiebreak=[key])
    # class sizes and start offsets: one row per class
    cls = df.groupBy(y).agg(F.count(F.lit(1)).alias("_n"))
    cls = cls.withColumn("_start", F.coalesce(F.sum("_n").over(
        Window.orderBy(y).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return c.join(cls, y).withColumn("rank", F.col("cum__one") - 1 - F.col("_start")) \
            .drop("_h", "_one", "cum__one", "_start")


def stratified_folds(df: DataFrame, y: str, key: str, k: int = 10, seed: int = 42) -> DataFrame:
    """K2: fold = rank within class mod k (fold sizes per class differ by <= 1)."""
    return stratified_rank(df, y, key, seed).withColumn("fold", (F.col("rank") % k).cast("int")).drop("rank", "_n")


def stratified_split(df: DataFrame, y: str, key: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """K5: per class the first ceil(test_size * n_c) rows of the seeded order are test."""
    r = stratified_rank(df, y, key, seed)
    return r.withColumn("split", F.when(F.col("rank") < F.ceil(F.col("_n") * test_size), "test")
                        .otherwise("train")).drop("rank", "_n")


def undersample(df: DataFrame, y: str, key: str, ratio: float = 1.0, seed: int = 42) -> DataFrame:
    """K7: keep every minority row and the first minority/ratio majority rows
    of the seeded order (ratio = minority / majority after sampling)."""
    r = stratified_rank(df, y, key, seed)
    n_min = r.select(F.min("_n")).scalar()
    keep = F.col("rank") < F.floor(n_min / ratio)
    return r.where((F.col("_n") == n_min) | keep).drop("rank", "_n")


# ---------------------------------------------------------------- clustering quality

def cluster_quality(df: DataFrame, label: str, vec: str) -> DataFrame:
    """C3 on given labels: inertia (within SS), Calinski-Harabasz, Davies-Bouldin.

    Two scans without a shuffle of the rows: the mean vector of each label (a
    bounded k x d matrix, taken to the driver), then the distances to it."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    rows = df.select(label, F.col(vec).alias("_v")).where(F.col(label).isNotNull() & F.col("_v").isNotNull())
    means = rows.groupBy(label).agg(Summarizer.mean(array_to_vector("_v")).alias("m"), F.count(F.lit(1)).alias("n"))
    means = {r[label]: (np.array(r["m"]), r["n"]) for r in means.select(label, vector_to_array("m").alias("m"), "n").collect()}
    labels = sorted(means)
    k, n = len(labels), sum(c for _, c in means.values())
    schema = "inertia double, calinski_harabasz double, davies_bouldin double, k int, n long"
    if not k:
        return df.sparkSession.createDataFrame([(0.0, 0.0, 0.0, 0, 0)], schema)
    centres = F.create_map(*[F.lit(x) for lb in labels for x in (lb, means[lb][0].tolist())])
    square = F.aggregate(F.zip_with("_v", F.element_at(centres, F.col(label)), lambda a, b: (a - b) * (a - b)),
                         F.lit(0.0), lambda acc, v: acc + v)
    spread = rows.select(label, square.alias("q")).groupBy(label).agg(F.sum("q").alias("w"), F.avg(F.sqrt("q")).alias("s"))
    spread = {r[label]: (r["w"], r["s"]) for r in spread.collect()}
    g = sum(m * c for m, c in means.values()) / n
    W = float(sum(w for w, _ in spread.values()))
    B = float(sum(c * np.sum((m - g) ** 2) for m, c in means.values()))
    ch = (B / (k - 1)) / (W / (n - k)) if k > 1 and n > k and W > 0 else 0.0
    db = float(np.mean([max((spread[i][1] + spread[j][1]) / np.linalg.norm(means[i][0] - means[j][0])
                            for j in labels if j != i) for i in labels])) if k > 1 else 0.0
    return df.sparkSession.createDataFrame([(W, float(ch), db, k, n)], schema)


def silhouette(df: DataFrame, label: str, vec: str) -> float:
    """Mean silhouette of given labels with squared Euclidean distances,
    from sums per cluster (Spark's evaluator), not from pairs of rows."""
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.functions import array_to_vector
    rows = df.select(F.col(label).cast("double").alias("prediction"), array_to_vector(vec).alias("features"))
    return ClusteringEvaluator().evaluate(rows)
