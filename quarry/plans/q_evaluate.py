"""Evaluation queries on given scores, labels and clusterings (K2, K5, K7,
K9-K13, A26, A33, C3)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import evaluate as ev
from ..session import cut_lineage
from ..sources import fixtures as fx
from ..sources.fixtures import LAB_FEATURES
from .registry import register
from .sqlfix import LAB, SCORES, with_


def _r(c, n=6):
    return F.round(c, n)


def curve(spark, sf_dir):
    """Distinct-score curve of quality labels against document length, kept
    once: thresholds, AUCs and metrics all read it."""
    return cut_lineage(ev.score_curve(fx.scores(spark, sf_dir), "y", "score"))


CURVE_SQL = with_(SCORES) + """,
d AS (SELECT score, sum(y) AS pos, sum(1 - y) AS neg FROM scores GROUP BY score),
c AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS cum_pos, sum(neg) OVER (ORDER BY score DESC) AS cum_neg,
             sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM d),
best AS (SELECT score AS threshold,
                2 * (cum_pos / (cum_pos + cum_neg)) * (cum_pos / P) / ((cum_pos / (cum_pos + cum_neg)) + (cum_pos / P) + 1e-8) AS f1,
                cum_pos / (cum_pos + cum_neg) AS precision, cum_pos / P AS recall
         FROM c ORDER BY f1 DESC, score ASC LIMIT 1),
conf AS (SELECT count(*) FILTER (WHERE y = 0 AND score < (SELECT threshold FROM best)) AS tn,
                count(*) FILTER (WHERE y = 0 AND score >= (SELECT threshold FROM best)) AS fp,
                count(*) FILTER (WHERE y = 1 AND score < (SELECT threshold FROM best)) AS fn,
                count(*) FILTER (WHERE y = 1 AND score >= (SELECT threshold FROM best)) AS tp FROM scores)"""


def thresholded(spark, sf_dir):
    c = curve(spark, sf_dir)
    t = ev.best_f1_threshold(c).select("threshold").scalar()
    s = fx.scores(spark, sf_dir).withColumn("yhat", (F.col("score") >= t).cast("int"))
    return c, ev.confusion(s, "y", "yhat")


@register("roc_points", CURVE_SQL + """
SELECT round(score, 6) AS threshold, round(cum_neg / N, 6) AS fpr, round(cum_pos / P, 6) AS tpr FROM c""")
def roc_points(spark, sf_dir):
    """ROC curve over the distinct scores."""
    r = ev.roc_points(curve(spark, sf_dir))
    return r.select(*[_r(F.col(c)).alias(c) for c in ("threshold", "fpr", "tpr")])


@register("pr_points", CURVE_SQL + """
SELECT round(score, 6) AS threshold, round(cum_pos / (cum_pos + cum_neg), 6) AS precision,
       round(cum_pos / P, 6) AS recall FROM c""")
def pr_points(spark, sf_dir):
    """Precision-recall curve over the distinct scores."""
    r = ev.pr_points(curve(spark, sf_dir))
    return r.select(*[_r(F.col(c)).alias(c) for c in ("threshold", "precision", "recall")])


@register("best_f1_threshold", CURVE_SQL + """
SELECT round(threshold, 6) AS threshold, round(f1, 6) AS f1, round(precision, 6) AS precision,
       round(recall, 6) AS recall FROM best""")
def best_f1_threshold(spark, sf_dir):
    """The F1-maximising threshold (smallest on ties)."""
    b = ev.best_f1_threshold(curve(spark, sf_dir))
    return b.select(*[_r(F.col(c)).alias(c) for c in ("threshold", "f1", "precision", "recall")])


@register("confusion", CURVE_SQL + " SELECT tn, fp, fn, tp FROM conf")
def confusion(spark, sf_dir):
    """Confusion cells at the best-F1 threshold."""
    return thresholded(spark, sf_dir)[1]


@register("binary_metrics", CURVE_SQL + """,
auc AS (SELECT sum(neg / N * (2 * cum_pos - pos) / (2 * P)) AS roc_auc,
               sum((pos / P) * (cum_pos / (cum_pos + cum_neg)
                   + CASE WHEN cum_pos - pos + cum_neg - neg = 0 THEN 1.0
                          ELSE (cum_pos - pos) / (cum_pos - pos + cum_neg - neg) END) / 2) AS pr_auc FROM c)
SELECT round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy,
       round(CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END, 6) AS precision,
       round(CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END, 6) AS recall,
       round(CASE WHEN tp = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END, 6) AS f1,
       round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc
FROM conf, auc""")
def binary_metrics(spark, sf_dir):
    """K9: accuracy / precision / recall / F1 at the best-F1 threshold, ROC and PR AUC."""
    c, conf = thresholded(spark, sf_dir)
    m = ev.binary_metrics(conf)
    a = ev.auc_from_curve(c).first()
    return m.select(*[_r(F.col(x)).alias(x) for x in ("accuracy", "precision", "recall", "f1")],
                    F.lit(round(a["roc_auc"], 6)).alias("roc_auc"), F.lit(round(a["pr_auc"], 6)).alias("pr_auc"))


@register("class_report", CURVE_SQL + """,
m AS (SELECT CASE WHEN tn + fn = 0 THEN 0.0 ELSE tn / (tn + fn) END AS p0, CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn / (tn + fp) END AS r0,
             CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS p1, CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS r1,
             tn + fp AS s0, tp + fn AS s1 FROM conf),
f AS (SELECT *, CASE WHEN p0 + r0 = 0 THEN 0.0 ELSE 2 * p0 * r0 / (p0 + r0) END AS f0,
                CASE WHEN p1 + r1 = 0 THEN 0.0 ELSE 2 * p1 * r1 / (p1 + r1) END AS f1 FROM m)
SELECT '0' AS label, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1, s0 AS support FROM f
UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1, 6), s1 FROM f
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), s0 + s1 FROM f
UNION ALL SELECT 'weighted avg', round((p0 * s0 + p1 * s1) / (s0 + s1), 6), round((r0 * s0 + r1 * s1) / (s0 + s1), 6),
                 round((f0 * s0 + f1 * s1) / (s0 + s1), 6), s0 + s1 FROM f""")
def class_report(spark, sf_dir):
    """Per-class and averaged precision / recall / F1 / support."""
    rep = ev.class_report(thresholded(spark, sf_dir)[1])
    return rep.select("label", *[_r(F.col(c)).alias(c) for c in ("precision", "recall", "f1")], "support")


TG_COLS = list(LAB_FEATURES)
_TG = " UNION ALL ".join(f"""SELECT '{c}' AS feature,
    avg({c}) FILTER (WHERE g = 0) AS m0, var_samp({c}) FILTER (WHERE g = 0) AS v0, count({c}) FILTER (WHERE g = 0) AS n0,
    avg({c}) FILTER (WHERE g = 1) AS m1, var_samp({c}) FILTER (WHERE g = 1) AS v1, count({c}) FILTER (WHERE g = 1) AS n1
    FROM lg""" for c in TG_COLS)


@register("two_group_compare", with_(LAB) + f""",
lg AS (SELECT *, CAST(grp = 'R' AS INTEGER) AS g FROM lab), s AS ({_TG})
SELECT feature, round(m0, 6) AS alive_mean, round(sqrt(v0), 6) AS alive_std, round(m1, 6) AS deceased_mean,
       round(sqrt(v1), 6) AS deceased_std, round(m1 - m0, 6) AS mean_diff,
       round((m0 - m1) / sqrt(v0 / n0 + v1 / n1), 6) AS t_statistic,
       round((v0 / n0 + v1 / n1) ^ 2 / ((v0 / n0) ^ 2 / (n0 - 1) + (v1 / n1) ^ 2 / (n1 - 1)), 6) AS df,
       round(CASE WHEN sqrt(v0) = 0 THEN 0.0 ELSE (m1 - m0) / sqrt(v0) END, 6) AS cohen_d
FROM s""")
def two_group_compare(spark, sf_dir):
    """Returned (R) vs other lines per lab feature: means, stds, Welch t, df, Cohen's d."""
    lab = fx.lab(spark, sf_dir).withColumn("g", (F.col("grp") == "R").cast("int"))
    t = ev.two_group_compare(lab, "g", TG_COLS)
    return t.select("feature", *[_r(F.col(c)).alias(c) for c in t.columns if c != "feature"])


@register("two_group_pvalues", with_(LAB).replace("WITH ", "WITH RECURSIVE ", 1) + f""",
lg AS (SELECT *, CAST(grp = 'R' AS INTEGER) AS g FROM lab), s AS ({_TG}),
t AS (SELECT *, (m0 - m1) / sqrt(v0 / n0 + v1 / n1) AS t,
             (v0 / n0 + v1 / n1) ^ 2 / ((v0 / n0) ^ 2 / (n0 - 1) + (v1 / n1) ^ 2 / (n1 - 1)) AS df FROM s),
b AS (SELECT *, df / 2 AS a, df / (df + t * t) AS x, df / (df + t * t) >= (df / 2 + 1) / (df / 2 + 2.5) AS turn FROM t),
p AS (SELECT *, CASE WHEN turn THEN 0.5 ELSE a END AS fa, CASE WHEN turn THEN a ELSE 0.5 END AS fb,
             CASE WHEN turn THEN 1 - x ELSE x END AS fx FROM b),
cf(feature, m, fa, fb, fx, c, d, h) AS (
  SELECT feature, 0, fa, fb, fx, 1.0::DOUBLE, 1 / (1 - (fa + fb) * fx / (fa + 1)), 1 / (1 - (fa + fb) * fx / (fa + 1)) FROM p
  UNION ALL
  SELECT feature, m, fa, fb, fx, 1 + o / c1, 1 / (1 + o * d1), h * d1 * c1 * (1 / (1 + o * d1)) * (1 + o / c1)
  FROM (SELECT *, 1 / (1 + e * d) AS d1, 1 + e / c AS c1 FROM (
    SELECT feature, m + 1 AS m, fa, fb, fx, c, d, h,
           (m + 1) * (fb - m - 1) * fx / ((fa - 1 + 2 * (m + 1)) * (fa + 2 * (m + 1))) AS e,
           -(fa + m + 1) * (fa + fb + m + 1) * fx / ((fa + 2 * (m + 1)) * (fa + 1 + 2 * (m + 1))) AS o
    FROM cf WHERE m < 300))),
r AS (SELECT p.*, exp(a * ln(x) + 0.5 * ln(t * t / (df + t * t)) - (lgamma(a) + lgamma(0.5) - lgamma(a + 0.5)))
                  * cf.h / p.fa AS part FROM p JOIN cf ON cf.feature = p.feature AND cf.m = 300)
SELECT feature, round(m1 - m0, 6) AS mean_diff, round(t, 6) AS t_statistic,
       round(CASE WHEN turn THEN 1 - part ELSE part END, 6) AS p_value,
       row_number() OVER (ORDER BY abs(m1 - m0) DESC, feature)::INTEGER AS place FROM r""")
def two_group_pvalues(spark, sf_dir):
    """A26 with the two-sided Welch p-value, ordered by |mean_diff| as in the
    reference (T7); ``place`` is a row's place in that order (a row per feature)."""
    lab = fx.lab(spark, sf_dir).withColumn("g", (F.col("grp") == "R").cast("int"))
    t = ev.two_group_compare(lab, "g", TG_COLS, with_p=True)
    place = F.row_number().over(Window.orderBy(F.abs("mean_diff").desc(), "feature"))
    return t.select("feature", _r(F.col("mean_diff")).alias("mean_diff"), _r(F.col("t_statistic")).alias("t_statistic"),
                    _r(F.col("p_value")).alias("p_value"), place.alias("place")).orderBy("place")


@register("cluster_quality", """
WITH d AS (SELECT vec_id, label, unnest(range(64)) AS dim, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
cent AS (SELECT label, dim, avg(x) AS c FROM d GROUP BY ALL),
g AS (SELECT dim, avg(x) AS g FROM d GROUP BY dim),
sz AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label),
W AS (SELECT sum((x - c) ^ 2) AS w FROM d JOIN cent USING (label, dim)),
B AS (SELECT sum(sz.n * (c - g) ^ 2) AS b FROM cent JOIN g USING (dim) JOIN sz USING (label)),
rd AS (SELECT vec_id, label, sqrt(sum((x - c) ^ 2)) AS dist FROM d JOIN cent USING (label, dim) GROUP BY vec_id, label),
S AS (SELECT label, avg(dist) AS s FROM rd GROUP BY label),
M AS (SELECT a.label AS i, b.label AS j, sqrt(sum((a.c - b.c) ^ 2)) AS m FROM cent a JOIN cent b
      ON a.dim = b.dim AND a.label <> b.label GROUP BY 1, 2),
R AS (SELECT i, max((si.s + sj.s) / m) AS r FROM M JOIN S si ON si.label = i JOIN S sj ON sj.label = j GROUP BY i),
K AS (SELECT count(*) AS k, sum(n) AS n FROM sz)
SELECT round(W.w, 3) AS inertia, round((B.b / (K.k - 1)) / (W.w / (K.n - K.k)), 6) AS calinski_harabasz,
       round((SELECT avg(r) FROM R), 6) AS davies_bouldin, CAST(K.k AS INTEGER) AS k, K.n AS n
FROM W, B, K""")
def cluster_quality(spark, sf_dir):
    """C3 on the given embedding labels."""
    q = ev.cluster_quality(fx.vectors(spark, sf_dir), "label", "v")
    return q.select(_r(F.col("inertia"), 3).alias("inertia"), _r(F.col("calinski_harabasz")).alias("calinski_harabasz"),
                    _r(F.col("davies_bouldin")).alias("davies_bouldin"), "k", "n")


@register("cluster_silhouette", """
WITH v AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
m AS (SELECT a.vec_id, a.label, b.label AS other, sum(list_distance(a.v, b.v) ^ 2) AS d, count(*) AS n FROM v a, v b GROUP BY ALL),
s AS (SELECT vec_id, max(CASE WHEN label = other THEN CASE WHEN n > 1 THEN d / (n - 1) END END) AS a,
             min(CASE WHEN label <> other THEN d / n END) AS b FROM m GROUP BY vec_id)
SELECT round(avg(CASE WHEN a IS NULL THEN 0 WHEN greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette
FROM s""")
def cluster_silhouette(spark, sf_dir):
    """Mean silhouette of the given embedding labels (squared distances)."""
    value = ev.silhouette(fx.vectors(spark, sf_dir), "label", "v")
    return spark.createDataFrame([(round(value, 6),)], "silhouette double")


@register("stratified_folds", with_(SCORES) + """
SELECT y, CAST((row_number() OVER (PARTITION BY y ORDER BY doc_id) - 1) % 10 AS INTEGER) AS fold FROM scores""".replace(
    "SELECT y, CAST", "SELECT y, fold, count(*) AS n FROM (SELECT y, CAST") + ") GROUP BY y, fold")
def stratified_folds(spark, sf_dir):
    """K2: 10 stratified folds in a seeded hash order; fold sizes per class."""
    f = ev.stratified_folds(fx.scores(spark, sf_dir), "y", "doc_id", k=10)
    return f.groupBy("y", "fold").agg(F.count(F.lit(1)).alias("n"))


@register("stratified_split", with_(SCORES) + """,
r AS (SELECT y, row_number() OVER (PARTITION BY y ORDER BY doc_id) - 1 AS rank, count(*) OVER (PARTITION BY y) AS n FROM scores)
SELECT y, CASE WHEN rank < ceil(n * 0.2) THEN 'test' ELSE 'train' END AS split, count(*) AS n FROM r GROUP BY ALL""")
def stratified_split(spark, sf_dir):
    """K5: 80/20 split per class; sizes per (class, split)."""
    s = ev.stratified_split(fx.scores(spark, sf_dir), "y", "doc_id", 0.2)
    return s.groupBy("y", "split").agg(F.count(F.lit(1)).alias("n"))


@register("undersample", with_(SCORES) + """,
c AS (SELECT y, count(*) AS n FROM scores GROUP BY y)
SELECT y, least(n, (SELECT min(n) FROM c)) AS n FROM c""")
def undersample(spark, sf_dir):
    """K7: majority class sampled down to the minority size (1:1)."""
    u = ev.undersample(fx.scores(spark, sf_dir), "y", "doc_id", 1.0)
    return u.groupBy("y").agg(F.count(F.lit(1)).alias("n"))


RANK_SQL = with_(SCORES) + """,
ranked AS (SELECT doc_id, y, count(*) OVER (PARTITION BY y) AS n,
                  row_number() OVER (PARTITION BY y ORDER BY ('0x' || md5(doc_id || ':42')[1:12])::BIGINT, doc_id) - 1
                      AS rank
           FROM scores)
"""


@register("fold_rows", RANK_SQL + "SELECT doc_id, y, (rank % 10)::INTEGER AS fold FROM ranked")
def fold_rows(spark, sf_dir):
    """K2 by row: every document in exactly one of ten folds."""
    return ev.stratified_folds(fx.scores(spark, sf_dir), "y", "doc_id", k=10).select("doc_id", "y", "fold")


@register("split_rows", RANK_SQL + """
SELECT doc_id, y, CASE WHEN rank < ceil(n * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM ranked""")
def split_rows(spark, sf_dir):
    """K5 by row."""
    return ev.stratified_split(fx.scores(spark, sf_dir), "y", "doc_id", 0.2).select("doc_id", "y", "split")


@register("undersample_rows", RANK_SQL + """
SELECT doc_id, y FROM ranked WHERE n = (SELECT min(n) FROM ranked) OR rank < (SELECT min(n) FROM ranked)""")
def undersample_rows(spark, sf_dir):
    """K7 by row: all of the smaller class, the first ones of the larger."""
    return ev.undersample(fx.scores(spark, sf_dir), "y", "doc_id", 1.0).select("doc_id", "y")
