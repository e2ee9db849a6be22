"""Model queries: clustering, isolation forest, one-class SVM (C1-C10, N1-N6,
A34, W10).  Fits are randomised or iterative, so these
carry no SQL oracle; their invariants are tested in tests/test_models.py."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import anomaly as an
from ..operators import classify as cl
from ..operators import cluster as cu
from ..operators import evaluate as ev
from ..operators import timeseries as ts
from ..operators.encode import zscore, zscore_array, zscore_array_by
from ..session import cut_lineage, few_parts
from ..sources import fixtures as fx
from ..sources.tables import table
from .registry import register

DIM = 64
K_OVERALL = 4


def _r(c, n=6):
    return F.round(c, n)


def zvectors(spark, sf_dir):
    """Embeddings z-scored per dimension (I15) as ML vectors, persisted for the fits."""
    v = fx.vectors(spark, sf_dir)
    return cu.vectorise(zscore_array(v, "v", DIM))


@register("kmeans_assign")
def kmeans_assign(spark, sf_dir):
    """C1 + C9: k-means (k=4, best of several seeds) assignments."""
    v = zvectors(spark, sf_dir)
    return cu.assign(cu.kmeans_best(v, K_OVERALL), v, ["vec_id", "label"])


@register("kmeans_profile")
def kmeans_profile(spark, sf_dir):
    """A20 on fitted clusters: size, share and per-dimension mean of each cluster."""
    from ..operators.profile import array_profile
    v = zvectors(spark, sf_dir)
    a = cu.assign(cu.kmeans_best(v, K_OVERALL), v, ["vec_id", "v"])
    return array_profile(a, "cluster", "v").select("cluster", "dim", _r(F.col("mean")).alias("mean"),
                                                   _r(F.col("std")).alias("std"), "size", _r(F.col("pct")).alias("pct"))


@register("k_select")
def k_select(spark, sf_dir):
    """C2 + C3: k from 2 to 10 scored by silhouette, CH and DB, a winner each."""
    return cu.select_k(zvectors(spark, sf_dir), range(2, 11), vec="v")


@register("gmm_assign")
def gmm_assign(spark, sf_dir):
    """Gaussian-mixture hard labels (k=4) on all z-scored dimensions."""
    return cu.gmm_assign(zvectors(spark, sf_dir), K_OVERALL, ["vec_id", "label"])


@register("pca_2d")
def pca_2d(spark, sf_dir):
    """2-D projection with reproducible signs."""
    v = zvectors(spark, sf_dir)
    p = cu.pca_2d(v, ["vec_id", "label"])
    return p.select("vec_id", "label", _r(F.col("pc1")).alias("pc1"), _r(F.col("pc2")).alias("pc2"))


@register("ward_two_phase")
def ward_two_phase(spark, sf_dir):
    """C4: Ward clustering via k-means micro-clusters."""
    v = zvectors(spark, sf_dir)
    return cu.ward_two_phase(v, K_OVERALL, ["vec_id", "label"])[0]


@register("ward_linkage")
def ward_linkage(spark, sf_dir):
    """C4: the merge table (left, right, height, size) behind the labels."""
    return cu.ward_two_phase(zvectors(spark, sf_dir), K_OVERALL, ["vec_id"])[1]


@register("ward_check", "SELECT count(*) AS rows, count(*) AS last_size, 4 AS clusters, 0 AS falls FROM embeddings")
def ward_check(spark, sf_dir):
    """C4: every vector gets a label, the last merge holds all vectors, heights
    never fall, and the cut leaves the clusters asked for."""
    labels, links = cu.ward_two_phase(zvectors(spark, sf_dir), K_OVERALL, ["vec_id"])
    links = links.collect()  # micro - 1 rows
    falls = sum(b["height"] < a["height"] - 1e-9 for a, b in zip(links, links[1:]))
    return labels.agg(F.count_distinct("vec_id").alias("rows"), F.lit(links[-1]["size"]).alias("last_size"),
                      F.count_distinct("cluster").cast("int").alias("clusters"), F.lit(falls).alias("falls"))


@register("subset_cluster")
def subset_cluster(spark, sf_dir):
    """Per feature subset (four 16-dimension slices) k selection (2..10)."""
    base = zscore_array(fx.vectors(spark, sf_dir), "v", DIM)
    out = None
    for i in range(4):
        v = cu.vectorise(cu.subset_vectors(base, "v", 16 * i, 16 * (i + 1)))
        s = cu.select_k(v, range(2, 11), vec="v").withColumn("subset", F.lit(f"dims_{16 * i}_{16 * i + 15}"))
        out = s if out is None else out.unionByName(s)
        v.unpersist()
    return out


def _doc_data(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("y"))
    return cl.text_features(docs.join(lab, "doc_id", "left_semi")).join(lab, "doc_id")


def _split(spark, sf_dir):
    """K5 first, then everything else on the training part only (trap B10)."""
    d = _doc_data(spark, sf_dir)
    return cut_lineage(ev.stratified_split(d, "y", "doc_id", 0.2))


def _points(spark, sf_dir):
    g = cut_lineage(fx.pv_grid(spark, sf_dir).na.drop(subset=["power", "generation"]))
    z = zscore(g, ["power", "generation"])
    return few_parts(z.withColumn("x", F.array("power", "generation")))


@register("iforest_points")
def iforest_points(spark, sf_dir):
    """N1 + N3: isolation forest on z-scored (power, generation) points."""
    r = an.iforest(_points(spark, sf_dir), "x", ["series", "t"], contamination=0.01)
    return r.withColumn("score", _r(F.col("score")))


def _window_vectors(spark, sf_dir, joint: bool):
    g = cut_lineage(ts.tod_mean_fill(ts.tod_mean_fill(fx.pv_grid(spark, sf_dir), "power"), "generation"))
    keys = ["series", "w", "step", "k"]
    p = ts.windows_to_arrays(ts.window_gap_fill(ts.sliding_windows(g, ["power_filled"]), "power_filled"),
                             ["power_filled"])
    if not joint:
        return p.withColumn("x", F.col("power_filled"))
    q = ts.windows_to_arrays(ts.window_gap_fill(ts.sliding_windows(g, ["generation_filled"]), "generation_filled"),
                             ["generation_filled"])
    return p.join(q, keys).withColumn("x", F.concat("power_filled", "generation_filled"))


def _per_config(win, dim_of, models, keys=("series", "w", "step", "k", "first_z")):
    """Each model on the windows of each configuration, z-scored per
    configuration; a model's fits for all configurations share their jobs.
    Output (W10): model, window, first standardised value, score, label."""
    by = ("w", "step")
    z = zscore_array_by(win, "x", by, "z").withColumn("first_z", F.col("z")[0])
    z = few_parts(cut_lineage(z.select(*keys, "z")))
    out = None
    for model in models:
        r = (an.iforest(z, "z", list(keys), contamination=0.01, by=by) if model == "iforest"
             else an.ocsvm(z, "z", {c: dim_of(c[0]) for c in ts.WINDOW_CONFIGS}, list(keys), nu=0.05, by=by))
        r = r.select(F.lit(model).alias("model"), *keys, "score", "label")
        out = r if out is None else out.unionByName(r)
    return out.withColumn("first_z", _r(F.col("first_z"))).withColumn("score", _r(F.col("score")))


def _window_anomalies(spark, sf_dir, joint: bool):
    win = cut_lineage(_window_vectors(spark, sf_dir, joint))
    return _per_config(win, lambda w: w * (2 if joint else 1), ("iforest", "svm"))


@register("window_anomalies")
def window_anomalies(spark, sf_dir):
    """N4 + W10: per window configuration, isolation forest and one-class SVM on
    z-scored gap-filled power windows."""
    return _window_anomalies(spark, sf_dir, joint=False)


@register("joint_anomalies")
def joint_anomalies(spark, sf_dir):
    """The same on power ++ generation windows joined by window key."""
    return _window_anomalies(spark, sf_dir, joint=True)


@register("anomaly_counts")
def anomaly_counts(spark, sf_dir):
    """Anomalies per input, model and window configuration: points (no
    configuration), power windows, joint windows, and windows with their
    periodic feature."""
    one = F.count_if(F.col("label") == -1).alias("anomalies"), F.count(F.lit(1)).alias("rows")
    none = F.lit(None).cast("int")
    out = None
    for name, model, df in (("points", "iforest", iforest_points(spark, sf_dir)),
                            ("points", "svm", ocsvm_points(spark, sf_dir)),
                            ("power", None, window_anomalies(spark, sf_dir)),
                            ("joint", None, joint_anomalies(spark, sf_dir)),
                            ("period", None, period_anomalies(spark, sf_dir))):
        if model:
            df = df.select(F.lit(model).alias("model"), none.alias("w"), none.alias("step"), "label")
        part = df.groupBy(F.lit(name).alias("input"), "model", "w", "step").agg(*one)
        out = part if out is None else out.unionByName(part)
    return out


@register("ocsvm_points")
def ocsvm_points(spark, sf_dir):
    """N2 + N3: one-class SVM (RBF via random Fourier features, nu = 0.05) on
    z-scored (power, generation) points."""
    r = an.ocsvm(_points(spark, sf_dir), "x", 2, ["series", "t"], nu=0.05)
    return r.withColumn("score", _r(F.col("score")))


@register("period_anomalies")
def period_anomalies(spark, sf_dir):
    """Gap-filled power window ++ 15-day periodic feature at the window end
    (windows with a NULL feature dropped, aligned by key), z-scored per
    configuration, one-class SVM per configuration; A34 counts per config."""
    g = cut_lineage(ts.periodic_feature(
        ts.tod_mean_fill(fx.pv_grid(spark, sf_dir), "power"), "power_filled"))
    win = ts.windows_to_arrays(ts.window_gap_fill(ts.sliding_windows(g, ["power_filled"]), "power_filled"),
                               ["power_filled"])
    win = ts.attach_window_end(win, g, ["periodic"]).where(F.col("periodic").isNotNull())
    win = cut_lineage(win.withColumn("x", F.concat("power_filled", F.array("periodic"))))
    return _per_config(win, lambda w: w + 1, ("svm",))
