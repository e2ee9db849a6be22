"""Companions of fitted models by an exact property: mixture, projection,
one-class SVM, feature-subset clusters, learned outlier bands."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cluster as cu
from ..operators.encode import zscore_array
from ..session import cut_lineage
from ..sources import fixtures as fx
from . import q_models as qm
from .registry import register
from .sqlfix import PV_GRID, with_

SUBSETS = {f"dims_{16 * i}_{16 * i + 15}": (16 * i, 16 * (i + 1)) for i in range(4)}
# k and restarts of the subsets' fits (``subset_cluster`` scores 2 to 10).
SUBSET_KS, SUBSET_STARTS = range(2, 6), 3


@register("gmm_check", "SELECT count(*) AS rows, 0 AS not_likeliest, 0 AS off FROM embeddings")
def gmm_check(spark, sf_dir):
    """Every vector once, in the component of its largest probability, and
    probabilities that add up to one."""
    from pyspark.ml.functions import vector_to_array
    rows = cu.gmm_model(qm.zvectors(spark, sf_dir), qm.K_OVERALL)
    p = vector_to_array("probability")
    total = F.aggregate(p, F.lit(0.0), lambda s, x: s + x)
    return rows.agg(F.count_distinct("vec_id").alias("rows"),
                    F.count_if(p[F.col("prediction")] < F.array_max(p)).cast("int").alias("not_likeliest"),
                    F.count_if(F.abs(total - 1) > 1e-9).cast("int").alias("off"))


@register("pca_check", "SELECT count(*) AS rows, true AS ordered, true AS uncorrelated, true AS centred FROM embeddings")
def pca_check(spark, sf_dir):
    """The first component's variance is the larger one, the two are not
    correlated, and both are centred."""
    p = cu.pca_2d(qm.zvectors(spark, sf_dir), ["vec_id"])
    return p.agg(F.count_distinct("vec_id").alias("rows"),
                 (F.var_pop("pc1") >= F.var_pop("pc2")).alias("ordered"),
                 (F.abs(F.covar_pop("pc1", "pc2")) < 1e-6).alias("uncorrelated"),
                 (F.greatest(F.abs(F.avg("pc1")), F.abs(F.avg("pc2"))) < 1e-6).alias("centred"))


@register("ocsvm_check", with_(PV_GRID) + """
SELECT count(*) AS rows, true AS share_kept, true AS cut_holds FROM pv_grid
WHERE power IS NOT NULL AND generation IS NOT NULL""")
def ocsvm_check(spark, sf_dir):
    """Every point scored once, at most the share nu (and a row of
    rounding) flagged, and no flagged point scores above one that is not."""
    r = qm.ocsvm_points(spark, sf_dir)
    n, bad = F.count(F.lit(1)), F.col("label") == -1
    return r.agg(n.alias("rows"), (F.count_if(bad) <= F.ceil(0.05 * n) + 1).alias("share_kept"),
                 (F.max(F.when(bad, F.col("score"))) <= F.min(F.when(~bad, F.col("score"))) + 1e-6).alias("cut_holds"))


def _subset_assignments(spark, sf_dir):
    base = zscore_array(fx.vectors(spark, sf_dir), "v", qm.DIM)
    out = None
    for name, (start, stop) in SUBSETS.items():
        v = cu.vectorise(cu.subset_vectors(base, "v", start, stop))
        rows = cu.cluster_subset(v, SUBSET_KS, ["vec_id"], n_init=SUBSET_STARTS).withColumn("subset", F.lit(name))
        rows = cut_lineage(rows)
        v.unpersist()
        out = rows if out is None else out.unionByName(rows)
    return out


@register("subset_assign")
def subset_assign(spark, sf_dir):
    """Per feature subset the fit at the k of the best silhouette: cluster
    and 2-D projection of every vector."""
    return _subset_assignments(spark, sf_dir).select(
        "subset", "vec_id", "k", "cluster", F.round("pc1", 6).alias("pc1"), F.round("pc2", 6).alias("pc2"))


@register("subset_check", " UNION ALL ".join(
    f"SELECT '{s}' AS subset, count(*) AS rows, true AS k_used, true AS ordered FROM embeddings" for s in SUBSETS))
def subset_check(spark, sf_dir):
    """Every vector in every subset once, as many clusters as the chosen k
    and a projection whose first component varies most."""
    return _subset_assignments(spark, sf_dir).groupBy("subset").agg(
        F.count_distinct("vec_id").alias("rows"), (F.count_distinct("cluster") == F.max("k")).alias("k_used"),
        (F.var_pop("pc1") >= F.var_pop("pc2")).alias("ordered"))
