"""Nearest neighbours, density clustering and resampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import classify as cl
from ..operators import neighbours as nb
from ..operators import quantile as qu
from ..operators import resample as rs
from ..operators.common import running_totals
from ..operators.encode import zscore_array
from ..session import cut_lineage
from ..sources import fixtures as fx
from .q_models import DIM, _split
from .registry import register
from .sqlfix import DOC_SPLIT, ZVECTORS, with_

NEIGHBOURS = 5
EPS_SHARE = 0.95    # of the ascending distances to the fifth row, itself counted


def _r(c, n=6):
    return F.round(c, n)


def _zvectors(spark, sf_dir):
    return zscore_array(fx.vectors(spark, sf_dir), "v", DIM)


DISTANCES = """
d AS (SELECT a.vec_id AS a, b.vec_id AS b, round(list_distance(a.v, b.v), 9) AS d FROM z a, z b)"""
K_DISTANCE = f"""
kd AS (SELECT a AS vec_id, max(d) AS k_distance FROM (
         SELECT a, d FROM d QUALIFY row_number() OVER (PARTITION BY a ORDER BY d, b) <= {NEIGHBOURS}) GROUP BY a)"""


@register("k_neighbours", with_(ZVECTORS, DISTANCES) + f"""
SELECT a AS vec_id, row_number() OVER (PARTITION BY a ORDER BY d, b)::INTEGER AS rank, b AS neighbour,
       round(d, 6) AS distance
FROM d WHERE a <> b QUALIFY rank <= {NEIGHBOURS}""")
def k_neighbours(spark, sf_dir):
    """The five nearest other vectors of each z-scored vector."""
    near = nb.nearest(_zvectors(spark, sf_dir), "vec_id", "v", NEIGHBOURS)
    return near.withColumn("distance", _r(F.col("distance")))


def _k_distances(vectors):
    return cut_lineage(nb.k_distances(vectors, "vec_id", "v", NEIGHBOURS))


@register("k_distance", with_(ZVECTORS, DISTANCES, K_DISTANCE) + """
SELECT vec_id, round(k_distance, 6) AS k_distance, row_number() OVER (ORDER BY k_distance, vec_id) - 1 AS position
FROM kd""")
def k_distance(spark, sf_dir):
    """The k-distance curve: each vector's place in ascending order."""
    kd = _k_distances(_zvectors(spark, sf_dir)).withColumn("_one", F.lit(1))
    out = running_totals(kd, "k_distance", ["_one"], tiebreak=["vec_id"])
    return out.select("vec_id", _r(F.col("k_distance")).alias("k_distance"), (F.col("cum__one") - 1).alias("position"))


def _dbscan(spark, sf_dir):
    vectors = cut_lineage(_zvectors(spark, sf_dir).select("vec_id", "v"))
    eps = qu.order_statistic(_k_distances(vectors), "k_distance", EPS_SHARE).first()["value"]
    return nb.density_clusters(vectors, "vec_id", "v", eps, NEIGHBOURS)


DBSCAN = f"""
eps AS (SELECT k_distance AS eps FROM kd QUALIFY row_number() OVER (ORDER BY k_distance)
               = 1 + floor({EPS_SHARE}::DOUBLE * count(*) OVER ())::BIGINT),
near AS (SELECT a, b FROM d, eps WHERE d <= eps),
core AS (SELECT a, count(*) AS n FROM near GROUP BY a),
links AS (SELECT near.a, near.b FROM near JOIN core x ON x.a = near.a AND x.n >= {NEIGHBOURS}
          JOIN core y ON y.a = near.b AND y.n >= {NEIGHBOURS}),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
root AS (SELECT a, min(b) AS cluster FROM reach GROUP BY a),
label AS (SELECT near.a, min(cluster) AS cluster FROM near JOIN root ON root.a = near.b GROUP BY near.a),
dbscan AS (SELECT core.a AS vec_id, core.n AS n_within, core.n >= {NEIGHBOURS} AS core,
                  coalesce(root.cluster, label.cluster) AS cluster
           FROM core LEFT JOIN root ON root.a = core.a LEFT JOIN label ON label.a = core.a)"""
DBSCAN_SQL = "WITH RECURSIVE " + ",".join((ZVECTORS, DISTANCES, K_DISTANCE, DBSCAN)) + "\n"


@register("dbscan", DBSCAN_SQL + "SELECT * FROM dbscan")
def dbscan(spark, sf_dir):
    """Density clusters of the z-scored vectors; eps is the element at 95
    per cent of the k-distance curve."""
    return _dbscan(spark, sf_dir)


@register("dbscan_counts", DBSCAN_SQL + """
SELECT cluster, count(*) AS rows, count_if(core) AS core_rows FROM dbscan GROUP BY cluster""")
def dbscan_counts(spark, sf_dir):
    """Rows and core rows per cluster; the null cluster is noise."""
    return _dbscan(spark, sf_dir).groupBy("cluster").agg(F.count(F.lit(1)).alias("rows"),
                                                         F.count_if("core").alias("core_rows"))


def _train(spark, sf_dir):
    return _split(spark, sf_dir).where(F.col("split") == "train").select("doc_id", "y", *cl.TEXT_FEATURES)


FEATURES = ", ".join(cl.TEXT_FEATURES)


def smote_sql(ratio: float) -> str:
    """CTEs ending in ``made``: the generated rows of the smaller class."""
    return f"""
train AS (SELECT doc_id, y, [{FEATURES}] AS v FROM doc_split WHERE split = 'train'),
size AS (SELECT y, count(*) AS n FROM train GROUP BY y),
want AS (SELECT y, n, floor((SELECT max(n) FROM size) * {ratio}::DOUBLE)::BIGINT - n AS want FROM size),
base AS (SELECT t.*, n, want, row_number() OVER (PARTITION BY t.y ORDER BY
             ('0x' || md5(doc_id || ':42')[1:12])::BIGINT, doc_id) - 1 AS turn
         FROM train t JOIN want USING (y) WHERE want > 0),
near AS (SELECT a.doc_id, b.doc_id AS neighbour, b.v AS w,
                row_number() OVER (PARTITION BY a.doc_id ORDER BY round(list_distance(a.v, b.v), 9), b.doc_id) AS rank
         FROM base a JOIN base b ON a.y = b.y AND a.doc_id <> b.doc_id QUALIFY rank <= 5),
turns AS (SELECT doc_id, y, v, unnest(range(1, want // n + (turn < want % n)::INT + 1)) AS copy FROM base),
pick AS (SELECT t.*, ('0x' || md5('which:' || t.doc_id || ':' || copy || ':42')[1:8])::BIGINT
                     % (SELECT max(rank) FROM near m WHERE m.doc_id = t.doc_id) + 1 AS rank,
                ('0x' || md5('far:' || t.doc_id || ':' || copy || ':42')[1:8])::BIGINT / 4294967296.0::DOUBLE AS part
         FROM turns t),
made AS (SELECT p.doc_id, copy::INTEGER AS copy, y, neighbour,
                [p.v[i] + part * (w[i] - p.v[i]) for i in range(1, {len(cl.TEXT_FEATURES) + 1})] AS v
         FROM pick p JOIN near USING (doc_id, rank))"""


COLUMNS = ", ".join(f"round(v[{i}], 6) AS {c}" for i, c in enumerate(cl.TEXT_FEATURES, 1))


def _rounded(df, *keys):
    return df.select(*keys, *[_r(F.col(c)).alias(c) for c in cl.TEXT_FEATURES])


@register("smote_rows", with_(DOC_SPLIT, smote_sql(1.0)) + f"SELECT doc_id, copy, y, neighbour, {COLUMNS} FROM made")
def smote_rows(spark, sf_dir):
    """K6 on the training part: every generated row of the smaller class."""
    made = rs.smote_rows(_train(spark, sf_dir), "y", "doc_id", cl.TEXT_FEATURES, k=NEIGHBOURS)
    return _rounded(made, "doc_id", "copy", "y", "neighbour")


OVER, UNDER = 0.5, 0.8


@register("combined_resample", with_(DOC_SPLIT, smote_sql(OVER), f"""
rows AS (SELECT doc_id, 0 AS copy, y, v FROM train UNION ALL SELECT doc_id, copy, y, v FROM made),
sized AS (SELECT *, count(*) OVER (PARTITION BY y) AS n,
                 row_number() OVER (PARTITION BY y ORDER BY
                     ('0x' || md5(doc_id || ':' || copy || ':42')[1:12])::BIGINT, doc_id || ':' || copy) - 1 AS rank
          FROM rows)""") + f"""
SELECT doc_id, copy, y, {COLUMNS} FROM sized
WHERE n = (SELECT min(n) FROM sized) OR rank < floor((SELECT min(n) FROM sized) / {UNDER}::DOUBLE)""")
def combined_resample(spark, sf_dir):
    """K8: the smaller class generated up to half of the larger one, which is
    then cut to 1 / 0.8 of the smaller one."""
    both = rs.combined_resample(_train(spark, sf_dir), "y", "doc_id", cl.TEXT_FEATURES, OVER, UNDER, NEIGHBOURS)
    return _rounded(both, "doc_id", "copy", "y")
