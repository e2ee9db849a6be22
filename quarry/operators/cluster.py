"""Clustering on Spark ML.

Vectors come in as ``array<double>`` and are turned into ML vectors with
``array_to_vector``; the vector frame is persisted because every fit (several
seeds, several k) reads it many times.  Only bounded objects reach the
driver: cluster centres, costs, and for the two-phase Ward the micro-cluster
centroids (their number is a parameter, not a data size).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .gang import Gang, slots

STARTS = 16             # k-means|| starts at work at once
GANG_BYTES = 1 << 30    # of a task's rows, at most, where tasks keep them


def vectorise(df: DataFrame, vec: str = "v", out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(vec))).persist(StorageLevel.MEMORY_AND_DISK)


@dataclass
class Centres:
    """A k-means fit: its centres, and the cost of the rows at the last round."""

    centres: np.ndarray
    cost: float

    def clusterCenters(self) -> list[np.ndarray]:
        return list(self.centres)

    def transform(self, vdf: DataFrame) -> DataFrame:
        """The rows with ``prediction``, the first of the nearest centres."""
        centres = self.centres

        @F.pandas_udf("int")
        def nearest(v: pd.Series) -> pd.Series:
            return pd.Series(_nearest(np.stack(v.to_numpy()), centres)[0] if len(v) else [], dtype="int32")

        return vdf.withColumn("prediction", nearest(vector_to_array("features")))


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest centre, squared distance) per row."""
    d = (centres ** 2).sum(axis=1) - 2 * (x @ centres.T)
    at = d.argmin(axis=1)
    return at, np.maximum(d[np.arange(len(x)), at] + (x ** 2).sum(axis=1), 0.0)


def _sums(blocks: Iterator[np.ndarray], fits: dict[int, np.ndarray]) -> np.ndarray:
    """For every fit in turn the vector sums of its clusters, their rows and the
    cost, flat; the centres of all fits meet the rows in one product."""
    every = np.concatenate(list(fits.values()))
    first = np.cumsum([0, *(len(c) for c in fits.values())])
    square = (every ** 2).sum(axis=1)
    total, number, cost = np.zeros(every.shape), np.zeros(len(every)), np.zeros(len(fits))
    for block in blocks:
        for at in range(0, len(block), 2048):
            x = block[at:at + 2048]
            row, d, mine = np.arange(len(x)), square - 2 * (x @ every.T), np.zeros((len(x), len(every)))
            xx = (x ** 2).sum(axis=1)
            for i in range(len(fits)):
                own = first[i] + d[:, first[i]:first[i + 1]].argmin(axis=1)
                mine[row, own] = 1.0
                cost[i] += np.maximum(d[row, own] + xx, 0.0).sum()
            total += mine.T @ x
            number += mine.sum(axis=0)
    return np.concatenate([np.concatenate([total[a:b].ravel(), number[a:b], [cost[i]]])
                           for i, (a, b) in enumerate(zip(first, first[1:]))])


class _Lloyd:
    """Fits between two rounds: their centres and costs, and those still moving."""

    def __init__(self, centres: dict[int, np.ndarray], tol: float):
        self.centres, self.tol = dict(centres), tol
        self.cost, self.active = dict.fromkeys(centres, 0.0), dict(centres)

    def move(self, sums: np.ndarray) -> None:
        """Take the centres of a round's ``_sums``; an empty cluster keeps its own."""
        at = 0
        for i, c in list(self.active.items()):
            s, n = sums[at:at + c.size].reshape(c.shape), sums[at + c.size:at + c.size + len(c)]
            at += c.size + len(c) + 1
            new = np.where(n[:, None] > 0, s / np.maximum(n, 1)[:, None], c)
            self.centres[i], self.cost[i], self.active[i] = new, float(sums[at - 1]), new
            if ((new - c) ** 2).sum(axis=1).max() <= self.tol ** 2:
                del self.active[i]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for b in batches:
        if b.num_rows:
            yield np.asarray(b.column(0).flatten(), np.float64).reshape(b.num_rows, -1)


def _rounds_in_gang(rows: DataFrame, fits: _Lloyd, max_iter: int, tasks: int) -> None:
    """All rounds in one barrier stage of tasks that keep their rows."""
    folder = checkpoint_dir(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, gang = list(_blocks(batches)), Gang(folder, tasks)
        for _ in range(max_iter):
            if not fits.active:
                break
            sums = _sums(iter(own), fits.active)
            fits.move(gang.added(sums, 0, len(sums)))
        if gang.me == 0:
            yield pa.RecordBatch.from_pylist(
                [{"fit": i, "cost": fits.cost[i], "centres": c.ravel()} for i, c in fits.centres.items()],
                schema=pa.schema([("fit", pa.int32()), ("cost", pa.float64()), ("centres", pa.list_(pa.float64()))]))
        gang.end()

    dealt = rows.repartition(tasks).mapInArrow(run, "fit int, cost double, centres array<double>", barrier=True)
    for r in dealt.collect():
        fits.cost[r["fit"]] = r["cost"]
        fits.centres[r["fit"]] = np.array(r["centres"]).reshape(fits.centres[r["fit"]].shape)


def _rounds_in_jobs(rows: DataFrame, fits: _Lloyd, max_iter: int) -> None:
    """A job a round: the tasks' sums are added up, and one row comes back."""
    for _ in range(max_iter):
        if not fits.active:
            return
        active = fits.active

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield pa.RecordBatch.from_arrays([pa.array([_sums(_blocks(batches), active)], pa.list_(pa.float64()))], ["s"])

        part = rows.mapInArrow(run, "s array<double>").select(array_to_vector("s").alias("s"))
        fits.move(part.agg(Summarizer.sum(F.col("s")).alias("s")).first()["s"].toArray())


def kmeans_fits(vdf: DataFrame, ks: Sequence[int], n_init: int = 10, seed: int = 42, max_iter: int = 300,
                tol: float = 1e-2) -> dict[int, Centres]:
    """C1 for several ``ks``: k-means|| starts by Spark ML, ``n_init`` of each, then
    Lloyd's rounds of all fits together over the same rows; a fit leaves when no
    centre has moved by more than ``tol``.  Of each k the fit with the lowest
    training cost (the first of equals) is returned."""
    jobs = [(k, i) for k in ks for i in range(n_init)]
    lean = vdf.select("features").persist(StorageLevel.MEMORY_AND_DISK)

    def start(job: tuple[int, int]) -> np.ndarray:
        k, i = job
        return np.array(KMeans(k=k, seed=seed + i, maxIter=0, featuresCol="features").fit(lean).clusterCenters())

    # independent starts are submitted as concurrent Spark jobs
    with ThreadPoolExecutor(max_workers=STARTS) as pool:
        fits = _Lloyd(dict(enumerate(pool.map(start, jobs))), tol)
    rows = lean.select(vector_to_array("features").alias("x"))
    tasks = slots(vdf.sparkSession)
    if tasks and lean.count() // tasks * 8 * fits.centres[0].shape[1] < GANG_BYTES:
        _rounds_in_gang(rows, fits, max_iter, tasks)
    else:
        _rounds_in_jobs(rows, fits, max_iter)
    lean.unpersist()
    best = {}
    for i, (k, _) in enumerate(jobs):
        if k not in best or fits.cost[i] < best[k].cost:
            best[k] = Centres(fits.centres[i], fits.cost[i])
    return best


def kmeans_best(vdf: DataFrame, k: int, n_init: int = 10, seed: int = 42, max_iter: int = 300,
                tol: float = 1e-2) -> Centres:
    """K-means|| fitted with ``n_init`` seeds, the lowest training cost wins
    (the reference restarts 10 times, trap B24).  sklearn stops when the summed
    squared centre shift is below 1e-4 x the mean feature variance; on
    z-scored features (variance 1) that is a shift of about 1e-2 per centre,
    which is Spark's ``tol`` (a distance)."""
    return kmeans_fits(vdf, [k], n_init, seed, max_iter, tol)[k]


def assign(model, vdf: DataFrame, keep: Sequence[str], out: str = "cluster") -> DataFrame:
    """Identifiers + cluster label."""
    return model.transform(vdf).select(*keep, F.col("prediction").cast("int").alias(out))


def select_k(vdf: DataFrame, ks: Sequence[int], vec: str = "v", n_init: int = 10, seed: int = 42) -> DataFrame:
    """C2 + C3 (``ks`` below the number of rows): for each k the inertia (the fit's cost), silhouette (squared
    Euclidean, Spark's evaluator), Calinski-Harabasz (total SS from one pass)
    and Davies-Bouldin (per-cluster spreads from one pass with the k x d
    centres inlined); ``best``, ``best_ch`` and ``best_db`` mark the
    winners by silhouette, Calinski-Harabasz and Davies-Bouldin (lowest)."""
    ev = ClusteringEvaluator(featuresCol="features", predictionCol="prediction")
    st = vdf.select(F.posexplode(vec).alias("dim", "x")).groupBy("dim").agg(
        F.var_pop("x").alias("v"), F.count(F.lit(1)).alias("n")).collect()
    n = st[0]["n"] if st else 0
    if max(ks) >= n:
        raise ValueError(f"k must be below the number of rows, {n}")
    total_ss = float(sum(r["v"] * r["n"] for r in st))

    fits = kmeans_fits(vdf, ks, n_init, seed)

    def score_k(k: int):
        m = fits[k]
        pred = m.transform(vdf)
        sil = ev.evaluate(pred)
        w = m.cost
        centers = np.array(m.clusterCenters())
        cen = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centers])
        mine = F.element_at(cen, F.col("prediction").cast("int") + 1)
        dist = F.sqrt(F.aggregate(F.zip_with(F.col(vec), mine, lambda a, b: (a - b) * (a - b)),
                                  F.lit(0.0), lambda acc, x: acc + x))
        spread = {r["prediction"]: r["s"] for r in pred.groupBy("prediction").agg(F.avg(dist).alias("s")).collect()}
        labels = sorted(spread)
        kk = len(labels)
        ch = ((total_ss - w) / (kk - 1)) / (w / (n - kk)) if kk > 1 and n > kk and w > 0 else 0.0
        db = float(np.mean([max((spread[i] + spread[j]) / np.linalg.norm(centers[i] - centers[j])
                                for j in labels if j != i) for i in labels])) if kk > 1 else 0.0
        return (int(k), w, float(sil), float(ch), db)

    with ThreadPoolExecutor(max_workers=4) as pool:     # four k at a time
        rows = list(pool.map(score_k, ks))
    best, best_ch = (max(rows, key=lambda r: r[i])[0] for i in (2, 3))
    best_db = min(rows, key=lambda r: r[4])[0]
    out = [(*r, r[0] == best, r[0] == best_ch, r[0] == best_db) for r in rows]
    return vdf.sparkSession.createDataFrame(
        out, "k int, inertia double, silhouette double, calinski_harabasz double, davies_bouldin double, best boolean, "
             "best_ch boolean, best_db boolean")


def gmm_model(vdf: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """The rows with ``probability`` (per component) and ``prediction``."""
    return GaussianMixture(k=k, seed=seed, featuresCol="features").fit(vdf).transform(vdf)


def gmm_assign(vdf: DataFrame, k: int, keep: Sequence[str], seed: int = 42) -> DataFrame:
    """Gaussian mixture hard labels."""
    return gmm_model(vdf, k, seed).select(*keep, F.col("prediction").cast("int").alias("cluster"))


def pca_2d(vdf: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Projection on the first two principal components of the centred
    vectors; each component's sign makes its largest-|loading| entry positive
    (the usual SVD sign convention), so results are reproducible."""
    sc = StandardScaler(withMean=True, withStd=False, inputCol="features", outputCol="centred").fit(vdf)
    cen = sc.transform(vdf)
    m = PCA(k=2, inputCol="centred", outputCol="pc").fit(cen)
    pcs = m.pc.toArray()                               # d x 2, bounded by the dimension
    signs = [1.0 if pcs[np.argmax(np.abs(pcs[:, j])), j] >= 0 else -1.0 for j in range(2)]
    out = m.transform(cen).withColumn("_pc", vector_to_array("pc"))
    return out.select(*keep, (F.col("_pc")[0] * signs[0]).alias("pc1"), (F.col("_pc")[1] * signs[1]).alias("pc2"))


def ward_linkage(cent: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """C4: (left, right, height, size) per merge of weighted points, lowest
    first, clusters numbered on from the points: Ward's agglomeration along
    nearest-neighbour chains, distances updated by the Lance-Williams rule, so
    the work is quadratic in the points.  A height is sqrt(2 n_a n_b / (n_a +
    n_b)) times the distance of the two centroids."""
    n = len(cent)
    w = np.array(weights, float)
    square = ((cent[:, None] - cent[None]) ** 2).sum(axis=2) * (2 * w[:, None] * w[None] / (w[:, None] + w[None]))
    np.fill_diagonal(square, np.inf)
    alive = np.ones(n, bool)
    chain: list[int] = []
    merges = []
    for _ in range(n - 1):
        if not chain:
            chain = [int(np.flatnonzero(alive)[0])]
        while True:
            top = chain[-1]
            near = int(np.argmin(np.where(alive, square[top], np.inf)))
            if len(chain) > 1 and square[top, chain[-2]] <= square[top, near]:
                near = chain[-2]  # the two are each other's nearest
                break
            chain.append(near)
        chain = chain[:-2]
        i, j = min(top, near), max(top, near)
        merges.append((square[i, j], i, j))
        both = ((w + w[i]) * square[i] + (w + w[j]) * square[j] - w * square[i, j]) / (w + w[i] + w[j])
        square[i] = square[:, i] = both
        square[i, i] = np.inf
        square[j] = square[:, j] = np.inf
        alive[j] = False
        w[i] += w[j]
    name, size, out = np.arange(n), np.array(weights, float), []
    parent = np.arange(n)

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for step, (d, i, j) in enumerate(sorted(merges, key=lambda m: (m[0], m[1], m[2]))):
        a, b = root(i), root(j)
        left, right = sorted((int(name[a]), int(name[b])))
        parent[b], size[a], name[a] = a, size[a] + size[b], n + step
        out.append((left, right, float(np.sqrt(max(d, 0.0))), float(size[a])))
    return np.array(out).reshape(-1, 4)


def cut_linkage(links: np.ndarray, points: int, k: int) -> np.ndarray:
    """Labels 0 to k - 1 of the points where the tree has ``k`` clusters left,
    numbered by their first points."""
    group = {i: [i] for i in range(points)}
    for step, (left, right, _, _) in enumerate(links[:points - k]):
        group[points + step] = group.pop(int(left)) + group.pop(int(right))
    label = np.zeros(points, int)
    for new, members in enumerate(sorted(group.values(), key=min)):
        label[members] = new
    return label


def ward_on_centroids(cent: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """Labels of weighted points after Ward's agglomeration down to ``k`` groups."""
    return cut_linkage(ward_linkage(cent, weights), len(cent), k)


def _micro(vdf: DataFrame, micro: int, seed: int):
    """(rows with their micro-cluster, its ids, centroids and sizes)."""
    m = KMeans(k=micro, seed=seed, featuresCol="features").fit(vdf)
    pred = m.transform(vdf)
    sizes = {r["prediction"]: r["count"] for r in pred.groupBy("prediction").count().collect()}
    ids = sorted(sizes)
    return pred, ids, np.array(m.clusterCenters())[ids], np.array([sizes[i] for i in ids])


def ward_two_phase(vdf: DataFrame, k: int, keep: Sequence[str], micro: int = 100, seed: int = 42
                   ) -> tuple[DataFrame, DataFrame]:
    """C4: (labels, linkage): ``micro`` k-means micro-clusters on Spark, Ward on
    their weighted centroids (so many points on the driver, whatever the data
    size), labels joined back by micro id; the linkage holds step, left_id,
    right_id, height and size in rows.  ``micro`` is a parameter of the result: at
    most the number of rows, or an error is raised."""
    n = vdf.count()
    if not k <= micro <= n:
        raise ValueError(f"micro must be between k = {k} and the number of rows, {n}")
    pred, ids, cent, sizes = _micro(vdf, micro, seed)
    links = ward_linkage(cent, sizes)
    lab = cut_linkage(links, len(ids), min(k, len(ids)))
    spark = vdf.sparkSession
    mapping = spark.createDataFrame([(int(i), int(lab[j])) for j, i in enumerate(ids)], "prediction int, cluster int")
    table = spark.createDataFrame([(i, int(a), int(b), float(h), int(s)) for i, (a, b, h, s) in enumerate(links)],
                                  "step int, left_id int, right_id int, height double, size long")
    return pred.withColumn("prediction", F.col("prediction").cast("int")).join(mapping, "prediction").select(
        *keep, "cluster"), table


def subset_vectors(df: DataFrame, vec: str, start: int, stop: int, out: str = "v") -> DataFrame:
    """A positional slice of the vector as a feature subset."""
    return df.withColumn(out, F.slice(vec, start + 1, stop - start))


def cluster_subset(vdf: DataFrame, ks: Sequence[int], keep: Sequence[str], n_init: int = 10, seed: int = 42) -> DataFrame:
    """(keep..., k, cluster, pc1, pc2): k-means at the k of the best
    silhouette (the smallest k on ties) and the two-dimensional projection.
    The fits that k is chosen from are kept, so none is repeated."""
    ev = ClusteringEvaluator(featuresCol="features", predictionCol="prediction")
    fits = kmeans_fits(vdf, ks, n_init, seed)
    best = max(fits, key=lambda k: (ev.evaluate(fits[k].transform(vdf)), -k))
    labels = assign(fits[best], vdf, keep).withColumn("k", F.lit(best))
    return labels.join(pca_2d(vdf, keep), list(keep))
