"""Isolation forest (N1) and the anomaly jobs built on it.

Training (Liu, Ting & Zhou 2008): each of ``n_trees`` trees isolates
``psi`` = min(256, n) rows drawn without replacement: of the (row, tree) pairs
below a hash threshold - about ``oversample * psi`` a tree, whatever the data
size - each tree takes the ``psi`` with the smallest hash, a bounded top-k.  Trees
are grown in parallel, one ``applyInPandas`` group per tree, and come back as
a node table (at most 2*psi - 1 nodes per tree).  Scoring ships that bounded
table to the executors once and walks all trees for a whole Arrow batch at a
time in ``mapInPandas``: score = 2^(-E[h(x)] / c(psi)).  The label is -1 for
the ``contamination`` share of highest scores (cut = exact quantile of
the scores), 1 otherwise.

Both models fit several groups of rows (``by``, few of them) on their own in
the same jobs: the number of jobs does not depend on how many there are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir, cut_lineage
from .common import top_k
from .gang import Gang, slots
from .quantile import row_quantiles

GANG_BYTES = 1 << 30    # of a task's kernel features, at most, where tasks keep them

NODE_SCHEMA = ("tree int, node int, feature int, threshold double, left int, right int, "
               "size long, leaf boolean")


def c_factor(n: float) -> float:
    """Average unsuccessful-search path length of a BST with n nodes."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n


def _grow(x: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    """Nodes of one isolation tree (pre-order): (node, feature, threshold, left, right, size, leaf)."""
    nodes: list[list] = []

    def build(idx: np.ndarray, depth: int) -> int:
        me = len(nodes)
        nodes.append([me, -1, 0.0, -1, -1, int(len(idx)), True])
        if depth >= max_depth or len(idx) <= 1:
            return me
        sub = x[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        cand = np.flatnonzero(hi > lo)
        if len(cand) == 0:
            return me
        f = int(rng.choice(cand))
        thr = float(rng.uniform(lo[f], hi[f]))
        go_left = sub[:, f] < thr
        nodes[me][1], nodes[me][2], nodes[me][6] = f, thr, False
        nodes[me][3] = build(idx[go_left], depth + 1)
        nodes[me][4] = build(idx[~go_left], depth + 1)
        return me

    build(np.arange(len(x)), 0)
    return [tuple(n) for n in nodes]


def _group_no(by: Sequence[str], groups: Sequence[tuple]) -> Column:
    """Which of ``groups`` (values of ``by``) a row belongs to, from 0; NULL if none."""
    if not by:
        return F.lit(0)
    out = F.lit(None).cast("int")
    for i, group in enumerate(groups):
        same = F.lit(True)
        for c, v in zip(by, group, strict=True):
            same = same & F.col(c).eqNullSafe(F.lit(v))
        out = F.when(same, F.lit(i)).otherwise(out)
    return out


def _labelled(scored: DataFrame, score: str, share: float, groups: int) -> tuple[DataFrame, Column]:
    """(rows cut from their lineage, the exact ``share`` quantile of their group's scores)."""
    scored = cut_lineage(scored)
    cuts = {r["_g"]: r["q"][0] for r in row_quantiles(scored, ["_g"], [share], score).collect()}
    return scored, F.get(F.array(*[F.lit(cuts.get(g)).cast("double") for g in range(max(groups, 1))]), F.col("_g"))


def _fields(df: DataFrame, cols: Sequence[str]) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*cols).schema.fields)


def iforest_fit(df: DataFrame, features: str, keys: Sequence[str], n_trees: int = 100, psi: int = 256, seed: int = 42,
                oversample: float = 1.5, by: Sequence[str] = ()) -> list[tuple[tuple, list, int]]:
    """Grow a forest for each group of ``by`` (one without); returns per group
    (values of ``by``, node rows, effective psi)."""
    sizes = sorted(map(tuple, df.groupBy(*by).agg(F.count(F.lit(1))).collect()), key=repr)
    groups, psis = [r[:-1] for r in sizes], [int(min(psi, r[-1])) for r in sizes]
    if not groups:
        return []
    # (row, tree) pairs by a hash threshold, with a margin; each tree then keeps
    # the psi smallest.  The hash is of the row's keys, so the forest does not
    # depend on how the rows are partitioned.
    keys, span = list(keys), 1 << 40
    below = F.get(F.array(*[F.lit(int(min(1.0, oversample * p / max(r[-1], 1)) * span)).cast("bigint")
                            for p, r in zip(psis, sizes)]), F.col("_g"))
    drawn = F.filter(F.transform(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: F.struct(
        t.alias("tree"), F.pmod(F.xxhash64(*keys, t, F.lit(seed)), F.lit(span)).alias("_h"))),
        lambda p: p["_h"] < F.col("_below"))
    per_tree = df.withColumn("_g", _group_no(by, groups)).withColumn("_below", below).select(
        "_g", *keys, F.col(features).alias("x"), F.explode(drawn).alias("p")).select("_g", *keys, "x", "p.*")
    sizes_of = dict(enumerate(psis))
    chosen = top_k(per_tree, ["_g", "tree"], [F.col("_h"), *map(F.col, keys)], psi, salt_on=keys)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        g, t = int(pdf["_g"].iloc[0]), int(pdf["tree"].iloc[0])
        max_depth = int(math.ceil(math.log2(max(sizes_of[g], 2))))
        x = np.stack(pdf["x"].to_numpy()).astype(float)
        rows = _grow(x, np.random.default_rng(seed * 1000003 + t), max_depth)
        out = pd.DataFrame(rows, columns=["node", "feature", "threshold", "left", "right", "size", "leaf"])
        out.insert(0, "tree", t)
        out.insert(0, "_g", g)
        return out.astype({"_g": "int32", "tree": "int32", "node": "int32", "feature": "int32", "left": "int32",
                           "right": "int32", "size": "int64"})

    nodes: list[list] = [[] for _ in groups]
    for r in chosen.select("_g", "tree", "x").groupBy("_g", "tree").applyInPandas(grow, "_g int, " + NODE_SCHEMA).collect():
        nodes[r[0]].append(tuple(r)[1:])
    return list(zip(groups, nodes, psis))


def _path_lengths(x: np.ndarray, trees: dict) -> np.ndarray:
    total = np.zeros(len(x))
    for arr in trees.values():
        feat, thr, left, right, adj, leaf = arr
        node = np.zeros(len(x), dtype=np.int64)
        depth = np.zeros(len(x))
        active = ~leaf[node]
        while active.any():
            idx = np.flatnonzero(active)
            nd = node[idx]
            go_left = x[idx, feat[nd]] < thr[nd]
            node[idx] = np.where(go_left, left[nd], right[nd])
            depth[idx] += 1
            active = ~leaf[node]
        total += depth + adj[node]
    return total / len(trees)


def _trees(nodes: list) -> dict:
    by_tree: dict[int, list] = {}
    for r in nodes:
        by_tree.setdefault(r[0], []).append(r)
    trees = {}
    for t, rows in by_tree.items():
        rows.sort(key=lambda r: r[1])
        trees[t] = (np.array([r[2] for r in rows]), np.array([r[3] for r in rows]),
                    np.array([r[4] for r in rows]), np.array([r[5] for r in rows]),
                    np.array([c_factor(float(r[6])) for r in rows]), np.array([r[7] for r in rows]))
    return trees


def iforest_score(df: DataFrame, features: str, forests: list[tuple[tuple, list, int]], keep: Sequence[str],
                  by: Sequence[str] = ()) -> DataFrame:
    """Anomaly score per row by its group's forest (higher = more anomalous);
    ``_g`` numbers the groups in the order of ``forests``."""
    bc = df.sparkSession.sparkContext.broadcast([(_trees(nodes), c_factor(psi)) for _, nodes, psi in forests])
    keep = list(keep)

    def score(batches):
        models = bc.value
        for pdf in batches:
            out, s = pdf[[*keep, "_g"]].copy(), np.zeros(len(pdf))
            for g, (trees, cpsi) in enumerate(models):
                at = np.flatnonzero(pdf["_g"].to_numpy() == g)
                if len(at):
                    x = np.stack(pdf["_x"].to_numpy()[at]).astype(float)
                    s[at] = np.power(2.0, -_path_lengths(x, trees) / cpsi) if cpsi > 0 else 0.5
            out["score"] = s
            yield out

    rows = df.select(*keep, _group_no(by, [f[0] for f in forests]).alias("_g"), F.col(features).alias("_x"))
    return rows.mapInPandas(score, _fields(df, keep) + ", _g int, score double")


def iforest(df: DataFrame, features: str, keep: Sequence[str], contamination: float = 0.01,
            n_trees: int = 100, psi: int = 256, seed: int = 42, by: Sequence[str] = ()) -> DataFrame:
    """Fit + score + label (-1 for the top ``contamination`` share), for each
    group of ``by`` on its own."""
    forests = iforest_fit(df, features, keep, n_trees, psi, seed, by=by)
    scored, cut = _labelled(iforest_score(df, features, forests, keep, by), "score", 1.0 - contamination, len(forests))
    return scored.withColumn("label", F.when(F.col("score") > cut, F.lit(-1)).otherwise(F.lit(1))).drop("_g")


def standardise_vector(df: DataFrame, vec: str, dim: int, out: str = "z") -> DataFrame:
    """I15 on a fixed-length array column (population std, constant -> 0)."""
    from .encode import zscore_array
    return zscore_array(df, vec, dim, out)


# ---------------------------------------------------------------- one-class SVM (N2), re-aimed

def rff_draw(dim: int, n_components: int, gamma: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """W (D x d) and b of the random Fourier features of exp(-gamma |x - y|^2)
    (Rahimi & Recht 2007): W ~ N(0, 2 gamma), b ~ U(0, 2 pi)."""
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(n_components, dim))
    return w, rng.uniform(0.0, 2.0 * math.pi, size=n_components)


def rff(x: np.ndarray, w: np.ndarray, b: np.ndarray) -> np.ndarray:
    """z(x) = sqrt(2/D) cos(W x + b) of every row."""
    return math.sqrt(2.0 / len(b)) * np.cos(x @ w.T + b)


class _Svms:
    """One-class SVMs of several groups between two steps, and those still at it."""

    def __init__(self, sizes: Mapping[int, int], n_components: int, nu: float, tol: float):
        self.weight, self.tol, self.t, self.size = {g: nu * n for g, n in sizes.items()}, tol, 0, n_components + 2
        self.w = {g: np.full(n_components, 1.0 / math.sqrt(n_components)) for g in sizes}
        self.rho, self.history = dict.fromkeys(sizes, 0.0), {g: [] for g in sizes}
        self.best, self.active = {g: (math.inf, w) for g, w in self.w.items()}, list(sizes)

    def sums(self, blocks: Iterator[tuple[int, np.ndarray]]) -> np.ndarray:
        """Of each group still at it the vector sum of the rows short of rho,
        their number and how short they are, flat."""
        out = {g: np.zeros(self.size) for g in self.active}
        for g, z in blocks:
            if g in out:
                gap = self.rho[g] - z @ self.w[g]
                short = ~(gap <= 0)
                out[g] += [*(short.astype(float) @ z), short.sum(), gap[short].sum()]
        return np.concatenate(list(out.values()))

    def step(self, sums: np.ndarray) -> None:
        for g, s in zip(list(self.active), sums.reshape(-1, self.size)):
            w, rho, history, weight = self.w[g], self.rho[g], self.history[g], self.weight[g]
            vsum, count, gap = s[:-2], s[-2], s[-1]
            self.best[g] = min(self.best[g], (0.5 * float(w @ w) + gap / weight - rho, w), key=lambda b: b[0])
            history.append(self.best[g][0])
            if len(history) > 10 and history[-11] - history[-1] <= self.tol * max(abs(history[-1]), self.tol):
                self.active.remove(g)
                continue
            step = 1.0 / (self.t + 2)
            self.w[g] = w - step * (w - vsum / weight)
            self.rho[g] = rho - step * (-1.0 + count / weight)
        self.t += 1


def _kernel_blocks(batches: Iterator[pa.RecordBatch], kernels: dict) -> Iterator[tuple[int, np.ndarray]]:
    for batch in batches:
        for g, (w, b) in kernels.items():
            part = batch.filter(pc.equal(batch.column(0), g))
            if part.num_rows:
                x = np.asarray(part.column(1).flatten(), np.float64).reshape(part.num_rows, -1)
                yield g, rff(x, w, b)


def _steps_in_gang(rows: DataFrame, kernels: dict, svms: _Svms, max_steps: int, tasks: int) -> None:
    """All steps in one barrier stage of tasks that keep their rows' features."""
    folder = checkpoint_dir(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, gang = list(_kernel_blocks(batches, kernels)), Gang(folder, tasks)
        while svms.active and svms.t <= max_steps:
            sums = svms.sums(iter(own))
            svms.step(gang.added(sums, 0, len(sums)))
        if gang.me == 0:
            yield pa.RecordBatch.from_pylist(
                [{"g": g, "objective": o, "w": w, "active": g in svms.active} for g, (o, w) in svms.best.items()],
                schema=pa.schema([("g", pa.int32()), ("objective", pa.float64()), ("w", pa.list_(pa.float64())),
                                  ("active", pa.bool_())]))
        gang.end()

    dealt = rows.repartition(tasks).mapInArrow(run, "g int, objective double, w array<double>, active boolean",
                                               barrier=True)
    found = dealt.collect()
    svms.best = {r["g"]: (r["objective"], np.array(r["w"])) for r in found}
    svms.active = [r["g"] for r in found if r["active"]]


def _steps_in_jobs(rows: DataFrame, kernels: dict, svms: _Svms, max_steps: int) -> None:
    """A job a step for all groups: the tasks' sums are added up, and one row comes back."""
    while svms.active and svms.t <= max_steps:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield pa.RecordBatch.from_arrays(
                [pa.array([svms.sums(_kernel_blocks(batches, kernels))], pa.list_(pa.float64()))], ["s"])

        part = rows.mapInArrow(run, "s array<double>").select(array_to_vector("s").alias("s"))
        svms.step(part.agg(Summarizer.sum(F.col("s")).alias("s")).first()["s"].toArray())


def ocsvm(df: DataFrame, features: str, dim: int | Mapping[tuple, int], keep: Sequence[str], nu: float = 0.05,
          n_components: int = 100, tol: float = 1e-3, max_steps: int = 500, seed: int = 42,
          by: Sequence[str] = ()) -> DataFrame:
    """One-class SVM on random Fourier features, gamma = sklearn's 'scale' =
    1 / (d Var(X)), Var over all entries.  Minimises
    1/2 |w|^2 + 1/(nu n) sum max(0, rho - w.z_i) - rho by full-batch
    subgradient steps (one distributed vector sum per step) until the best
    objective has improved by less than ``tol`` of itself over ten steps; more
    than ``max_steps`` raise an error.  The best w is kept; afterwards rho is
    set to the nu-quantile of the scores w.z_i, so the flagged share is nu.
    Label -1 when w.z < rho (sklearn's convention), score = w.z - rho.

    With ``by``, ``dim`` names the groups to fit, each on its own, and the
    length of their features; a group without rows is an error.  All groups take their steps
    together in one barrier stage; a job a step where slots are unknown or a
    task's features pass GANG_BYTES."""
    keep, spark = list(keep), df.sparkSession
    dims = dict(dim) if by else {(): dim}
    z = df.select(*keep, _group_no(by, list(dims)).alias("_g"), F.col(features).alias("_x")).where(
        F.col("_g").isNotNull()).persist(StorageLevel.MEMORY_AND_DISK)
    found = {r["_g"]: r for r in z.select("_g", F.posexplode("_x").alias("_i", "v")).groupBy("_g").agg(
        F.var_pop("v").alias("var"), F.count_if(F.col("_i") == 0).alias("n")).collect()}
    if len(found) < len(dims):
        raise ZeroDivisionError(f"no rows to fit in {[g for i, g in enumerate(dims) if i not in found]}")
    kernels = {}
    for g, d in enumerate(dims.values()):
        var = found[g]["var"] or 1.0
        kernels[g] = rff_draw(d, n_components, 1.0 / (d * var) if var > 0 else 1.0, seed)
    svms = _Svms({g: found[g]["n"] for g in kernels}, n_components, nu, tol)
    rows, tasks, n = z.select("_g", "_x"), slots(spark), sum(r["n"] for r in found.values())
    if tasks and n // tasks * 8 * n_components < GANG_BYTES:
        _steps_in_gang(rows, kernels, svms, max_steps, tasks)
    else:
        _steps_in_jobs(rows, kernels, svms, max_steps)
    if svms.active:
        raise RuntimeError(f"no convergence in {max_steps} steps: objective {svms.best[svms.active[0]][0]:.6g}")
    bc = spark.sparkContext.broadcast({g: (*kernels[g], svms.best[g][1]) for g in kernels})

    def score(batches):
        for pdf in batches:
            out, s = pdf[[*keep, "_g"]].copy(), np.zeros(len(pdf))
            for g, (w, b, best) in bc.value.items():
                at = np.flatnonzero(pdf["_g"].to_numpy() == g)
                if len(at):  # added up component by component, so that equal rows have equal scores
                    parts = rff(np.stack(pdf["_x"].to_numpy()[at]).astype(float), w, b).T
                    s[at] = sum((part * c for part, c in zip(parts, best)), np.zeros(len(at)))
            out["_s"] = s
            yield out

    scored, cut = _labelled(z.mapInPandas(score, _fields(df, keep) + ", _g int, _s double"), "_s", nu, len(dims))
    z.unpersist()
    return scored.select(*keep, (F.col("_s") - cut).alias("score"),
                         F.when(F.col("_s") < cut, F.lit(-1)).otherwise(F.lit(1)).alias("label"))
