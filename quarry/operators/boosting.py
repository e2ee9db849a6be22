"""Gradient-boosted trees for many models at once.

Features are binned once.  All models of a call - grid points, folds, feature
modules - grow their trees level by level together, all of them in one barrier
stage (``gang``): every task keeps its rows with their margins, sums the
gradients per (model, node, feature, bin), and the tasks add up the sums among
them, each for its share of the nodes, and tell each other the best splits.
Models that differ in their number of trees only are one fit, looked at twice.
Where a task's rows with all models pass ``GANG_BYTES``, the models take turns, some
of them in a stage.

Where a stage of all rows is not to be had (slots unknown, or more rows a slot
than ``GANG_BYTES`` hold with one model), a level is a job: sums are made next to the rows, meet
in a shuffle, and only a row per model and node comes to the driver.  A row's
margins are then written to the shared checkpoint folder every few trees, and
the trees since then travel with the job.

The objective is logistic with weights for the positive class; a split's gain
and a leaf's value follow the regularised second-order form: for sums G and H of
gradients and Hessians, score = T(G)^2 / (H + l2) and value = -T(G) / (H + l2),
where T moves G towards 0 by ``l1``; a split must gain more than ``gamma``.
"""

from __future__ import annotations

import math
import pickle
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, fields, replace

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir, cut_lineage
from .gang import Gang, slots

BINS = 64           # of a feature, at most, one more for null
CELLS = 2_000_000   # (row, model, feature) triples summed at a time
CUT_EVERY = 8       # trees between two written margins
GANG_BYTES = 1 << 30    # of a task's rows with what it keeps of the models it fits at a time, at most


@dataclass(frozen=True)
class Params:
    """One model: its parameters, the fold it must not see (None: sees all
    rows) and the features it may use (None: all)."""

    trees: int = 100
    depth: int = 5
    rate: float = 0.1
    subsample: float = 0.8
    colsample: float = 0.8
    gamma: float = 0.0
    l1: float = 0.0
    l2: float = 1.0
    pos_weight: float = 3.0
    min_child: float = 1.0
    fold: int | None = None
    columns: tuple[str, ...] | None = None


@dataclass
class Tree:
    """One tree of every model, as complete binary trees: at inner node i rows
    go left to 2 i + 1 if their bin of ``feature`` is at most ``bin``, else to
    2 i + 2; a node without a split sends all rows left.  ``value`` is what a
    row at the node would get, ``cover`` its Hessian, ``gain`` its split's."""

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray

    @staticmethod
    def empty(models: int, depth: int) -> Tree:
        inner, every = 2 ** depth - 1, 2 ** (depth + 1) - 1
        return Tree(np.zeros((models, inner), np.int16), np.full((models, inner), 255, np.int16),
                    np.zeros((models, every)), np.zeros((models, every)), np.zeros((models, inner)))

    def walk(self, bins: np.ndarray, node: np.ndarray, levels: int) -> np.ndarray:
        """From ``node`` (row x model) some levels down."""
        model = np.arange(len(self.feature))[None]
        row = np.arange(len(bins))[:, None]
        for _ in range(levels):
            node = 2 * node + 1 + (bins[row, self.feature[model, node]] > self.bin[model, node])
        return node

    @property
    def depth(self) -> int:
        return int(math.log2(self.feature.shape[1] + 1))


@dataclass
class Forest:
    """The trees of all models with the bin edges of the features."""

    columns: list[str]
    edges: list[np.ndarray]
    params: list[Params]
    trees: list[Tree] = field(default_factory=list)

    def binned(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``keep`` and ``bins``, a byte per feature: 0 for null, else 1 + the
        number of edges below the value."""
        def place(c: str, edges: np.ndarray):
            # nested halving: as many comparisons as the edges' number has bits
            def halve(a: int, b: int):
                if a == b:
                    return F.lit(a + 1)
                m = (a + b) // 2
                return F.when(F.col(c) > F.lit(float(edges[m])), halve(m + 1, b)).otherwise(halve(a, m))
            return F.when(F.col(c).isNull() | F.isnan(c), 0).otherwise(halve(0, len(edges)))
        digits = F.concat(*[F.lpad(F.hex(place(c, e)), 2, "0") for c, e in zip(self.columns, self.edges, strict=True)])
        return df.select(*keep, F.unhex(digits).alias("bins"))

    def table(self, spark, model: int = 0) -> DataFrame:
        """The nodes of one model: tree, node, feature, edge (rows at or below
        it, and nulls, go left), gain, cover, value; unsplit nodes have no
        feature.  Its size is bounded by the parameters."""
        rows = []
        for t, tree in enumerate(self.trees[:self.params[model].trees]):
            for i in range(tree.value.shape[1]):
                split = i < tree.feature.shape[1] and tree.bin[model, i] < 255
                if not (tree.cover[model, i] or i == 0):
                    continue
                f = int(tree.feature[model, i]) if split else None
                b = int(tree.bin[model, i]) if split else 0
                edge = float(self.edges[f][b - 1]) if split and b else None
                rows.append((t, i, self.columns[f] if split else None, edge, float(tree.gain[model, i]) if split else None,
                             float(tree.cover[model, i]), float(tree.value[model, i])))
        return spark.createDataFrame(rows, "tree int, node int, feature string, edge double, gain double, cover double, "
                                           "value double")

    def importance(self, spark, model: int = 0) -> DataFrame:
        """(feature, importance): a feature's share of all gains."""
        total = dict.fromkeys(self.columns, 0.0)
        for tree in self.trees[:self.params[model].trees]:
            for i in np.flatnonzero(tree.bin[model] < 255):
                total[self.columns[tree.feature[model, i]]] += float(tree.gain[model, i])
        whole = sum(total.values()) or 1.0
        return spark.createDataFrame([(c, v / whole) for c, v in total.items()], "feature string, importance double")


def find_edges(df: DataFrame, columns: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Bin edges per feature: distinct approximate quantiles (a bounded row)."""
    at = [i / bins for i in range(1, bins)]
    row = df.agg(*[F.percentile_approx(F.when(~F.isnan(c), F.col(c).cast("double")), at, 10_000) for c in columns]).first()
    return [np.unique(np.array(q or [], float)) for q in row]


def _uniform(keys: np.ndarray, salt: int) -> np.ndarray:
    """A number in [0, 1) per key, the same wherever the row is."""
    x = keys.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) & (2 ** 64 - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) / 2.0 ** 53


def _rows(batch: pa.RecordBatch, features: int, models: int):
    n = batch.num_rows
    bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(n, features)
    margin = np.frombuffer(b"".join(batch.column("margin").to_pylist()), np.float64).reshape(n, models)
    return bins, margin


def _margins(bins: np.ndarray, margin: np.ndarray, trees: Sequence[Tree]) -> np.ndarray:
    """Margins with the values of further trees."""
    model = np.arange(margin.shape[1])[None]
    for tree in trees:
        leaf = tree.walk(bins, np.zeros(margin.shape, np.int64), tree.depth)
        margin = margin + tree.value[model, leaf]
    return margin


def score(g: np.ndarray, h: np.ndarray, l1: np.ndarray, l2: np.ndarray) -> np.ndarray:
    t = np.maximum(np.abs(g) - l1, 0.0)
    return t * t / (h + l2)


def weight(g: np.ndarray, h: np.ndarray, l1: np.ndarray, l2: np.ndarray) -> np.ndarray:
    return -np.sign(g) * np.maximum(np.abs(g) - l1, 0.0) / (h + l2)


def best_splits(g: np.ndarray, h: np.ndarray, allowed: np.ndarray, l1: float, l2: float, gamma: float,
                min_child: float) -> list[tuple]:
    """Per node of a level (node x feature x bin sums): (node, feature, bin, gain,
    left G, left H, G, H); feature -1 where nothing gains."""
    gl, hl = g.cumsum(axis=2), h.cumsum(axis=2)
    total_g, total_h = gl[:, :1, -1:], hl[:, :1, -1:]
    gr, hr = total_g - gl, total_h - hl
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = 0.5 * (score(gl, hl, l1, l2) + score(gr, hr, l1, l2) - score(total_g, total_h, l1, l2)) - gamma
    gain = np.where((hl >= min_child) & (hr >= min_child) & allowed[None, :, None] & (gain > 1e-10), gain, -np.inf)
    flat = gain.reshape(len(gain), -1)
    out = []
    for node in np.flatnonzero(total_h[:, 0, 0] > 0):
        at = int(flat[node].argmax())
        f, b = divmod(at, g.shape[2])
        if flat[node, at] == -np.inf:
            f, b = -1, 0
        out.append((int(node), f, b, float(flat[node, at]) if f >= 0 else 0.0, float(gl[node, f, b]),
                    float(hl[node, f, b]), float(total_g[node, 0, 0]), float(total_h[node, 0, 0])))
    return out


PARTIAL = "part int, cell binary, g binary, h binary"
SPLIT = "model int, node int, feature int, bin int, gain double, gl double, hl double, g double, h double"


def _level(state: DataFrame, params: Sequence[Params], allowed: np.ndarray, trees: list[Tree], tree: Tree, number: int,
           level: int, features: int, parts: int) -> list:
    """One job: the best split of every open node of a level."""
    models = [m for m, p in enumerate(params) if p.depth > level and p.trees > number]
    rows_at = np.array(models)
    rate = np.array([params[m].subsample for m in models])
    hold = np.array([-1 if params[m].fold is None else params[m].fold for m in models])
    heavy = np.array([params[m].pos_weight for m in models])
    nodes, width = 2 ** level, BINS + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(models) * nodes * features * width
        step = max(1, CELLS // (len(models) * features))
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                bins, margin = _rows(batch, features, len(params))
                margin = _margins(bins, margin, trees)
                node = (tree.walk(bins, np.zeros(margin.shape, np.int64), level) - (nodes - 1))[:, rows_at]
                y = batch.column("y").to_numpy()[:, None]
                use = hold[None] != batch.column("fold").to_numpy()[:, None]
                use &= _uniform(batch.column("key").to_numpy(), number)[:, None] < rate[None]
                q = 1 / (1 + np.exp(-margin[:, rows_at]))
                w = np.where(y == 1, heavy[None], 1.0) * use
                cell = ((np.arange(len(models))[None] * nodes + node)[:, :, None] * features
                        + np.arange(features)[None, None]) * width + bins[:, None, :]
                cell, flat = cell.ravel(), np.repeat(use.ravel(), features)
                g, h = np.repeat((w * (q - y)).ravel(), features), np.repeat((w * q * (1 - q)).ravel(), features)
                if size <= 4 * CELLS:
                    seen = np.bincount(cell[flat], minlength=size).nonzero()[0]
                    sg, sh = np.bincount(cell[flat], g[flat], size)[seen], np.bincount(cell[flat], h[flat], size)[seen]
                else:
                    seen, back = np.unique(cell[flat], return_inverse=True)
                    sg, sh = np.bincount(back, g[flat], len(seen)), np.bincount(back, h[flat], len(seen))
                part = seen // (nodes * features * width) % parts
                for p in np.unique(part).tolist():
                    mine = part == p
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([p], pa.int32()), *(pa.array([x[mine].tobytes()], pa.binary())
                                                      for x in (seen.astype(np.int64), sg, sh))],
                        ["part", "cell", "g", "h"])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g: dict[int, np.ndarray] = {}
        h: dict[int, np.ndarray] = {}
        each = nodes * features * width
        for batch in batches:
            for r in batch.to_pylist():
                cell, sg, sh = (np.frombuffer(r[c], t) for c, t in (("cell", np.int64), ("g", float), ("h", float)))
                model = cell // each
                for m in np.unique(model).tolist():
                    mine = model == m
                    for total, values in ((g, sg), (h, sh)):
                        np.add.at(total.setdefault(m, np.zeros(each)), cell[mine] % each, values[mine])
        out = []
        for m in sorted(g):
            p = params[models[m]]
            for split in best_splits(g[m].reshape(nodes, features, width), h[m].reshape(nodes, features, width),
                                     allowed[models[m]], p.l1, p.l2, p.gamma, p.min_child):
                out.append((models[m], *split))
        if out:
            names = [c.split()[0] for c in SPLIT.split(", ")]
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], _SPLIT_SCHEMA)

    return state.mapInArrow(sums, PARTIAL).repartitionById(parts, F.col("part")).mapInArrow(best, SPLIT).collect()


_SPLIT_TYPE = np.dtype([(c.split()[0], np.int32 if c.endswith("int") else float) for c in SPLIT.split(", ")])
_SPLIT_SCHEMA = pa.schema([(c.split()[0], pa.int32() if c.endswith("int") else pa.float64())
                           for c in SPLIT.split(", ")])


def fit(df: DataFrame, key: str, y: str, columns: Sequence[str], params: Sequence[Params], fold: str | None = None,
        seed: int = 42, parts: int | None = None) -> tuple[Forest, DataFrame]:
    """Fit all models and return (forest, rows): rows hold key, y, fold, bins
    and margin (float64 bytes, one per model) after the last tree.

    ``key`` is a unique integer; ``y`` 0 or 1; ``fold`` small integers (a
    model does not see the rows of its own).  Null or NaN features go left at
    every split; a table without rows is refused."""
    columns, params = list(columns), list(params)
    forest = Forest(columns, find_edges(df, columns), params)
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(y).cast("int").alias("y"),
                     (F.col(fold) if fold else F.lit(-2)).cast("int").alias("fold"), *columns)
    rows = cut_lineage(forest.binned(rows, ["key", "y", "fold"]))
    can = np.array([[p.columns is None or c in p.columns for c in columns] for p in params])
    tasks, count = slots(rows.sparkSession), rows.count()
    once = _at_once(count // tasks, len(columns), len(params)) if tasks else 0
    if once:
        return forest, _fit_gang(rows, forest, can, seed, tasks, once)
    zero = bytes(8 * len(params))
    state = rows.withColumn("margin", F.lit(zero)).persist(StorageLevel.MEMORY_AND_DISK)
    parts = parts or max(1, min(len(params), state.sparkSession.sparkContext.defaultParallelism))
    rng, pending = np.random.default_rng(seed), []
    for number in range(max(p.trees for p in params)):
        depth = max(p.depth for p in params if p.trees > number)
        tree = Tree.empty(len(params), depth)
        allowed = _column_sample(rng, can, params)
        for level in range(depth):
            found = _level(state, params, allowed, pending, tree, number, level, len(columns), parts)
            found = np.array([tuple(r) for r in found], _SPLIT_TYPE)
            if not len(grow(tree, found, params, level)):
                break
        forest.trees.append(tree)
        pending.append(tree)
        if len(pending) == CUT_EVERY:
            state, pending = _advance(state, pending, len(columns), len(params)), []
    if pending:
        state = _advance(state, pending, len(columns), len(params))
    return forest, state


def _column_sample(rng: np.random.Generator, can: np.ndarray, params: Sequence[Params]) -> np.ndarray:
    """The features each model may use in its next tree."""
    out = np.zeros_like(can)
    draw = rng.random(can.shape[1])  # one draw for all models: models of equal parameters stay comparable
    for m, p in enumerate(params):
        own = np.flatnonzero(can[m])
        n = max(1, int(p.colsample * len(own) + 1e-9))
        out[m, own[np.argsort(draw[own], kind="stable")[:n]]] = True
    return out


def grow(tree: Tree, found: np.ndarray, params: Sequence[Params], level: int) -> np.ndarray:
    """Put a level's splits into the tree; those that split a node."""
    m, i, split = found["model"], 2 ** level - 1 + found["node"], found["feature"] >= 0
    l1, l2, rate = (np.array([getattr(p, c) for p in params])[m] for c in ("l1", "l2", "rate"))

    def put(rows: np.ndarray, child: np.ndarray, g: np.ndarray, h: np.ndarray) -> None:
        value = weight(g, h, l1[rows], l2[rows]) * rate[rows]
        while len(child) and child[0] < tree.value.shape[1]:  # and on to the left, for rows that are not split again
            tree.value[m[rows], child], tree.cover[m[rows], child] = value, h
            child = 2 * child + 1

    every, cut = np.arange(len(found)), np.flatnonzero(split)
    if level == 0:
        tree.value[m, 0], tree.cover[m, 0] = weight(found["g"], found["h"], l1, l2) * rate, found["h"]
    tree.feature[m[cut], i[cut]], tree.bin[m[cut], i[cut]], tree.gain[m[cut], i[cut]] = (
        found[c][cut] for c in ("feature", "bin", "gain"))
    put(every, 2 * i + 1, np.where(split, found["gl"], found["g"]), np.where(split, found["hl"], found["h"]))
    put(cut, 2 * i[cut] + 2, (found["g"] - found["gl"])[cut], (found["h"] - found["hl"])[cut])
    return found[cut]


def _at_once(rows: int, columns: int, models: int) -> int:
    """Models that a task with so many rows fits at a time within ``GANG_BYTES``:
    a row has its bins and a margin per model of all, and of each model at work a
    margin, its place, and G and H where it is used."""
    return max(0, int((GANG_BYTES / max(1, rows) - 9 * columns - 40 - 8 * models) // 44))


def _fit_gang(rows: DataFrame, forest: Forest, can: np.ndarray, seed: int, tasks: int, once: int) -> DataFrame:
    """All trees of all models, ``once`` models at a time in a barrier stage;
    ``forest`` gets the trees."""
    params = forest.params
    alike: dict[Params, list[int]] = {}  # models that differ in the number of trees only grow the same ones
    for i, p in enumerate(params):
        alike.setdefault(replace(p, trees=0), []).append(i)
    sets = list(alike.values())
    # a tree is as deep as the deepest of all models that have one of its number
    depths = [max(p.depth for p in params if p.trees > t) for t in range(max(p.trees for p in params))]
    stages = -(-len(sets) // once)
    order, trees = [], []
    for part in (sets[len(sets) * i // stages:len(sets) * (i + 1) // stages] for i in range(stages)):
        order += [i for same in part for i in same]
        last = np.argsort(order) if len(order) == len(params) else None
        rows, grown = _fit_stage(rows, forest, part, can, depths, seed, tasks, last)
        trees.append([*grown, *(Tree.empty(len(part), d) for d in depths[len(grown):])])
    which = np.empty(len(params), int)
    for at, same in enumerate(sets):
        which[same] = at
    for level in zip(*trees, strict=True):
        forest.trees.append(Tree(*(np.concatenate([getattr(t, f.name) for t in level])[which] for f in fields(Tree))))
    return rows


def _fit_stage(rows: DataFrame, forest: Forest, sets: list[list[int]], can: np.ndarray, depths: list[int], seed: int,
               tasks: int, last: np.ndarray | None) -> tuple[DataFrame, list[Tree]]:
    """A barrier stage that fits one model for each of ``sets`` (places of models
    that differ in the number of trees only): the rows with their margins behind
    those they have, put in the order ``last`` if given, and the trees."""
    params, features, width = [forest.params[i] for same in sets for i in same], len(forest.columns), BINS + 1
    which = np.repeat(np.arange(len(sets)), [len(same) for same in sets])
    models = [replace(forest.params[same[0]], trees=max(forest.params[i].trees for i in same)) for same in sets]
    able = can[[same[0] for same in sets]]
    spark, more = rows.sparkSession, "margin" in rows.columns
    folder = checkpoint_dir(spark)
    out = pa.schema([("key", pa.int64()), ("y", pa.int32()), ("fold", pa.int32()), ("bins", pa.binary()),
                     ("margin", pa.binary()), ("tree", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [b for b in batches if b.num_rows]
        gang, rng = Gang(folder, tasks), np.random.default_rng(seed)
        n = sum(b.num_rows for b in own)
        joined = b"".join(x for b in own for x in b.column("bins").to_pylist())
        bins = np.ascontiguousarray(np.frombuffer(joined, np.uint8).reshape(n, features).T)
        flat, cells = bins.ravel(), bins.astype(np.int64)
        y, fold, key = (np.concatenate([b.column(c).to_numpy() for b in own]) if own else np.zeros(0, np.int64)
                        for c in ("y", "fold", "key"))
        margin, told = [np.zeros(n) for _ in models], [np.zeros(n) for _ in params]
        for number in range(max(p.trees for p in models)):
            going = [m for m, p in enumerate(models) if p.trees > number]
            tree = Tree.empty(len(models), depths[number])
            allowed = _column_sample(rng, able, models)
            chance = _uniform(key, number)
            drawn, used, rest = {}, {}, {}
            for m in going:
                p = models[m]
                if (p.subsample, p.fold, p.pos_weight) not in drawn:
                    use = (chance < p.subsample) & (fold != (-1 if p.fold is None else p.fold))
                    r, other = np.flatnonzero(use), np.flatnonzero(~use)
                    drawn[p.subsample, p.fold, p.pos_weight] = (
                        r, np.zeros(len(r), np.int64), y[r], np.where(y[r] == 1, p.pos_weight, 1.0), other,
                        np.zeros(len(other), np.int64))
                r, start, label, w, other, start_too = drawn[p.subsample, p.fold, p.pos_weight]
                q = 1 / (1 + np.exp(-margin[m].take(r)))
                gh = np.empty(len(r), complex)  # G and H are added up in one go
                gh.real, gh.imag = w * (q - label), w * q * (1 - q)
                used[m], rest[m] = (r, start, gh), (other, start_too)
            todo = {m: np.zeros(1, np.int64) for m in going if models[m].depth}
            level = 0
            while todo:
                found = _gang_level(gang, models, allowed, todo, cells, width, used)
                cut = grow(tree, found, models, level)
                after = {}
                for m, places in todo.items():
                    c, p, here = cut[cut["model"] == m], models[m], 2 ** level - 1
                    if not len(c):  # all rows stay where they are
                        for r, s in (used[m][:2], rest[m]):
                            margin[m][r] += tree.value[m, here + places].take(s)
                        continue
                    at = np.searchsorted(places, c["node"])
                    column, edge = np.zeros(len(places), np.int64), np.full(len(places), 255, np.uint8)
                    column[at], edge[at] = c["feature"].astype(np.int64) * n, c["bin"]
                    value = tree.value[m, (2 * (here + places[:, None]) + 1 + np.arange(2)).ravel()]
                    # a node is split where both sides get min_child, so a lighter one than two of them stays
                    kids = np.concatenate([2 * c["node"] + i for i in (0, 1)]).astype(np.int64)
                    heavy = np.concatenate([c["hl"], c["h"] - c["hl"]]) >= 2 * p.min_child * (1 - 1e-9) - 1e-9
                    if p.depth <= level + 1:
                        heavy[:] = False
                    to = np.full(2 * len(places), -1)
                    kids = np.sort(kids[heavy])
                    to[2 * np.searchsorted(places, kids // 2) + kids % 2] = np.arange(len(kids))
                    if len(kids):
                        after[m] = kids
                    used[m], rest[m] = (_moved(flat, n, x, column, edge, to, value, margin[m]) for x in (used[m], rest[m]))
                level, todo = level + 1, after
            for i, p in enumerate(params):
                if p.trees == number + 1:
                    told[i] = margin[which[i]].copy() if models[which[i]].trees > p.trees else margin[which[i]]
            if gang.me == 0:
                yield _batch(out, [[number], None, None, None, None, [zlib.compress(pickle.dumps(
                    (tree.feature, tree.bin, tree.value, tree.cover, tree.gain)), 1)]], 1)
        start = 0
        for b in own:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                new = np.stack([x[start:start + part.num_rows] for x in told], axis=1)
                start += part.num_rows
                if more:
                    old = np.frombuffer(b"".join(part.column("margin").to_pylist()), float)
                    new = np.concatenate([old.reshape(len(new), -1), new], axis=1)
                if last is not None:
                    new = new[:, last]
                values = pa.array([r.tobytes() for r in new], pa.binary())
                yield _batch(out, [*(part.column(c) for c in ("key", "y", "fold", "bins")), values, None], part.num_rows)
        gang.end()

    ddl = "key long, y int, fold int, bins binary, margin binary, tree binary"
    path = f"{folder}/quarry-boost-{uuid.uuid4().hex}"
    dealt = rows.withColumn("_t", F.pmod(F.xxhash64("key"), F.lit(tasks)).cast("int")).repartitionById(tasks, F.col("_t"))
    dealt.drop("_t").mapInArrow(run, ddl, barrier=True).write.parquet(path)  # the stage runs once
    both = spark.read.schema(ddl).parquet(path)
    grown = [Tree(*pickle.loads(zlib.decompress(r["tree"])))
             for r in both.where("tree IS NOT NULL").select("key", "tree").orderBy("key").collect()]
    return both.where("tree IS NULL").drop("tree"), grown


def _moved(flat: np.ndarray, n: int, rows: tuple, column: np.ndarray, edge: np.ndarray, to: np.ndarray,
           value: np.ndarray, margin: np.ndarray) -> tuple:
    """Rows (place in the table, place among the open nodes, ...) one level down:
    to the open node ``to`` of (node, side), or out of the tree with its value."""
    r, s = rows[:2]
    if len(column) == 1:
        side = (flat[column[0]:column[0] + n].take(r) > edge[0]).astype(np.int64)
    else:
        side = column.take(s)
        side += r
        right = flat.take(side) > edge.take(s)
        side = 2 * s
        side += right
    if to.max() < 0:
        margin[r] += value.take(side)
        return tuple(x[:0] for x in rows)
    s = to.take(side)
    out = np.flatnonzero(s < 0)
    if not len(out):
        return (r, s, *rows[2:])
    margin[r.take(out)] += value.take(side.take(out))
    stay = np.flatnonzero(s >= 0)
    return tuple(x.take(stay) for x in (r, s, *rows[2:]))


def _batch(schema: pa.Schema, columns: list, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.nulls(n, f.type) if c is None else c.cast(f.type) if isinstance(c, pa.Array)
                                       else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
                                      schema=schema)


def _gang_level(gang: Gang, models: Sequence[Params], allowed: np.ndarray, todo: dict[int, np.ndarray],
                cells: np.ndarray, width: int, used: dict) -> np.ndarray:
    """The best splits of the open nodes ``todo`` (per model, places in the
    level), found by all tasks together from the rows ``used`` (row, place among
    the open nodes, G + iH).  A unit of the sums is one node: G of its allowed
    features and bins, then H."""
    cols = {m: np.flatnonzero(allowed[m]) for m in todo}
    sums = []
    for m, places in todo.items():
        r, s, gh = used[m]
        s = s * width if len(places) > 1 else None
        part = np.empty((len(places), 2, len(cols[m]), width))
        for j, f in enumerate(cols[m]):
            cell = cells[f].take(r)
            if s is not None:
                cell += s
            total = np.zeros(len(places) * width, complex)
            np.add.at(total, cell, gh)
            part[:, 0, j], part[:, 1, j] = (x.reshape(-1, width) for x in (total.real, total.imag))
        sums.append(part.ravel())
    owner = np.repeat(list(todo), [len(x) for x in todo.values()])
    place = np.concatenate(list(todo.values()))
    sizes = np.array([2 * len(cols[m]) * width for m in owner.tolist()])
    ends = np.concatenate([[0], np.cumsum(sizes)])
    a, b = gang.shares(sizes)
    total = gang.added(np.concatenate(sums), int(ends[a]), int(ends[b]))
    out = []
    for m in np.unique(owner[a:b]).tolist():
        mine = a + np.flatnonzero(owner[a:b] == m)
        x = total[ends[mine[0]] - ends[a]:ends[mine[-1] + 1] - ends[a]].reshape(len(mine), 2, len(cols[m]), width)
        p = models[m]
        out += [(m, int(place[mine[i]]), int(cols[m][f]) if f >= 0 else -1, *rest) for i, f, *rest in best_splits(
            x[:, 0], x[:, 1], np.ones(len(cols[m]), bool), p.l1, p.l2, p.gamma, p.min_child)]
    parts = gang.gathered(np.array(out, _SPLIT_TYPE).tobytes())
    return np.concatenate([np.frombuffer(x, _SPLIT_TYPE) for x in parts])


def _advance(state: DataFrame, trees: list[Tree], features: int, models: int) -> DataFrame:
    """The state with the values of further trees in its margins."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                bins, margin = _rows(batch, features, models)
                new = _margins(bins, margin, trees)
                yield batch.set_column(batch.schema.get_field_index("margin"), "margin",
                                       pa.array([r.tobytes() for r in new], pa.binary()))

    out = cut_lineage(state.mapInArrow(run, state.schema)).persist(StorageLevel.MEMORY_AND_DISK)
    out.count()
    state.unpersist()
    return out


def out_of_fold(state: DataFrame, params: Sequence[Params]) -> DataFrame:
    """(model, fold, key, y, probability): every row by the models that did not
    see it; models without a fold give all rows."""
    fold = np.array([-1 if p.fold is None else p.fold for p in params])
    schema = pa.schema([("model", pa.int32()), ("fold", pa.int32()), ("key", pa.int64()), ("y", pa.int32()),
                        ("probability", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                margin = np.frombuffer(b"".join(batch.column("margin").to_pylist()), float).reshape(len(batch), -1)
                mine = batch.column("fold").to_numpy()
                row, model = np.nonzero((fold[None] == mine[:, None]) | (fold[None] < 0))
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(model.astype(np.int32)), batch.column("fold").take(take), batch.column("key").take(take),
                     batch.column("y").take(take), pa.array(1 / (1 + np.exp(-margin[row, model])))], schema=schema)

    return state.mapInArrow(run, "model int, fold int, key long, y int, probability double")


def predict(forest: Forest, df: DataFrame, key: str, keep: Sequence[str] = (), model: int = 0,
            attribution: bool = False) -> DataFrame:
    """Key, ``keep``, margin and probability of all rows of ``df``,
    and with ``attribution`` base and one column per feature (contrib_<name>):
    along a row's way down each tree, the change of the node's value goes to
    the feature split on, so base + contributions = margin."""
    trees = [Tree(*(getattr(t, f)[model:model + 1] for f in ("feature", "bin", "value", "cover", "gain")))
             for t in forest.trees[:forest.params[model].trees]]
    columns = forest.columns
    rows = forest.binned(df, [key, *keep])
    kept = [f for f in rows.schema if f.name != "bins"]
    extra = ["margin", "probability", *(["base", *(f"contrib_{c}" for c in columns)] if attribution else [])]
    base = sum(float(t.value[0, 0]) for t in trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                n = batch.num_rows
                bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(n, len(columns))
                margin, share = np.zeros(n), np.zeros((n, len(columns)))
                for t in trees:
                    node = np.zeros((n, 1), np.int64)
                    for _ in range(t.depth):
                        after = t.walk(bins, node, 1)
                        if attribution:
                            a, b = node[:, 0], after[:, 0]
                            np.add.at(share, (np.arange(n), t.feature[0, a]), t.value[0, b] - t.value[0, a])
                        node = after
                    margin += t.value[0, node[:, 0]]
                out = [margin, 1 / (1 + np.exp(-margin))]
                if attribution:
                    out += [np.full(n, base), *share.T]
                yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *map(pa.array, out)],
                                                 [*(f.name for f in kept), *extra])

    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), *(f"`{c}` double" for c in extra)])
    return rows.mapInArrow(run, ddl)


def grid(base: Params, **values: Sequence) -> list[Params]:
    """All combinations of parameter values."""
    out = [base]
    for name, options in values.items():
        out = [replace(p, **{name: v}) for p in out for v in options]
    return out
