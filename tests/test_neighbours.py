"""Neighbour joins, density clusters, components and resampling against plain
loops, with cells and blocks small enough that every path is taken."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import components, neighbours, resample

VEC = "id long, v array<double>"


def crowd(seed, n, dim=3, groups=4):
    """Groups of different density, equal rows, and rows far from all."""
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(0, 8, (groups, dim))
    v = centres[rnd.integers(0, groups, n)] + rnd.normal(0, 1, (n, dim)) * rnd.choice([0.3, 1, 2], (n, 1))
    v[n // 2:n // 2 + n // 6] = v[0]
    v[-3:] *= 50
    ids = rnd.permutation(n) * 7 - 20
    return [(int(i), [float(x) for x in r]) for i, r in zip(ids, v)]


def distances(rows):
    v = np.array([r[1] for r in rows])
    return np.round(np.sqrt(((v[:, None] - v[None]) ** 2).sum(axis=2)), neighbours.DIGITS)


def plain_nearest(rows, k):
    d, ids = distances(rows), [r[0] for r in rows]
    out = []
    for a in range(len(rows)):
        near = sorted((d[a, b], ids[b]) for b in range(len(rows)) if b != a)[:k]
        out += [(ids[a], r, b, x) for r, (x, b) in enumerate(near, 1)]
    return sorted(out)


def plain_density(rows, eps, least):
    d, ids = distances(rows) <= eps, [r[0] for r in rows]
    n = d.sum(axis=1)
    core = n >= least
    label = {}
    for a in sorted(range(len(rows)), key=ids.__getitem__):
        if core[a] and ids[a] not in label:
            label[ids[a]], todo = ids[a], [a]
            while todo:
                for b in np.flatnonzero(d[todo.pop()] & core):
                    if ids[b] not in label:
                        label[ids[b]] = ids[a]
                        todo.append(b)
    rim = {ids[a]: min((label[ids[b]] for b in np.flatnonzero(d[a] & core)), default=None)
           for a in range(len(rows)) if not core[a]}
    return sorted((ids[a], int(n[a]), bool(core[a]), (label | rim)[ids[a]]) for a in range(len(rows)))


@pytest.mark.parametrize("n, k, pivots, block", [(150, 4, 7, 20), (150, 1, 1, 40), (90, 5, 30, 1000), (6, 9, 3, 2),
                                                 (1, 2, 4, 5)])
def test_nearest_equals_all_pairs(spark, n, k, pivots, block):
    rows = crowd(n + k, n) if n > 10 else [(i, [float(i * i), 1.0]) for i in range(n)]
    got = neighbours.nearest(spark.createDataFrame(rows, VEC).repartition(3), "id", "v", k, pivots, block).collect()
    assert sorted(tuple(r) for r in got) == plain_nearest(rows, k)


def test_cells_spare_comparisons(spark):
    """Well separated groups: no query leaves its own group's cells."""
    rows = [(i, [1000.0 * (i % 5) + (i % 7) / 10, (i // 7) / 100]) for i in range(300)]
    placed, cells = neighbours.in_cells(neighbours.whole_vectors(spark.createDataFrame(rows, VEC), "id", "v"), 3, 12)
    routed = neighbours._routed(placed, cells, None, 3, own_too=False)
    far = np.abs(cells.pivots[:, None, 0] - cells.pivots[None, :, 0]) > 500
    homes = {r["key"]: r["cell"] for r in placed.collect()}
    assert not any(far[homes[r["key"]], r["cell"]] for r in routed.collect())


def test_odd_rows_are_left_out(spark):
    rows = [(1, [0.0, 0.0]), (2, None), (None, [1.0, 1.0]), (3, [float("nan"), 0.0]), (4, [None, 1.0]), (5, [3.0, 4.0]),
            (6, [float("inf"), 0.0])]
    df = spark.createDataFrame(rows, VEC).withColumn("key", F.lit("x")).withColumn("cell", F.lit("y"))
    assert sorted(tuple(r) for r in neighbours.nearest(df, "id", "v", 2).collect()) == [(1, 1, 5, 5.0), (5, 1, 1, 5.0)]
    assert sorted(tuple(r) for r in neighbours.k_distances(df, "id", "v", 2).collect()) == [(1, 5.0), (5, 5.0)]
    assert sorted(tuple(r) for r in neighbours.density_clusters(df, "id", "v", 5.0, 2).collect()) == [
        (1, 2, True, 1), (5, 2, True, 1)]
    none = spark.createDataFrame([], VEC)
    assert neighbours.nearest(none, "id", "v", 2).columns == ["id", "rank", "neighbour", "distance"]
    assert neighbours.nearest(none, "id", "v", 2).count() == 0
    assert neighbours.density_clusters(none, "id", "v", 1.0).count() == 0


@pytest.mark.parametrize("n, eps, least, pivots, block", [(160, 1.0, 5, 9, 25), (160, 0.4, 4, 3, 30), (80, 100.0, 3, 5, 15),
                                                          (40, 0.0, 2, 4, 10)])
def test_density_equals_plain_search(spark, n, eps, least, pivots, block):
    rows = crowd(n * 3 + least, n)
    got = neighbours.density_clusters(spark.createDataFrame(rows, VEC).repartition(3), "id", "v", eps, least, pivots,
                                      block)
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[0]) == plain_density(rows, eps, least)


def test_rim_row_takes_the_smallest_cluster(spark):
    """Two clusters reach one row: the one of the smaller core key has it."""
    left, right = [(10 + i, [0.0 - i * 0.1]) for i in range(4)], [(1 + i, [1.8 + i * 0.1]) for i in range(4)]
    rows = [*left, *right, (99, [0.9])]
    got = {r["id"]: r["cluster"] for r in neighbours.density_clusters(
        spark.createDataFrame(rows, VEC), "id", "v", 0.9, 4, 3, 2).collect()}
    assert got[99] == 1 and got[10] == 10 and got[1] == 1


def test_no_plan_makes_all_pairs(spark, capsys):
    df = spark.createDataFrame(crowd(1, 60), VEC)
    neighbours.nearest(df, "id", "v", 3, 5, 20).explain()
    neighbours.density_clusters(df, "id", "v", 1.0, 3, 5, 20).explain()
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("kind", ["path", "star", "random", "loops"])
def test_components(spark, kind):
    rnd = random.Random(5)
    edges = {"path": [(i, i + 1) for i in range(200)], "star": [(500, i) for i in range(100)],
             "random": [(rnd.randrange(150), rnd.randrange(150)) for _ in range(90)], "loops": [(3, 3), (4, 4), (4, 5)],
             }[kind]
    got = {r["node"]: r["root"] for r in components.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == root
    names = sorted(root)
    at = {x: i for i, x in enumerate(names)}
    node, top = components.forest(np.array([at[a] for a, _ in edges]), np.array([at[b] for _, b in edges]), len(names))
    assert {names[i]: names[j] for i, j in zip(node, top)} == {x: r for x, r in root.items() if x != r}


def _classes(seed=3):
    rnd = random.Random(seed)
    return [(i, int(i % 5 == 0), rnd.gauss(0, 1), rnd.gauss(5, 2)) for i in range(103)]


def test_generated_rows_lie_between_neighbours(spark):
    rows = _classes()
    df = spark.createDataFrame(rows, "id long, y int, a double, b double")
    made = resample.smote_rows(df, "y", "id", ["a", "b"], k=3).collect()
    small = {r[0]: np.array(r[2:]) for r in rows if r[1] == 1}
    assert len(made) == len(rows) - 2 * len(small) and {r["y"] for r in made} == {1}
    turns = [sum(r["id"] == i for r in made) for i in small]
    assert max(turns) - min(turns) <= 1
    near = {}
    for i, _, j, _ in plain_nearest([(i, list(v)) for i, v in small.items()], 3):
        near.setdefault(i, set()).add(j)
    for r in made:
        assert r["neighbour"] in near[r["id"]]
        way, step = small[r["neighbour"]] - small[r["id"]], np.array([r["a"], r["b"]]) - small[r["id"]]
        part = step @ way / (way @ way)
        assert 0 <= part < 1 and np.allclose(step, part * way)


def test_generated_rows_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame(_classes(), "id long, y int, a double, b double")
    one, many = (sorted(map(tuple, resample.smote_rows(d, "y", "id", ["a", "b"]).collect()))
                 for d in (df.coalesce(1), df.repartition(7)))
    assert one == many


def test_combined_resample_sizes(spark):
    df = spark.createDataFrame(_classes(), "id long, y int, a double, b double").withColumn("rank", F.lit("x"))
    sizes = {r["y"]: r["count"] for r in resample.combined_resample(df, "y", "id", ["a", "b"], 0.5, 0.8).groupBy(
        "y").count().collect()}
    assert sizes == {1: 41, 0: 51}
    alone = spark.createDataFrame([(1, 0, 1.0), (2, 0, 2.0), (3, 1, 1.0)], "id long, y int, a double")
    with pytest.raises(ValueError):
        resample.smote_rows(alone, "y", "id", ["a"])
    assert resample.oversample(alone.where("y = 0"), "y", "id", ["a"]).count() == 2
    assert resample.smote_rows(alone.where("y = 9"), "y", "id", ["a"]).count() == 0


def test_vectors_are_dealt_once(spark, monkeypatch):
    """Without structure every query meets every cell; no copy of it goes to each."""
    def routed(*_, **__):
        raise AssertionError("a row per query and cell")

    monkeypatch.setattr(neighbours, "_routed", routed)
    v = np.random.default_rng(4).normal(0, 1, (60, 12))
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)]
    df = spark.createDataFrame(rows, VEC)
    got = neighbours.nearest(df, "id", "v", 3, 6, 10).collect()
    assert sorted(tuple(r) for r in got) == plain_nearest(rows, 3)
    got = neighbours.density_clusters(df, "id", "v", 4.0, 3, 6, 10).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[0]) == plain_density(rows, 4.0, 3)
    placed, _ = neighbours.in_cells(neighbours.whole_vectors(df, "id", "v"), 0, 6)
    blocks = [b.read()["key"].to_pylist() for b in neighbours._written(placed.select("key", "v", "cell"), 10)]
    assert sorted(x for b in blocks for x in b) == list(range(60))


def test_nearest_with_names_as_keys(spark):
    rows = [(f"n{i % 7}-{i}", [float(i % 5), float(i % 3)]) for i in range(30)]
    got = neighbours.nearest(spark.createDataFrame(rows, "id string, v array<double>"), "id", "v", 4, 3, 6).collect()
    assert sorted(tuple(r) for r in got) == plain_nearest(rows, 4)


@pytest.mark.parametrize("offset, spread, eps", [(0, 1, 4.0), (1e5, 1e-3, 0.004), (0, 1e-9, 2e-9), (0, 1e18, 4e18),
                                                 (3, 1, 0.0), (0, 1, 100.0)])
def test_single_precision_loses_no_pair(offset, spread, eps):
    """What a product of single precision leaves open is settled exactly, also
    in a crowd, far from the origin and at any scale."""
    rng = np.random.default_rng(7)
    q, m = (offset + spread * rng.normal(0, 1, (n, 12)) for n in (450, 300))
    m[:40] = q[0]
    m[40:60] += 1000 * spread
    d = np.round(np.sqrt(((q[:, None] - m[None]) ** 2).sum(axis=2)), neighbours.DIGITS)
    queries, ask = neighbours._Queries(q), np.arange(0, len(q), 3)
    got = [np.stack(x, axis=1) for x in neighbours._within(queries, ask, m, eps)]
    assert np.concatenate(got).tolist() == [x for x in np.argwhere(d <= eps).tolist() if x[0] % 3 == 0]
    got = [np.stack(x, axis=1) for x in neighbours._within(queries, np.arange(len(q)), m, eps)]
    assert np.concatenate(got).tolist() == np.argwhere(d <= eps).tolist()
    limit = rng.choice([eps, np.inf], len(q))
    i, j, near = (np.concatenate(x) for x in zip(*neighbours._pairs(queries, np.arange(len(q)), limit, m, 5),
                                                           strict=True))
    found = np.full(d.shape, np.inf)
    found[i, j] = near
    assert (found[i, j] == d[i, j]).all()
    want = np.sort(np.where(d <= limit[:, None], d, np.inf), axis=1)[:, :5]
    assert (np.sort(found, axis=1)[:, :5] == want).all()


def test_two_blocks_meet_once():
    for n in (1, 2, 7, 10):
        meets = np.array([[neighbours._meets(a, b) for b in range(n)] for a in range(n)])
        assert meets.diagonal().all() and (meets ^ meets.T)[~np.eye(n, dtype=bool)].all()
        assert meets.sum(axis=1).max() <= 1 + -(-n // 2)
