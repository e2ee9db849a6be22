"""Exact nearest-neighbour and range joins of vectors.

Every row lies in the cell of its nearest pivot (pivots are a bounded number
of rows).  A query is sent to another cell only where the triangle inequality
and the plane between the two pivots allow a member near enough: for the k
nearest, within the k-th distance already found.  Cells of many rows are split
by a hash into blocks.  A block is a file below the shared checkpoint folder,
written once: a task takes one block of queries, reads the blocks that it has to
meet one after the other, and keeps only what its own rows need, so vectors cross
a shuffle once on their way to their block and never per cell that a query is
sent to.  Blocks find candidates by a matrix product in single precision, with
room for its error, and settle them by exact differences; where both rows of a
pair count alike, two blocks meet in one task only.

Distances are Euclidean, rounded to ``DIGITS`` decimals before they are
compared, so that equal distances are equal in every block.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir, cut_lineage
from .common import top_k
from .components import connected, forest
from .gang import _file_system

PIVOTS = 1024   # at most; a cell holds about CELL rows where that allows it
CELL = 2000
BLOCK = 4000    # about as many members meet as many queries at a time
CHUNK = 200     # queries of a block compared at a time
DIGITS = 9
SLACK = 1e-7    # of bounds, against rounding


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0))
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def whole_vectors(df: DataFrame, key: str, vec: str) -> DataFrame:
    """(key, v): rows with a key and a vector without a null or non-finite part."""
    sound = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(F.col(key).isNotNull() & F.col(vec).isNotNull() & sound).select(
        F.col(key).alias("key"), F.col(vec).cast("array<double>").alias("v"))


@dataclass
class Cells:
    """Pivots with what is known of the rows nearest to each: their number, and
    the largest, the smallest and the first few distances to the pivot."""

    pivots: np.ndarray
    size: np.ndarray
    far: np.ndarray
    near: np.ndarray
    first: np.ndarray

    def __post_init__(self):
        self.between = self.distances(self.pivots)

    def distances(self, v: np.ndarray) -> np.ndarray:
        out = np.empty((len(v), len(self.pivots)))
        for i, p in enumerate(self.pivots):
            out[:, i] = np.sqrt(((v - p) ** 2).sum(axis=1))
        return out

    def lower(self, d: np.ndarray, own: np.ndarray) -> np.ndarray:
        """No member of a cell is nearer to the query than this."""
        low = np.maximum(d - self.far, self.near - d)
        between = self.between[own]
        mine = np.take_along_axis(d, own[:, None], 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = np.where(between > 0, (d ** 2 - mine ** 2) / (2 * between), 0.0)
        low = np.maximum(np.maximum(low, plane), 0.0)
        return np.where(self.size > 0, low, np.inf)

    def upper(self, d: np.ndarray, k: int) -> np.ndarray:
        """Within this distance a query has k others: from the first members of
        every cell, itself counted among them."""
        reach = (d[:, :, None] + self.first[None]).reshape(len(d), -1)
        if reach.shape[1] <= k:
            return np.full(len(d), np.inf)
        return np.partition(reach, k, axis=1)[:, k]


def _placed(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(key, v, cell, to_pivot) per row; equal distances take the first pivot."""
    key = vectors.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column("v"))
            if not len(v):
                continue
            best, at = np.full(len(v), np.inf), np.zeros(len(v), np.int32)
            for i, p in enumerate(pivots):
                d = np.sqrt(((v - p) ** 2).sum(axis=1))
                nearer = d < best
                best[nearer], at[nearer] = d[nearer], i
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("v"), pa.array(at), pa.array(best)],
                                             ["key", "v", "cell", "to_pivot"])

    return vectors.mapInArrow(run, f"key {key}, v array<double>, cell int, to_pivot double")


def in_cells(vectors: DataFrame, k: int = 0, pivots: int | None = None) -> tuple[DataFrame, Cells | None]:
    """The rows in their cells, and what the driver knows of the cells: a row
    per pivot and at most ``k + 1`` distances of each, for PIVOTS pivots at
    most whatever the data size."""
    order, vectors = F.xxhash64("key"), cut_lineage(vectors)
    pivots = pivots or min(PIVOTS, 1 + vectors.count() // CELL)
    chosen = vectors.orderBy(order, "key").limit(pivots).collect()
    if not chosen:
        return _placed(vectors, np.zeros((0, 0))), None
    points = np.unique(np.array([r["v"] for r in chosen], float), axis=0)
    placed = cut_lineage(_placed(vectors, points))
    size, far, near = np.zeros(len(points), np.int64), np.zeros(len(points)), np.zeros(len(points))
    for r in placed.groupBy("cell").agg(F.count(F.lit(1)), F.max("to_pivot"), F.min("to_pivot")).collect():
        size[r[0]], far[r[0]], near[r[0]] = r[1], r[2], r[3]
    first = np.full((len(points), k + 1), np.inf)
    if k:
        ranked = top_k(placed.select("cell", "key", "to_pivot"), ["cell"], [F.col("to_pivot"), F.col("key")], k + 1,
                       ["key"])
        for r in ranked.select("cell", "rank", "to_pivot").collect():
            first[r[0], r[1] - 1] = r[2]
    return placed, Cells(points, size, far, near, first)


def _routed(queries: DataFrame, cells: Cells, bound: str | None, k: int, own_too: bool) -> DataFrame:
    """(key, v, bound, cell): a query for each cell that may hold a member
    within its bound (null: within what the cells' first members promise)."""
    key = queries.schema["key"].dataType.simpleString()
    cols = queries.select("key", "v", "cell", (F.col(bound) if bound else F.lit(None)).cast("double").alias("bound"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(at, CHUNK)
                v = _matrix(batch.column("v"))
                own = batch.column("cell").to_numpy()
                d = cells.distances(v)
                limit = batch.column("bound").to_numpy(zero_copy_only=False).astype(float)
                if k:
                    limit = np.fmin(limit, cells.upper(d, k))
                limit = np.where(np.isnan(limit), np.inf, limit)
                hit = cells.lower(d, own) * (1 - SLACK) - SLACK <= limit[:, None]
                if not own_too:
                    hit[np.arange(len(own)), own] = False
                row, cell = np.nonzero(hit)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(take), batch.column("v").take(take), pa.array(limit[row]),
                     pa.array(cell.astype(np.int32))], ["key", "v", "bound", "cell"])

    return cols.mapInArrow(run, f"key {key}, v array<double>, bound double, cell int")


@dataclass
class Block:
    """Rows of one cell in a file."""

    cell: int
    file: str

    def read(self) -> pa.Table:
        files, path = _file_system(self.file)
        with files.open_input_file(path) as f:
            return pa.ipc.open_stream(f).read_all().combine_chunks()


def _written(rows: DataFrame, block: int, prepare: Callable[[pa.Table], pa.Table] | None = None) -> list[Block]:
    """Write the rows (key, v, cell, ...) as files of about ``block`` rows of a
    cell; ``prepare`` may add to a block what it tells of its rows.  A row per
    block comes to the driver."""
    spark = rows.sparkSession
    folder = f"{checkpoint_dir(spark)}/quarry-cells-{uuid.uuid4().hex}"
    sizes = rows.groupBy("cell").count().collect()
    grid = spark.createDataFrame([(r[0], -(-r[1] // block)) for r in sizes], "cell int, parts int")  # a row per cell
    dealt = rows.join(F.broadcast(grid), "cell").withColumn(
        "part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")).drop("parts")

    def write(group: pa.Table) -> pa.Table:
        cell, group = group["cell"][0].as_py(), group.drop_columns(["cell", "part"])
        group = prepare(group) if prepare else group
        files, path = _file_system(folder)
        files.create_dir(path, recursive=True)
        name = f"{uuid.uuid4().hex}.arrow"  # of a task that runs again: another file
        with files.open_output_stream(f"{path}/{name}") as f, pa.ipc.new_stream(f, group.schema) as out:
            out.write_table(group)
        return pa.table({"cell": pa.array([cell], pa.int32()), "file": [f"{folder}/{name}"]})

    found = dealt.groupBy("cell", "part").applyInArrow(write, "cell int, file string").collect()
    return sorted((Block(*r) for r in found), key=lambda b: (b.cell, b.file))


def _each_block(spark: SparkSession, blocks: list[Block], task: Callable[[int], pa.Table], schema: str) -> DataFrame:
    """What ``task`` makes of every block of queries, a Spark task each."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in batch.column(0).to_pylist():
                yield from task(at).cast(arrow).to_batches()

    return spark.range(0, len(blocks), 1, max(1, len(blocks))).mapInArrow(run, schema)


def _lower(cells: Cells, v: np.ndarray, cell: int) -> np.ndarray:
    """(row, cell): no member of a cell is nearer than this, with room for rounding."""
    out = np.empty((len(v), len(cells.pivots)))
    for at in range(0, len(v), CHUNK):
        part = v[at:at + CHUNK]
        out[at:at + CHUNK] = cells.lower(cells.distances(part), np.full(len(part), cell)) * (1 - SLACK) - SLACK
    return out


class _Queries:
    """Vectors of a block that are compared with block after block."""

    def __init__(self, v: np.ndarray):
        self.v, self.centre = v, v.mean(axis=0)
        self.q = v - self.centre
        self.square = (self.q ** 2).sum(axis=1)
        self.left: dict[type, np.ndarray] = {}

    @staticmethod
    def share(kind: type, dim: int) -> float:
        """More than this share of both squared lengths a product is not off."""
        return 2 * (dim + 16) * float(np.finfo(kind).eps)

    def form(self, kind: type) -> np.ndarray:
        if kind not in self.left:
            share = self.share(kind, self.q.shape[1])
            self.left[kind] = np.concatenate([-2 * self.q, np.ones((len(self.q), 1)), (1 - share) * self.square[:, None]],
                                             axis=1).astype(kind)
        return self.left[kind]

    def screened(self, ask: np.ndarray, limit: np.ndarray, mv: np.ndarray, k: int | None = None) -> Iterator[tuple]:
        """(query, member, most) chunk by chunk for the queries ``ask``: pairs
        that may lie within their query's limit and, with ``k``, among the
        query's k nearest, with a bound of their squared distance.  The product
        is made of single precision numbers around the queries' mean; where that
        leaves much open (a crowd), doubles are taken."""
        m = mv - self.centre
        mm, top, dim = (m ** 2).sum(axis=1), (limit + SLACK) ** 2, m.shape[1]
        right: dict[type, np.ndarray] = {}

        def product(kind: type, rows: np.ndarray, cap: np.ndarray) -> tuple:
            share = self.share(kind, dim)
            if kind not in right:
                right[kind] = np.concatenate([m, (1 - share) * mm[:, None], np.ones((len(m), 1))], axis=1).astype(kind).T
            least = self.form(kind)[rows] @ right[kind]
            i, j = _below(least, cap)
            if k and k < len(m) and len(i) > 2 * k * len(least):
                kth = np.partition(least, k - 1, axis=1)[:, k - 1] + 2 * share * (self.square[rows] + mm.max())
                i, j = _below(least, np.minimum(cap, kth))
            return i, j, least[i, j].astype(float), share

        first = np.float32 if self.square.max() + mm.max() < 1e30 else np.float64
        for at in range(0, len(ask), CHUNK):
            rows, cap = ask[at:at + CHUNK], top[at:at + CHUNK]
            i, j, least, share = product(first, rows, cap)
            if first is np.float32 and len(i) > len(rows) * len(m) // 16:
                i, j, least, share = product(np.float64, rows, cap)
            i = rows[i]
            yield i, j, least + 2 * share * (self.square[i] + mm[j])


def _below(values: np.ndarray, cap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the values that are at most their row's cap, rounded up."""
    cap = np.nextafter(cap.astype(values.dtype), values.dtype.type(np.inf))
    some = np.flatnonzero(values.min(axis=1) <= cap)
    i, j = np.divmod(np.flatnonzero(values[some] <= cap[some, None]), values.shape[1])
    return some[i], j


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.round(np.sqrt(((a - b) ** 2).sum(axis=1)), DIGITS)


def _pairs(queries: _Queries, ask: np.ndarray, limit: np.ndarray, mv: np.ndarray,
           k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query, member, distance) of the queries ``ask``: pairs within each one's
    limit that may be among its k nearest, some 2^18 at a time at most."""
    kept, held = [], 0
    bound = np.empty(len(queries.v))
    bound[ask] = limit + 10.0 ** -DIGITS / 2
    for i, j, _ in queries.screened(ask, limit, mv, k):
        for s in range(0, len(i), 1 << 18):
            a, b = i[s:s + (1 << 18)], j[s:s + (1 << 18)]
            d = _apart(queries.v[a], mv[b])
            ok = d <= bound[a]
            kept.append((a[ok], b[ok], d[ok]))
            held += len(kept[-1][0])
            if held > 1 << 17:
                yield tuple(map(np.concatenate, zip(*kept, strict=True)))
                kept, held = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*kept, strict=True)))


def _names(keys: pa.ChunkedArray) -> np.ndarray:
    return keys.to_numpy() if pa.types.is_integer(keys.type) else np.array(keys.to_pylist(), object)


class _Best:
    """The k nearest of every query so far, smaller keys first among equals."""

    def __init__(self, n: int, k: int, like: np.ndarray):
        self.k, self.distance, self.name = k, np.full((n, k), np.inf), np.empty((n, k), like.dtype)

    def take(self, i: np.ndarray, name: np.ndarray, d: np.ndarray) -> None:
        hit = np.unique(i)
        at, col = np.nonzero(np.isfinite(self.distance[hit]))
        at = hit[at]
        i, d = np.concatenate([i, at]), np.concatenate([d, self.distance[at, col]])
        name = np.concatenate([name, self.name[at, col]])
        order = np.lexsort((np.unique(name, return_inverse=True)[1], d, i))
        i, d, name = i[order], d[order], name[order]
        place = np.arange(len(i)) - np.searchsorted(i, i, side="left")
        keep = place < self.k
        self.distance[i[keep], place[keep]], self.name[i[keep], place[keep]] = d[keep], name[keep]


def nearest(df: DataFrame, key: str, vec: str, k: int, pivots: int | None = None, block: int = BLOCK) -> DataFrame:
    """(key, rank, neighbour, distance): the ``k`` nearest other rows of each
    row, nearest first, smaller keys first among equals; fewer where there are
    not so many.  Exact.  Keys must be unique; rows without a key or with a
    null or non-finite part in the vector are left out on both sides; an empty
    table gives no rows; other columns are ignored."""
    vectors = whole_vectors(df, key, vec)
    kind = vectors.schema["key"].dataType.simpleString()
    placed, cells = in_cells(vectors, 0, pivots)
    if cells is None:
        empty = df.sparkSession.createDataFrame([], f"key {kind}, rank int, neighbour {kind}, distance double")
        return empty.withColumnRenamed("key", key)
    blocks = _written(placed.select("key", "v", "cell"), block)

    def search(at: int) -> pa.Table:
        own = blocks[at].read()
        names, q = _names(own["key"]), _matrix(own["v"])
        queries = _Queries(q)
        low, best = _lower(cells, q, blocks[at].cell), _Best(len(q), k, names)
        first = low.min(axis=0)
        first[blocks[at].cell] = -np.inf  # at home first, then the cells that may be nearest
        for b in sorted(blocks, key=lambda b: first[b.cell]):
            ask = np.flatnonzero(low[:, b.cell] <= best.distance[:, k - 1])
            if not len(ask):
                continue
            members = b.read()
            others = _names(members["key"])
            for i, j, d in _pairs(queries, ask, best.distance[ask, k - 1], _matrix(members["v"]), k + 1):
                other = names[i] != others[j]
                best.take(i[other], others[j[other]], d[other])
        i, col = np.nonzero(np.isfinite(best.distance))
        return pa.table([own["key"].take(pa.array(i)), pa.array(best.name[i, col], own["key"].type),
                         pa.array(best.distance[i, col])], ["key", "neighbour", "distance"])

    found = _each_block(df.sparkSession, blocks, search, f"key {kind}, neighbour {kind}, distance double")
    order = Window.partitionBy("key").orderBy("distance", "neighbour")
    out = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return out.select(F.col("key").alias(key), "rank", "neighbour", "distance")


def k_distances(df: DataFrame, key: str, vec: str, k: int = 5, **limits: int) -> DataFrame:
    """(key, k_distance): the distance to the k-th nearest row, the row
    itself counted as the first one; null where there are fewer than k rows."""
    near = nearest(df, key, vec, max(1, k - 1), **limits).where(F.col("rank") == max(1, k - 1))
    kth = F.col("distance") if k > 1 else F.lit(0.0)
    rows = whole_vectors(df, key, vec).select(F.col("key").alias(key))
    return rows.join(near.select(key, kth.alias("k_distance")), key, "left")


def _within(queries: _Queries, ask: np.ndarray, mv: np.ndarray, eps: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, member) of the pairs within eps of the queries ``ask``, chunk by
    chunk.  Only pairs that the product cannot tell apart from eps are settled
    by their differences."""
    sure = max(eps - SLACK, 0.0) ** 2
    for i, j, most in queries.screened(ask, np.full(len(ask), eps), mv):
        inside = most <= sure
        doubt = np.flatnonzero(~inside)
        for s in range(0, len(doubt), 1 << 15):
            x = doubt[s:s + (1 << 15)]
            inside[x] = _apart(queries.v[i[x]], mv[j[x]]) <= eps
        yield i[inside], j[inside]


def _meets(a: int, b: int) -> bool:
    """Whether block a's task compares it with block b, or b's does: about half
    of the others fall to each."""
    return a == b or (b > a) == ((a + b) % 2 == 0)


def _joined(qn: np.ndarray, qc: np.ndarray, queries: _Queries, ask: np.ndarray, mn: np.ndarray, mc: np.ndarray,
            mv: np.ndarray, eps: float) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of names (of a query among ``ask``, of a member) within
    eps: those of two core rows, and those of a row that is not core with a core
    one."""
    (a, p, i), (b, r, j) = (np.unique(x, return_index=True, return_inverse=True) for x in (qn, mn))
    codes = [np.zeros(0, np.int64)]
    for x, y in _within(queries, ask, mv, eps):
        some = qc[x] | mc[y]
        codes.append(np.unique(i[x[some]] * len(b) + j[y[some]]))
    x, y = np.divmod(np.unique(np.concatenate(codes)), len(b))
    names, qc, mc = np.stack([a[x], b[y]], axis=1), qc[p][x], mc[r][y]
    return names[qc & mc], np.concatenate([names[~qc], names[~mc][:, ::-1]])


def _spanned(pairs: np.ndarray) -> np.ndarray:
    """(name, smallest name) edges that connect what the pairs connect."""
    names, flat = np.unique(pairs, return_inverse=True)
    flat = flat.reshape(pairs.shape)
    node, root = forest(flat[:, 0], flat[:, 1], len(names))
    return np.stack([names[node], names[root]], axis=1)


def _renamed(names: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Every name as the one that its edge (sorted by name) leads to, or itself."""
    if not len(edges):
        return names
    at = np.minimum(np.searchsorted(edges[:, 0], names), len(edges) - 1)
    return np.where(edges[at, 0] == names, edges[at, 1], names)


def density_clusters(df: DataFrame, key: str, vec: str, eps: float, min_points: int = 5,
                     pivots: int | None = None, block: int = BLOCK) -> DataFrame:
    """C6, DBSCAN: (key, n_within, core, cluster).  n_within counts the rows
    within ``eps`` (distances rounded to DIGITS decimals), the row itself
    included; core rows have ``min_points`` of them; a cluster is the smallest
    key of its core rows, a row that is not core joins the smallest cluster
    that has a core row within eps, and noise has a null cluster.

    Blocks hand back counts, the edges of a spanning forest of their core rows'
    groups (a group: what is connected within a block) and the groups next to
    rows that are not core, never their pairs, so a crowd of rows that are all
    near each other costs as many rows as it has members.  Keys must be
    unique integers; rows without a key or a whole vector are left out; an empty
    table gives no rows; other columns are ignored."""
    vectors = whole_vectors(df, key, vec).withColumn("key", F.col("key").cast("long"))
    placed, cells = in_cells(vectors, 0, pivots)
    if cells is None:
        return placed.select(F.col("key").alias(key), F.lit(0).cast("long").alias("n_within"),
                             F.lit(False).alias("core"), F.lit(None).cast("long").alias("cluster"))
    eps = round(float(eps), DIGITS)

    spark = df.sparkSession
    blocks = _written(placed.select("key", "v", "cell"), block)

    def count(at: int) -> pa.Table:
        own = blocks[at].read()
        q = _matrix(own["v"])
        low, n, queries = _lower(cells, q, blocks[at].cell), np.zeros(len(q), np.int64), _Queries(q)
        keys, found = [own["key"].to_numpy()], [n]
        for other, b in enumerate(blocks):
            ask = np.flatnonzero(low[:, b.cell] <= eps) if _meets(at, other) else ()
            if not len(ask):
                continue
            members = b.read()
            there = np.zeros(len(members), np.int64)
            for i, j in _within(queries, ask, _matrix(members["v"]), eps):
                n += np.bincount(i, minlength=len(q))
                there += np.bincount(j, minlength=len(there))
            if other != at and there.any():  # a pair counts for both its rows
                keys.append(members["key"].to_numpy()[there > 0])
                found.append(there[there > 0])
        return pa.table([pa.array(np.concatenate(keys)), pa.array(np.concatenate(found))], ["key", "n"])

    counts = _each_block(spark, blocks, count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n_within"))
    marked = cut_lineage(placed.join(counts, "key").withColumn("core", F.col("n_within") >= min_points))

    def grouped(rows: pa.Table) -> pa.Table:
        core, root = rows["core"].to_numpy(), rows["key"].to_numpy().copy()
        names, v = root[core], _matrix(rows["v"])[core]
        if len(names):
            every = np.ones(len(names), bool)
            edges = _spanned(_joined(names, every, _Queries(v), np.arange(len(v)), names, every, v, eps)[0])
            root[core] = _renamed(names, edges)
        return rows.append_column("root", pa.array(root))

    groups = _written(marked.select("key", "v", "cell", "n_within", "core"), block, grouped)

    def link(at: int) -> pa.Table:
        own = groups[at].read()
        key, root, core = (own[c].to_numpy() for c in ("key", "root", "core"))
        q, name, alone = _matrix(own["v"]), np.where(core, root, key), own["n_within"].to_numpy() == 1
        low, queries = _lower(cells, q, groups[at].cell), _Queries(q)
        edges, beside = [np.stack([key, root], axis=1)[core & (key != root)]], [np.zeros((0, 2), np.int64)]
        for other, b in enumerate(groups):
            if not _meets(at, other):
                continue
            # at home, what connects the core rows is known
            ask = np.flatnonzero(~alone & (low[:, b.cell] <= eps) & ~(core & (other == at)))
            if not len(ask):
                continue
            members = b.read()
            there, use = members["core"].to_numpy(), members["n_within"].to_numpy() > 1
            mn = np.where(there, members["root"].to_numpy(), members["key"].to_numpy())
            if not use.any():
                continue
            both, rim = _joined(name, core, queries, ask, mn[use], there[use], _matrix(members["v"])[use], eps)
            edges.append(both)
            beside.append(rim)
            if sum(map(len, edges)) > 1 << 20:
                edges = [_spanned(np.concatenate(edges))]
        edges, beside = _spanned(np.concatenate(edges)), np.concatenate(beside)
        both = np.concatenate([edges, beside])
        return pa.table([pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(np.arange(len(both)) >= len(edges))],
                        ["a", "b", "rim"])

    links = cut_lineage(_each_block(spark, groups, link, "a long, b long, rim boolean"))
    roots = cut_lineage(connected(links.where("NOT rim")))
    core = marked.where("core").select("key").join(roots.withColumnRenamed("node", "key"), "key", "left").select(
        "key", F.coalesce("root", "key").alias("cluster"))
    joined = links.where("rim").select(F.col("a").alias("key"), F.col("b").alias("node")).distinct().join(
        roots, "node", "left").groupBy("key").agg(F.min(F.coalesce("root", "node")).alias("cluster"))
    label = core.unionByName(joined)
    return marked.select("key", "n_within", "core").join(label, "key", "left").select(
        F.col("key").alias(key), "n_within", "core", "cluster")
