"""Exact quantiles and modes per key without gathering a key's values.

``row_quantiles`` finds ranks between the bounds of a sketch and leaves the rows
where they are.  ``exact_quantiles`` works on counted values, which are at hand
where modes are wanted too.

Values are counted per (key, value) first, so a hot key or a frequent value is
combined before the shuffle and the counts spread over all tasks.  A bounded
sketch per key (percentile_approx over the distinct values) gives bucket
bounds; bucket totals (one row per key and bucket) tell which bucket holds
each wanted rank, and only those buckets are ordered.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import join_small

BUCKETS = 128
# Of the sketch that encloses a rank: its error is one in so many rows.
ACCURACY = 10_000


def counted(df: DataFrame, keys: Sequence[str], x: str = "x", out: str = "n") -> DataFrame:
    """(keys..., x, n): how often each non-null value occurs, cut from its lineage
    since every statistic below reads it."""
    return cut_lineage(df.where(F.col(x).isNotNull()).groupBy(*keys, x).agg(F.count(F.lit(1)).alias(out)))


def modes(counts: DataFrame, keys: Sequence[str], x: str = "x") -> DataFrame:
    """(keys..., mode): the most frequent value, the smallest on ties."""
    return counts.groupBy(*keys).agg(F.max_by(x, F.struct(F.col("n"), -F.col(x))).alias("mode"))


def exact_quantiles(counts: DataFrame, keys: Sequence[str], qs: Sequence[float], x: str = "x",
                    buckets: int = BUCKETS, position: Callable[[Column], Column] | None = None) -> DataFrame:
    """(keys..., total, q array): linearly interpolated quantiles (numpy's and
    DuckDB's ``quantile_cont``) of counted values, in the order of ``qs``;
    ``position`` gives another place than (n - 1) q, as a function of n."""
    keys = list(keys)
    if not keys:
        raise ValueError("a key is needed here; row_quantiles takes whole columns")
    grid = [i / buckets for i in range(1, buckets)]
    bounds = cut_lineage(counts.groupBy(*keys).agg(
        F.percentile_approx(x, grid, 10 * buckets).alias("_bounds"), F.sum("n").alias("total")))
    bucket = F.size(F.filter("_bounds", lambda b: b < F.col(x)))
    placed = join_small(counts, bounds.select(*keys, "_bounds"), keys).withColumn("_b", bucket).drop("_bounds")
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(*keys, "_b").agg(F.sum("n").alias("_bn"))
    totals = totals.withColumn("_start", F.coalesce(F.sum("_bn").over(before), F.lit(0)))

    def rank(i: int, q: float, upper: int) -> Column:
        at = position(F.col("total")) if position else (F.col("total") - 1) * F.lit(float(q))
        low = F.floor(at)
        return F.struct(F.lit(i).alias("i"), F.lit(upper).alias("upper"), (at - low).alias("part"),
                        F.least(low + upper, F.col("total") - 1).alias("rank"))

    ranks = F.array(*[rank(i, q, u) for i, q in enumerate(qs) for u in (0, 1)])
    want = bounds.select(*keys, "total", F.explode(ranks).alias("_r")).select(*keys, "total", "_r.*")
    want = want.join(totals, keys).where((F.col("rank") >= F.col("_start"))
                                         & (F.col("rank") < F.col("_start") + F.col("_bn")))
    want = cut_lineage(want.select(*keys, "_b", "_start", "total", "i", "upper", "part", "rank"))
    hit = join_small(placed, want.select(*keys, "_b", "_start").distinct(), [*keys, "_b"])
    upto = Window.partitionBy(*keys, "_b").orderBy(x).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hit = hit.withColumn("_end", F.col("_start") + F.sum("n").over(upto)).drop("_start")
    found = hit.join(want, [*keys, "_b"]).where((F.col("rank") < F.col("_end"))
                                                & (F.col("rank") >= F.col("_end") - F.col("n")))
    one = found.groupBy(*keys, "total", "i", "part").agg(
        F.max(F.when(F.col("upper") == 0, F.col(x))).alias("lo"),
        F.max(F.when(F.col("upper") == 1, F.col(x))).alias("hi"))
    value = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("part")
    out = one.groupBy(*keys, "total").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", value.alias("v")))),
                                                      lambda s: s["v"]).alias("q"))
    return out


def row_quantiles(df: DataFrame, keys: Sequence[str], qs: Sequence[float], x: str = "x",
                  position: Callable[[Column], Column] | None = None) -> DataFrame:
    """(keys..., total, mn, mx, q array) as ``exact_quantiles``, from the rows
    themselves, which are neither shuffled nor kept: a mergeable sketch gives
    for each wanted rank two values that surely enclose it, a second look
    counts what lies below, and only values in between are counted and ordered
    (about 8 in ACCURACY rows of a key; all of a key of fewer rows)."""
    keys = list(keys)
    src = df.where(F.col(x).isNotNull()).select(*keys, F.col(x).alias("_x"))
    v, many = F.col("_x"), F.col("total") >= ACCURACY
    gap = 4 / ACCURACY
    at = [p for q in qs for p in (max(q - gap, 0.0), min(q + gap, 1.0))]
    bounds = src.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"), F.min("_x").alias("mn"), F.max("_x").alias("mx"),
                                    F.percentile_approx("_x", at, ACCURACY).alias("_s"))
    edges = [(F.when(many & F.lit(at[2 * i] > 0), F.col("_s")[2 * i]).otherwise(F.col("mn")),
              F.when(many & F.lit(at[2 * i + 1] < 1), F.col("_s")[2 * i + 1]).otherwise(F.col("mx")))
             for i in range(len(qs))]
    rank = [position(F.col("total")) if position else (F.col("total") - 1) * F.lit(float(q)) for q in qs]
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), lo.alias("lo"), hi.alias("hi"), r.cast("double").alias("at"))
                       for i, ((lo, hi), r) in enumerate(zip(edges, rank, strict=True))])
    bounds = bounds.where("total > 0").select(*keys, "total", "mn", "mx", wanted.alias("_w"))
    if keys:
        bounds = cut_lineage(bounds)
        both = join_small(src, bounds.select(*keys, "_w"), keys)
    else:  # one bounded row: inlined, so that no join without a key is planned
        row = bounds.collect()
        bounds = df.sparkSession.createDataFrame(row, bounds.schema)
        known = F.array(*[F.struct(*[F.lit(w[c]).alias(c) for c in ("i", "lo", "hi", "at")]) for w in row[0]["_w"]]) \
            if row else F.lit(None).cast(bounds.schema["_w"].dataType)
        both = src.withColumn("_w", known)
    below = both.groupBy(*keys).agg(F.array(*[F.count_if(v < F.col("_w")[i]["lo"]) for i in range(len(qs))]).alias("_b"))
    near = F.filter("_w", lambda w: (w["lo"] <= v) & (v <= w["hi"]))
    inside = both.select(*keys, v, F.explode(F.transform(near, lambda w: w["i"])).alias("i")).groupBy(
        *keys, "i", "_x").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy(*keys, "i").orderBy("_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = inside.withColumn("_end", F.sum("n").over(upto))
    if keys:
        want = bounds.join(below, keys)
    else:
        first = below.first()
        want = bounds.withColumn("_b", F.array(*map(F.lit, first["_b"])) if first and row else F.array())
    want = want.select(*keys, "total", "mn", "mx", "_b", F.explode("_w").alias("_w"))
    low = F.floor("_w.at")
    want = want.select(*keys, "total", "mn", "mx", "_w.i", F.get("_b", F.col("_w.i")).alias("_b"), low.alias("r0"),
                       F.least(low + 1, F.col("total") - 1).alias("r1"), (F.col("_w.at") - low).alias("part"))
    found = inside.join(want, [*keys, "i"])
    end, start = F.col("_b") + F.col("_end"), F.col("_b") + F.col("_end") - F.col("n")
    hit = [F.max(F.when((F.col(r) >= start) & (F.col(r) < end), v)).alias(name) for r, name in (("r0", "lo"), ("r1", "hi"))]
    one = found.groupBy(*keys, "total", "mn", "mx", "i", "part").agg(*hit)
    value = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("part")
    value = F.coalesce(value, F.raise_error(F.lit("a rank lies outside its sketch's bounds")).cast("double"))
    return one.groupBy(*keys, "total", "mn", "mx").agg(F.transform(F.array_sort(F.collect_list(F.struct(
        "i", value.alias("v")))), lambda s: s["v"]).alias("q"))


def quantile_row(df: DataFrame, x: str, qs: Sequence[float]) -> list[float | None]:
    """Whole-column quantiles as numbers (a bounded row); Nones without a value."""
    row = row_quantiles(df.select(F.col(x).cast("double").alias("x")), [], qs).first()
    return list(row["q"]) if row else [None] * len(qs)


def order_statistic(df: DataFrame, x: str, share: float) -> DataFrame:
    """(total, value): the element at position floor(share * n) of the
    ascending order (the last one at most), without interpolation."""
    out = row_quantiles(df.select(F.col(x).cast("double").alias("x")), [], [share], position=lambda n: F.least(
        F.floor(n * F.lit(float(share))), n - 1))
    return out.select("total", F.col("q")[0].alias("value"))
