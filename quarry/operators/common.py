"""Shared building blocks: unpivot, salted top-k, scalar statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Salt buckets for top-k inside possibly hot groups: the first ranking pass runs
# per (group, salt) so that one group never lands in one sort task.
TOPK_SALT = 64
# Most rows of a statistics table that is broadcast.
BROADCAST_ROWS = 20_000


def long_form(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str = "feature",
              value: str = "x", cast: str = "double") -> DataFrame:
    """Unpivot ``cols`` (cast to one type) into (ids..., name, value) rows.

    Per-column loops of the reference become one unpivot + one grouped job."""
    return df.select(*ids, *[F.col(c).cast(cast).alias(c) for c in cols]).unpivot(list(ids), list(cols), name, value)


def top_k(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int,
          salt_on: Sequence[str] | None = None, rank_col: str = "rank") -> DataFrame:
    """Top ``k`` rows per group by ``order`` (a total order), with rank 1..k.

    Two passes: rank within (group, salt) and keep k, then rank the <= k*salt
    survivors per group.  A group holding a third of all rows is thereby
    sorted by many tasks, and the second pass sees a bounded number of rows."""
    salt_cols = list(salt_on) if salt_on else [c for c in df.columns if c not in group]
    salted = df.withColumn("_salt", F.abs(F.xxhash64(*salt_cols)) % TOPK_SALT)
    w1 = Window.partitionBy(*group, "_salt").orderBy(*order)
    pre = salted.withColumn("_r", F.row_number().over(w1)).where(F.col("_r") <= k).drop("_r", "_salt")
    w2 = Window.partitionBy(*group).orderBy(*order) if group else Window.orderBy(*order)
    return pre.withColumn(rank_col, F.row_number().over(w2)).where(F.col(rank_col) <= k)


def join_small(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner",
               rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join a table of statistics (a row per key) to ``big``.  Broadcast where a
    count shows at most ``rows`` rows, so that the rows of ``big`` stay where
    they are however few keys there are; else a join by shuffle, which AQE
    splits where it is skewed."""
    return big.join(F.broadcast(small) if small.count() <= rows else small, list(on), how)


def scalar(df: DataFrame, expr: Column) -> Column:
    """A whole-table statistic as a scalar-subquery column (no cross join, no
    driver round trip): ``df.select(expr).scalar()``."""
    return df.select(expr).scalar()


def stats_row(df: DataFrame, **aggs: Column) -> dict:
    """Several whole-table aggregates computed in ONE job and returned as
    literal columns.  The row is bounded (a few numbers per column); inlining
    them keeps the main plan a single scan + projection (a scalar subquery
    referenced k times would be planned, and scanned, k times)."""
    row = df.agg(*[a.alias(k) for k, a in aggs.items()]).first()
    return {k: F.lit(row[k]) for k in aggs}


def in_buckets(df: DataFrame, col: str, bounds: Sequence[float], out: str) -> DataFrame:
    """``out``: which stretch between sorted ``bounds`` a value lies in, found by
    binary search; equal values share one, null and NaN are in the first."""
    from pyspark.ml.feature import Bucketizer
    bounds = [float(b) for b in bounds if abs(b) != float("inf")]
    if not bounds:
        return df.withColumn(out, F.lit(0))
    known = df.withColumn(col, F.when(~F.isnan(col), F.col(col)))
    placed = Bucketizer(splits=[-float("inf"), *bounds, float("inf")], inputCol=col, outputCol=out,
                        handleInvalid="keep").transform(known)
    return placed.withColumn(out, F.when(F.col(col).isNull(), 0).otherwise(F.col(out).cast("int")))


def running_totals(df: DataFrame, order_col: str, cols: Sequence[str], tiebreak: Sequence[str] = (),
                   buckets: int | None = None, prefix: str = "cum_", descending: bool = False,
                   by: Sequence[str] = ()) -> DataFrame:
    """Inclusive running sums of ``cols`` ordered by ``order_col`` (then
    ``tiebreak``), for each value of ``by`` if given, without a window over
    a whole table or group.

    Bucket rows by approximate quantile bounds of the order column (at most
    ``buckets`` literals, a deterministic function of the value), total each
    bucket (one row per bucket), turn the totals into offsets with a window
    over that tiny table, and finish with a window local to each bucket.
    Equal order values share a bucket, so aggregate heavy ties first."""
    sp = df.sparkSession
    nb = buckets or int(sp.conf.get("spark.sql.shuffle.partitions"))
    key = -F.col(order_col) if descending else F.col(order_col)
    src = df.withColumn("_key", key.cast("double"))
    if nb > 1:
        qs = [i / nb for i in range(1, nb)]
        bounds = src.select(F.percentile_approx("_key", qs, 10000)).first()[0] or []
        bounds = sorted(set(b for b in bounds if b is not None))
    else:
        bounds = []
    src = in_buckets(src, "_key", bounds or [0.0], "_b")  # a bucket that is a constant would make a join without a key
    keys = [*by, "_b"]
    tot = src.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in cols])
    before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(*keys, *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_off_{c}") for c in cols])
    w = Window.partitionBy(*keys).orderBy("_key", *tiebreak).rowsBetween(Window.unboundedPreceding, 0)
    out = src.join(off, keys)
    for c in cols:
        out = out.withColumn(prefix + c, F.col(f"_off_{c}") + F.sum(c).over(w))
    return out.drop("_b", "_key", *[f"_off_{c}" for c in cols])
