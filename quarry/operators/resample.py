"""Generated minority rows and combined resampling (K6, K8).

Which neighbour a generated row leans towards, and how far, comes from the MD5
of its parent's key and its number, so the rows do not depend on partitions,
and any engine can make the same ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .evaluate import hash_rank, seeded_hash, undersample
from .neighbours import nearest


def _draw(key: Column, copy: Column, seed: int, of: str) -> Column:
    """32 bits for one generated row."""
    return seeded_hash(F.concat_ws(":", F.lit(of), key.cast("string"), copy.cast("string")), seed, 8)


def smote_rows(df: DataFrame, y: str, key: str, cols: Sequence[str], ratio: float = 1.0, k: int = 5,
               seed: int = 42) -> DataFrame:
    """K6: generated rows (key, copy, y, neighbour, cols...) that bring every
    class up to ``ratio`` times the largest class's number of rows: the parent's
    values moved by a random part of the way to one of its ``k`` nearest rows
    of the class.  Parents take turns: the first ones in a seeded order get one
    row more where the numbers do not divide.

    A class of one row has no neighbour and is refused, as is a null in a
    column used; classes are small integers, and there are few of them (one
    neighbour join each).  Keys must be unique.  An empty table gives no rows."""
    cols = list(cols)
    kind = df.schema[key].dataType.simpleString()
    sizes = {r[0]: r[1] for r in df.groupBy(y).count().collect()}
    largest = max(sizes.values(), default=0)
    out = None
    for label, n in sorted(sizes.items()):
        want = int(largest * ratio) - n
        if want <= 0:
            continue
        if n < 2:
            raise ValueError(f"class {label} has one row only")
        mine = cut_lineage(df.where(F.col(y) == label).select(
            F.col(key).alias("key"), F.array(*[F.col(c).cast("double") for c in cols]).alias("v")))
        near = nearest(mine, "key", "v", k)
        near = cut_lineage(near)
        if near.select("key").distinct().count() != n:
            raise ValueError("a key or a value of the columns is null, or a key repeats")
        turns = hash_rank(mine.select("key"), "key", seed)
        copies = F.lit(want // n) + F.when(F.col("rank") < want % n, 1).otherwise(0)
        made = turns.select("key", F.explode(F.when(copies > 0, F.sequence(F.lit(1), copies)).otherwise(
            F.array().cast("array<int>"))).alias("copy"))
        key_, copy = F.col("key"), F.col("copy")
        of = near.groupBy("key").agg(F.max("rank").alias("_m"))
        made = made.join(of, "key").withColumn("rank", (_draw(key_, copy, seed, "which") % F.col("_m") + 1).cast("int"))
        made = made.join(near.select("key", "rank", "neighbour"), ["key", "rank"]).join(mine, "key").join(
            mine.select(F.col("key").alias("neighbour"), F.col("v").alias("_w")), "neighbour")
        part = _draw(key_, copy, seed, "far") / F.lit(float(2 ** 32))
        moved = F.zip_with("v", "_w", lambda a, b: a + part * (b - a))
        rows = made.withColumn("_new", moved).select(
            F.col("key").alias(key), "copy", F.lit(label).cast(df.schema[y].dataType).alias(y), "neighbour",
            *[F.col("_new")[i].alias(c) for i, c in enumerate(cols)])
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        fields = ", ".join(f"`{c}` double" for c in cols)
        out = df.sparkSession.createDataFrame(
            [], f"`{key}` {kind}, copy int, `{y}` {df.schema[y].dataType.simpleString()}, neighbour {kind}, {fields}")
    return out


def oversample(df: DataFrame, y: str, key: str, cols: Sequence[str], ratio: float = 1.0, k: int = 5,
               seed: int = 42) -> DataFrame:
    """K6: the rows of ``df`` (key, copy 0, y, cols...) with the generated ones."""
    made = smote_rows(df, y, key, cols, ratio, k, seed).drop("neighbour")
    own = df.select(key, F.lit(0).alias("copy"), y, *[F.col(c).cast("double").alias(c) for c in cols])
    return own.unionByName(made)


def combined_resample(df: DataFrame, y: str, key: str, cols: Sequence[str], over: float = 0.1, under: float = 0.5,
                      k: int = 5, seed: int = 42) -> DataFrame:
    """K8, two classes: the smaller one generated up to ``over`` times the
    larger one (left alone where it is larger already), then the larger one cut
    to the smaller one's size / ``under``, in a seeded order of key and copy."""
    rows = cut_lineage(oversample(df, y, key, cols, over, k, seed))
    named = rows.withColumn("_row", F.concat_ws(":", F.col(key).cast("string"), F.col("copy").cast("string")))
    return undersample(named, y, "_row", under, seed).drop("_row")
