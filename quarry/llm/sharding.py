"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

A partial partition is a vector of subset sums.  Differencing repeatedly takes
the two partial partitions with the largest spread (largest minus smallest
subset) and adds them in opposite order, largest onto smallest, until one is
left.  A heap of single items is unbounded at scale, so it runs on blocks:

* groups above a bundle's size (total / (shards * bundles_per_shard); there can
  be at most shards * bundles_per_shard of them) stay single items;
* all others are hashed to blocks of about ``block_rows`` groups, and each
  block is differenced into bundles of about that size, one task per block
  (single items are told from bundles by their negative ids);
* that is repeated while more than ``final_rows`` items are left, and the rest
  - a number bounded by the parameters, whatever the input - is differenced
  into the shards.

Few groups (up to ``final_rows``) are differenced directly.  The rows of a
group of copies are added up before any shuffle, so a hot text is one item.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import utf8_bytes, written

ROW_OVERHEAD = 8


def difference(sizes: np.ndarray, k: int) -> np.ndarray:
    """Karmarkar-Karp for ``k`` subsets: the subset (0..k-1) of every item.

    Deterministic: ties in spread go to the partial partition made first."""
    n = len(sizes)
    if n == 0 or k == 1:
        return np.zeros(n, np.int64)
    sums: dict[int, np.ndarray] = {}
    heap = [(-s, i) for i, s in enumerate(sizes.tolist())]
    heapq.heapify(heap)
    made: list[tuple[int, int, np.ndarray, np.ndarray]] = []  # left, right, their subset at each place

    def subset_sums(i: int) -> np.ndarray:
        if i < n:
            v = np.zeros(k, np.int64)
            v[0] = sizes[i]
            return v
        return sums.pop(i)

    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        # places run from the largest subset down; b is laid on in reverse
        both = subset_sums(a) + subset_sums(b)[::-1]
        order = np.argsort(-both, kind="stable").astype(np.int32)
        node = n + len(made)
        made.append((a, b, order, (k - 1 - order).astype(np.int32)))
        sums[node] = both[order]
        heapq.heappush(heap, (-int(both[order[0]] - both[order[-1]]), node))
    # walk the merges backwards: the final subset of each place of each node
    place = {heap[0][1]: np.arange(k, dtype=np.int32)}
    out = np.zeros(n, np.int64)
    for node in range(n + len(made) - 1, n - 1, -1):
        a, b, from_a, from_b = made[node - n]
        mine = place.pop(node)
        for child, src in ((a, from_a), (b, from_b)):
            if child < n:
                out[child] = mine[int(np.nonzero(src == 0)[0][0])]
            else:
                p = np.empty(k, np.int32)
                p[src] = mine
                place[child] = p
    return out


def _block_bundles(target: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "item"], ascending=[False, True], kind="stable")
        sizes = pdf["size"].to_numpy(np.int64)
        k = max(1, min(len(sizes), round(int(sizes.sum()) / target)))
        block = int(pdf["block"].iloc[0])
        return pd.DataFrame({"item": pdf["item"].to_numpy(), "size": sizes,
                             "next": block * (1 << 20) + difference(sizes, k)})
    return run


def _final(shards: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)  # at most final_rows rows, see shard_groups
        if not parts:
            return
        pdf = pd.concat(parts).sort_values(["size", "item"], ascending=[False, True], kind="stable")
        yield pd.DataFrame({"item": pdf["item"].to_numpy(),
                            "shard": difference(pdf["size"].to_numpy(np.int64), shards).astype(np.int32)})
    return run


def shard_groups(groups: DataFrame, shards: int, bundles_per_shard: int = 256, block_rows: int = 8192,
                 final_rows: int = 32768) -> DataFrame:
    """(item long, size long), one row per group -> (item, shard int)."""
    stats = groups.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    n, total = int(stats[0]), int(stats[1])
    target = max(1, total // (shards * bundles_per_shard))
    items, levels = groups.select("item", "size"), []
    while n > final_rows:
        light = items.where(F.col("size") <= target)
        block = F.pmod(F.xxhash64("item", F.lit(len(levels))), F.lit(max(1, n // block_rows)))
        heavy = items.where(F.col("size") > target).withColumn(
            "next", -F.row_number().over(Window.orderBy("size", "item")).cast("long"))
        step = written(
            light.withColumn("block", block).groupBy("block")
            .applyInPandas(_block_bundles(target), "item long, size long, next long")
            .unionByName(heavy), "bundles")
        levels.append(step.select("item", "next"))
        items = written(step.groupBy("next").agg(F.sum("size").alias("size")).withColumnRenamed("next", "item"),
                        "items")
        before, n = n, items.count()
        if n == before:  # nothing left below the target: fewer, larger bundles
            target *= 2
    out = written(items.coalesce(1).mapInPandas(_final(shards), "item long, shard int"), "shards")
    for step in reversed(levels):
        out = step.join(out.withColumnRenamed("item", "next"), "next").select("item", "shard")
    return out


def shard_documents(docs: DataFrame, shards: int = 24, **limits) -> DataFrame:
    """All rows of ``docs`` (doc_id, text, ...) in shards of nearly equal bytes.

    Returns doc_id, size (UTF-8 bytes of the text plus 8), text_crc32, law
    ('bytes'), shard (0 to shards - 1), slot (0, 1, ... within a shard) and
    grown_shard (null: another number of shards deals every row anew).

    Rows of equal text share a shard.  A null text is handled as an empty one:
    8 bytes, CRC 0, one group with the empty texts.  Rows that are equal in
    everything get a slot each; a null doc_id is kept.  An empty table gives no
    rows.  Columns other than doc_id and text are ignored."""
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = written(docs.select("doc_id", (utf8_bytes(F.col("text")) + ROW_OVERHEAD).alias("size"),
                               F.crc32(text.cast("binary")).alias("text_crc32"),
                               F.xxhash64(text).alias("item")), "sizes")
    groups = written(slim.groupBy("item").agg(F.sum("size").alias("size")), "groups")
    placed = slim.join(shard_groups(groups, shards, **limits), "item")
    # slots without a window over a whole shard: rows are ranked within
    # (shard, bucket), and the counts of the buckets before give the offset
    buckets = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4)
    placed = written(placed.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "item"), F.lit(buckets))), "placed")
    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size"))
    return (placed.withColumn("rank", rank).join(offsets, ["shard", "bucket"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("offset") + F.col("rank") - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
