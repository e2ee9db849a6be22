"""Order-of-magnitude outliers.

O1 per numeric column, on positive values only:
  * log10 values are counted into ``BIN`` wide bins by a grouped count, so the
    density estimate reads (column, bin, count) rows - at most log-range / BIN
    per column - instead of the raw values;
  * one small pandas function per column evaluates the Gaussian KDE
    (bandwidth = 0.2 x sample std of the logs) on 1,000 points over
    [min - 1, max + 1], keeps strict local maxima, merges them by 1-D Ward
    linkage cut at 0.5 and turns the merged centres into bands
    centre +- 0.5 (a band starts at least 0.1 above the previous one);
  * band shares and flags are exact: values are range-joined to the bands
    (few per column, broadcast once counted, so that the values of a column
    are not sent to one task), a band holding less
    than ``min_share`` of the column's positive values flags its members.
Columns with fewer than 10 positive values or a single distinct one keep all.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import join_small, long_form

BIN = 1e-4
GRID = 1000
BANDS_SCHEMA = "feature string, band int, lo double, hi double"


def ward_merge_1d(points: Sequence[float], cut: float = 0.5) -> list[float]:
    """Centres of the flat clusters of 1-D Ward linkage cut at ``cut``
    (merges applied while the Ward distance is <= cut)."""
    clusters = [(float(p), 1) for p in points]
    while len(clusters) > 1:
        best, bi = None, None
        for i in range(len(clusters)):
            for j in range(i + 1, len(clusters)):
                (ci, ni), (cj, nj) = clusters[i], clusters[j]
                d = np.sqrt(2.0 * ni * nj / (ni + nj)) * abs(ci - cj)
                if best is None or d < best:
                    best, bi = d, (i, j)
        if best > cut:
            break
        i, j = bi
        (ci, ni), (cj, nj) = clusters[i], clusters[j]
        merged = ((ci * ni + cj * nj) / (ni + nj), ni + nj)
        clusters = [c for k, c in enumerate(clusters) if k not in (i, j)] + [merged]
    return sorted(c for c, _ in clusters)


def bands_from_bins(pdf: pd.DataFrame) -> pd.DataFrame:
    """Per-column pandas step: (feature, center, cnt, n, n_unique, sd, mn, mx) -> bands."""
    feat = pdf["feature"].iloc[0]
    n, nu = int(pdf["n"].iloc[0]), int(pdf["n_unique"].iloc[0])     # nu: 1 = constant, 2 = not
    empty = pd.DataFrame({"feature": [], "band": [], "lo": [], "hi": []}).astype(
        {"feature": str, "band": "int32", "lo": float, "hi": float})
    if n < 10 or nu == 1:
        return empty
    sd, mn, mx = float(pdf["sd"].iloc[0]), float(pdf["mn"].iloc[0]), float(pdf["mx"].iloc[0])
    h = 0.2 * sd
    if not np.isfinite(h) or h <= 0:
        return empty
    x = np.linspace(mn - 1, mx + 1, GRID)
    c = pdf["center"].to_numpy()
    w = pdf["cnt"].to_numpy(dtype=float)
    dens = np.zeros(GRID)
    for start in range(0, len(c), 4096):                      # bounded memory per chunk
        z = (x[:, None] - c[None, start:start + 4096]) / h
        dens += (np.exp(-0.5 * z * z) * w[None, start:start + 4096]).sum(axis=1)
    # strict local maxima: the density's slope turns from up to down
    slope = np.sign(np.diff(dens))
    peaks = x[1:-1][(slope[:-1] > 0) & (slope[1:] < 0)]
    if len(peaks) <= 1:
        return empty
    # a band reaches half an order to either side of its centre, but starts no
    # sooner than 0.1 above the band before, which ends at its centre + 0.5
    mid = np.array(ward_merge_1d(peaks))
    floor = np.concatenate([[-np.inf], mid[:-1] + 0.6])
    return pd.DataFrame({"feature": feat, "band": np.arange(len(mid), dtype="int32"),
                         "lo": np.maximum(mid - 0.5, floor), "hi": mid + 0.5})


def log_values(df: DataFrame, id_col: str, cols: Sequence[str]) -> DataFrame:
    """(id, feature, value, lx) for the positive values of ``cols``."""
    long = long_form(df, [id_col], cols, "feature", "value").where(F.col("value") > 0)
    return long.withColumn("lx", F.log10("value"))


def scale_bands(lv: DataFrame) -> DataFrame:
    """O1 band table (feature, band, lo, hi) from log values."""
    stats = lv.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"),
        F.when(F.min("value") == F.max("value"), F.lit(1)).otherwise(F.lit(2)).alias("n_unique"),
        F.stddev_samp("lx").alias("sd"), F.min("lx").alias("mn"), F.max("lx").alias("mx"))
    bins = lv.groupBy("feature", F.floor(F.col("lx") / BIN).alias("b")).agg(F.count(F.lit(1)).alias("cnt"))
    bins = bins.withColumn("center", (F.col("b") + 0.5) * BIN).join(stats, "feature")
    return bins.groupBy("feature").applyInPandas(bands_from_bins, BANDS_SCHEMA)


def band_shares(lv: DataFrame, bands: DataFrame) -> DataFrame:
    """Share of each band (values with lo <= lx <= hi) among the column's
    positive values; the bands table is tiny, so the range join is an
    equi-join on the column with a BETWEEN filter, by broadcast: a shuffle
    would bring all values of a column to one task."""
    bands = cut_lineage(bands)
    n = lv.groupBy("feature").agg(F.count(F.lit(1)).alias("n"))
    hit = join_small(lv, bands, ["feature"]).where(F.col("lx").between(F.col("lo"), F.col("hi")))
    cnt = hit.groupBy("feature", "band").agg(F.count(F.lit(1)).alias("members"))
    return (bands.join(cnt, ["feature", "band"], "left").na.fill(0, ["members"]).join(n, "feature")
            .withColumn("share", F.col("members") / F.col("n")))


def flagged_cells(lv: DataFrame, bands: DataFrame, min_share: float = 0.01) -> DataFrame:
    """O2: (feature, id, value) of every value inside a band whose share < min_share."""
    sh = cut_lineage(band_shares(lv, bands).where(F.col("share") < min_share).select("feature", "band", "lo", "hi"))
    return (join_small(lv, sh, ["feature"]).where(F.col("lx").between(F.col("lo"), F.col("hi")))
            .select("feature", *[c for c in lv.columns if c not in ("feature", "value", "lx")], "value").distinct())


def remove_flagged(df: DataFrame, id_col: str, flagged: DataFrame) -> DataFrame:
    """Drop every row with at least one flagged cell (anti join)."""
    return df.join(flagged.select(id_col).distinct(), id_col, "left_anti")
