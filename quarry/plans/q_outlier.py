"""Outlier queries (O1-O3, J7) on prices with injected x1000 errors."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import outlier as ol
from ..session import cut_lineage
from ..sources import fixtures as fx
from .registry import register
from .sqlfix import SCALE_ERRORS, with_

COLS = ["price", "quantity"]
# Fixed bands (log10 scale) for the exact variant: the regular price decades
# and the decades of the x1000 errors.
FIXED_BANDS = [("price", 0, 2.0, 5.6), ("price", 1, 5.7, 9.0)]


def _r(c, n=6):
    return F.round(c, n)


def _lv(spark, sf_dir):
    return ol.log_values(fx.scale_errors(spark, sf_dir), "rid", COLS)


def _fixed(spark):
    return spark.createDataFrame(FIXED_BANDS, ol.BANDS_SCHEMA)


BANDS_SQL = with_(SCALE_ERRORS) + """,
lv AS (SELECT rid, 'price' AS feature, price AS value, log10(price) AS lx FROM scale_errors WHERE price > 0
       UNION ALL SELECT rid, 'quantity', quantity, log10(quantity) FROM scale_errors WHERE quantity > 0),
bands AS (SELECT * FROM (VALUES """ + ", ".join(f"('{f}', {b}, {lo}, {hi})" for f, b, lo, hi in FIXED_BANDS) + """)
          t(feature, band, lo, hi)),
n AS (SELECT feature, count(*) AS n FROM lv GROUP BY feature),
m AS (SELECT b.feature, b.band, count(lv.lx) AS members FROM bands b LEFT JOIN lv
      ON lv.feature = b.feature AND lv.lx BETWEEN b.lo AND b.hi GROUP BY b.feature, b.band),
sh AS (SELECT b.*, m.members, n.n, m.members / n.n AS share FROM bands b JOIN m USING (feature, band) JOIN n USING (feature))"""


@register("scale_bands_flag", BANDS_SQL + """
SELECT feature, CAST(band AS INTEGER) AS band, lo, hi, members, n, round(share, 6) AS share FROM sh""")
def scale_bands_flag(spark, sf_dir):
    """Band membership shares for given order-of-magnitude bands."""
    s = ol.band_shares(_lv(spark, sf_dir), _fixed(spark))
    return s.select("feature", "band", "lo", "hi", "members", "n", _r(F.col("share")).alias("share"))


@register("flagged_cells", BANDS_SQL + """
SELECT DISTINCT lv.feature, lv.rid, lv.value FROM lv JOIN sh ON lv.feature = sh.feature
  AND lv.lx BETWEEN sh.lo AND sh.hi WHERE sh.share < 0.01""")
def flagged_cells(spark, sf_dir):
    """O2: cells in bands holding < 1 % of their column (given bands)."""
    return ol.flagged_cells(_lv(spark, sf_dir), _fixed(spark))


@register("outlier_removal", BANDS_SQL + """,
fl AS (SELECT DISTINCT lv.rid FROM lv JOIN sh ON lv.feature = sh.feature AND lv.lx BETWEEN sh.lo AND sh.hi
       WHERE sh.share < 0.01)
SELECT (SELECT count(*) FROM scale_errors WHERE rid NOT IN (SELECT rid FROM fl)) AS kept,
       (SELECT count(*) FROM scale_errors WHERE rid IN (SELECT rid FROM fl)) AS removed""")
def outlier_removal(spark, sf_dir):
    """Rows kept and removed after dropping every flagged row."""
    src = fx.scale_errors(spark, sf_dir)
    fl = ol.flagged_cells(_lv(spark, sf_dir), _fixed(spark))
    kept = ol.remove_flagged(src, "rid", fl)
    total = src.select(F.count(F.lit(1))).scalar()
    return kept.agg(F.count(F.lit(1)).alias("kept")).withColumn("removed", total - F.col("kept"))


@register("kde_bands")
def kde_bands(spark, sf_dir):
    """O1: bands found by the KDE / peak / Ward procedure, with their shares."""
    lv = _lv(spark, sf_dir)          # scan + unpivot: cheaper to re-read than to materialise
    return ol.band_shares(lv, ol.scale_bands(lv))


@register("kde_outliers")
def kde_outliers(spark, sf_dir):
    """O1 + O2 end to end: flagged cells from the learned bands."""
    lv = _lv(spark, sf_dir)
    return ol.flagged_cells(lv, ol.scale_bands(lv))


@register("kde_check", with_(SCALE_ERRORS) + """
SELECT 'price' AS feature, count(*) AS n, true AS members_hold, true AS flags_hold FROM scale_errors WHERE price > 0""")
def kde_check(spark, sf_dir):
    """O1: members of the learned price bands, recounted by comparisons with
    each band alone, and the cells flagged: exactly those of the sparse bands."""
    lv = _lv(spark, sf_dir).where("feature = 'price'")
    bands = cut_lineage(ol.scale_bands(lv))
    told = ol.band_shares(lv, bands).orderBy("band").collect()  # a few bands
    lx = F.col("lx")
    inside = [lx.between(b["lo"], b["hi"]) for b in told]
    sparse = [c for b, c in zip(told, inside, strict=True) if b["members"] / b["n"] < 0.01]
    flagged = F.lit(False)
    for c in sparse:
        flagged = flagged | c
    again = lv.agg(F.count(F.lit(1)).alias("n"), F.count_if(flagged).alias("f"),
                   *[F.count_if(c).alias(f"m{i}") for i, c in enumerate(inside)]).first()
    holds = all(again[f"m{i}"] == b["members"] and again["n"] == b["n"] for i, b in enumerate(told))
    cells = ol.flagged_cells(lv, bands).count()
    return spark.createDataFrame([("price", again["n"], holds and len(told) > 1, cells == again["f"] and cells > 0)],
                                 "feature string, n long, members_hold boolean, flags_hold boolean")
