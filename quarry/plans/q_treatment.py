"""Treatment queries: imputation, encoding, scaling, discretisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import encode as en
from ..operators import impute as im
from ..operators.common import long_form
from ..sources import fixtures as fx
from ..sources.fixtures import LAB_FEATURES
from ..sources.tables import table
from .q_profile import auto_bins_sql, edge_sql
from .registry import register
from .sqlfix import DEMO, LAB, MIXED_TEXT, SCORES, with_


def _r(c, n=6):
    return F.round(c, n)


def peak_sql(long_sql: str, keys: str) -> str:
    """DuckDB CTEs ending in ``fills(keys..., fill_half, fill_closed, peak_lo, peak_hi, mean)``."""
    on = " AND ".join(f"nx.{k.strip()} = pp.{k.strip()}" for k in keys.split(","))
    return auto_bins_sql(long_sql, keys) + f""",
pb AS (SELECT {keys}, first, last, nb, bin, count(*) AS cnt, sum(x) AS s,
              sum(CASE WHEN x < {edge_sql('bin + 1')} THEN x END) AS hs,
              count(*) FILTER (WHERE x < {edge_sql('bin + 1')}) AS hn,
              sum(CASE WHEN x = {edge_sql('bin')} THEN x END) AS es,
              count(*) FILTER (WHERE x = {edge_sql('bin')}) AS en
       FROM binned GROUP BY {keys}, first, last, nb, bin),
pm AS (SELECT {keys}, sum(s) / sum(cnt) AS mean FROM pb GROUP BY {keys}),
pp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY cnt DESC, bin) AS r FROM pb) WHERE r = 1),
fills AS (SELECT {", ".join("pp." + k.strip() for k in keys.split(","))},
                 CASE WHEN pp.hn > 0 THEN pp.hs / pp.hn ELSE pm.mean END AS fill_half,
                 (pp.s + coalesce(nx.es, 0.0)) / (pp.cnt + coalesce(nx.en, 0)) AS fill_closed,
                 CAST(pp.bin AS DOUBLE) * ((pp.last - pp.first) / pp.nb) + pp.first AS peak_lo,
                 CASE WHEN pp.bin + 1 = pp.nb THEN pp.last
                      ELSE CAST(pp.bin + 1 AS DOUBLE) * ((pp.last - pp.first) / pp.nb) + pp.first END AS peak_hi,
                 pm.mean
          FROM pp JOIN pm USING ({keys}) LEFT JOIN pb nx ON {on} AND nx.bin = pp.bin + 1)"""


GROUPED = ["quantity", "price", "ship_days"]
GROUPED_LONG = " UNION ALL ".join(f"SELECT grp, '{c}' AS feature, {c} AS x FROM lab" for c in GROUPED)


@register("peak_fill_table", with_(LAB) + peak_sql(GROUPED_LONG, "grp, feature") + """
SELECT grp, feature, round(fill_half, 6) AS fill, round(peak_lo, 6) AS peak_lo, round(peak_hi, 6) AS peak_hi,
       round(mean, 6) AS mean FROM fills""")
def peak_fill_table(spark, sf_dir):
    """I2 statistics: per (group, feature) the peak bin of the numpy-auto
    histogram, its half-open mean and the group mean."""
    long = long_form(fx.lab(spark, sf_dir), ["grp"], GROUPED)
    f = im.peak_fill_values(long, ["grp", "feature"])
    return f.select("grp", "feature", *[_r(F.col(c)).alias(c) for c in ("fill", "peak_lo", "peak_hi", "mean")])


@register("peak_impute_grouped", with_(LAB) + peak_sql(GROUPED_LONG, "grp, feature") + """
SELECT l.rid, l.grp,
  round(coalesce(l.quantity, (SELECT fill_half FROM fills f WHERE f.grp = l.grp AND f.feature = 'quantity')), 6) AS quantity,
  round(coalesce(l.price, (SELECT fill_half FROM fills f WHERE f.grp = l.grp AND f.feature = 'price')), 6) AS price,
  round(coalesce(l.ship_days, (SELECT fill_half FROM fills f WHERE f.grp = l.grp AND f.feature = 'ship_days')), 6) AS ship_days
FROM lab l""")
def peak_impute_grouped(spark, sf_dir):
    """Half-open peak-bin fill per returnflag group."""
    d = im.peak_impute(fx.lab(spark, sf_dir).select("rid", "grp", *GROUPED), GROUPED, group="grp")
    return d.select("rid", "grp", *[_r(F.col(c)).alias(c) for c in GROUPED])


SPARSE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS valid, round(1.0 - count({c}) / count(*), 6) AS missing_ratio, "
    f"(1.0 - count({c}) / count(*) > 0.5 OR count({c}) < 5) AS dropped FROM lab" for c in LAB_FEATURES)


@register("sparse_columns", with_(LAB) + SPARSE_SQL)
def sparse_columns(spark, sf_dir):
    """I8: valid count, missing share and the drop decision per column."""
    lab = fx.lab(spark, sf_dir)
    cols = list(LAB_FEATURES)
    one = lab.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(c) for c in cols])
    long = one.unpivot(["_n"], cols, "feature", "valid")
    ratio = 1.0 - F.col("valid") / F.col("_n")
    return long.select("feature", "valid", _r(ratio).alias("missing_ratio"),
                       ((ratio > 0.5) | (F.col("valid") < 5)).alias("dropped"))


CLOSED = ["quantity", "price", "ship_days"]       # the columns I8 keeps at every scale
CLOSED_LONG = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS x FROM lab" for c in CLOSED)


@register("peak_impute_closed", with_(LAB) + peak_sql(CLOSED_LONG, "feature") + """
SELECT l.rid,
  round_even(coalesce(l.quantity, (SELECT fill_closed FROM fills WHERE feature = 'quantity')), 2) AS quantity,
  round_even(coalesce(l.price, (SELECT fill_closed FROM fills WHERE feature = 'price')), 2) AS price,
  round_even(coalesce(l.ship_days, (SELECT fill_closed FROM fills WHERE feature = 'ship_days')), 2) AS ship_days
FROM lab l""")
def peak_impute_closed(spark, sf_dir):
    """I1 + I8 (lab3 flow): drop sparse columns, closed-interval peak fill,
    values rounded half-even to 2 decimals."""
    lab = fx.lab(spark, sf_dir)
    drop = im.drop_sparse(lab, list(LAB_FEATURES))
    keep = [c for c in LAB_FEATURES if c not in drop]
    d = im.peak_impute(lab.select("rid", *keep), keep, closed=True, round_to=2)
    return d.select("rid", *keep)


@register("mode_impute", with_(LAB) + """
SELECT rid, coalesce(discount, (SELECT discount FROM lab WHERE discount IS NOT NULL GROUP BY 1
                                ORDER BY count(*) DESC, discount LIMIT 1)) AS discount FROM lab""")
def mode_impute(spark, sf_dir):
    """I3 + A19: most frequent value (smallest on ties) fills the gaps."""
    lab = fx.lab(spark, sf_dir).select("rid", "discount")
    return im.mode_impute(lab, ["discount"])


TIER_SQL = """
SELECT l.rid, l.grp,
  round(coalesce(l.quantity, (SELECT fill_half FROM fills f WHERE f.grp = l.grp AND f.feature = 'quantity')), 6) AS quantity,
  round(coalesce(l.price, (SELECT fill_half FROM fills f WHERE f.grp = l.grp AND f.feature = 'price')), 6) AS price,
  round(coalesce(l.ship_days, (SELECT fill_half FROM fills f WHERE f.grp = l.grp AND f.feature = 'ship_days')), 6) AS ship_days,
  CAST(l.price IS NOT NULL AS INTEGER) AS Missing_price,
  round(coalesce(l.discount, -999.0), 6) AS discount,
  CAST(l.discount IS NOT NULL AS INTEGER) AS Tested_discount
FROM lab l"""


@register("tiered_plan", with_(LAB) + peak_sql(GROUPED_LONG, "grp, feature") + TIER_SQL)
def tiered_plan(spark, sf_dir):
    """I6 + I7 + I4: tiers from the one-row null profile decide the treatment:
    quantity / ship_days (low) grouped peak fill; price (medium) Missing_ flag +
    peak fill; discount (high) Tested_ flag + -999; tax (extreme) dropped."""
    lab = fx.lab(spark, sf_dir)
    t = im.tiered_treatment(lab, list(LAB_FEATURES), "grp")
    num = [c for c in t.columns if c not in ("rid", "grp") and not c.startswith(("Missing_", "Tested_"))]
    return t.select("rid", "grp", *[_r(F.col(c)).alias(c) for c in num],
                    *[c for c in t.columns if c.startswith(("Missing_", "Tested_"))])


@register("mixed_text_recode", with_(MIXED_TEXT) + """
SELECT event_id,
  CASE WHEN troponin IS NULL OR trim(troponin) = '' THEN 1
       WHEN lower(trim(troponin)) = 'negative' THEN 0
       WHEN TRY_CAST(trim(troponin) AS DOUBLE) > 0 AND NOT isnan(TRY_CAST(trim(troponin) AS DOUBLE)) THEN 1
       ELSE 0 END AS troponin_code,
  CAST(troponin IS NOT NULL AS INTEGER) AS Tested_troponin
FROM mixed_text""")
def mixed_text_recode(spark, sf_dir):
    """I9 with the reference's blank -> 1 behaviour (``blank_as=1``) + Tested_ flag."""
    m = fx.mixed_text(spark, sf_dir)
    return m.select("event_id", en.mixed_text_code(F.col("troponin"), blank_as=1).alias("troponin_code"),
                    en.tested_flag(F.col("troponin")).alias("Tested_troponin"))


@register("label_encode", """
SELECT c_custkey, c_mktsegment, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS c_mktsegment_encoded
FROM customer""")
def label_encode(spark, sf_dir):
    """Lexicographic codes of the segment."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return en.label_encode(c, "c_mktsegment")


# The maps applied by ``map_encode`` (partial on purpose: an
# unmapped band becomes NULL, as in the reference's age map).
GENDER_MAP = {"Male": 1, "Female": 0}
BAND_MAP = {"AUTOMOBILE": 0, "BUILDING": 1, "FURNITURE": 2}


@register("map_encode", with_(DEMO) + """
SELECT code, CASE gender WHEN 'Male' THEN 1 WHEN 'Female' THEN 0 END AS gender_code,
       CASE age_band WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 2 END AS band_code
FROM demo""")
def map_encode(spark, sf_dir):
    """Fixed maps; unmapped values are NULL."""
    d = fx.demo(spark, sf_dir)
    return d.select("code", en.map_encode(F.col("gender"), GENDER_MAP).alias("gender_code"),
                    en.map_encode(F.col("age_band"), BAND_MAP).alias("band_code"))


@register("binary_recode", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN l_linenumber = 1 THEN 0 WHEN l_linenumber = 2 THEN 1 ELSE l_linenumber END AS line_code
FROM lineitem""")
def binary_recode(spark, sf_dir):
    """{1: 0, 2: 1}, other values unchanged."""
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     en.binary_recode(F.col("l_linenumber")).alias("line_code"))


SCALE_COLS = ["p_size", "p_retailprice"]


@register("minmax_scale", """
SELECT p_partkey,
  round(CASE WHEN max(p_size) OVER () = min(p_size) OVER () THEN 0.0
             ELSE (p_size - min(p_size) OVER ()) / (max(p_size) OVER () - min(p_size) OVER ()) END, 6) AS p_size,
  round(CASE WHEN max(p_retailprice) OVER () = min(p_retailprice) OVER () THEN 0.0
             ELSE (p_retailprice - min(p_retailprice) OVER ()) / (max(p_retailprice) OVER () - min(p_retailprice) OVER ()) END, 6)
    AS p_retailprice,
  0.0 AS constant
FROM part""")
def minmax_scale(spark, sf_dir):
    """Min-max scaling (a constant column maps to 0)."""
    p = table(spark, sf_dir, "part").select("p_partkey", *SCALE_COLS, F.lit(7.0).alias("constant"))
    s = en.minmax_scale(p, SCALE_COLS + ["constant"])
    return s.select("p_partkey", *[_r(F.col(c)).alias(c) for c in SCALE_COLS], "constant")


@register("scaler_ranges", """
SELECT 'p_size' AS feature, CAST(min(p_size) AS DOUBLE) AS orig_min, CAST(max(p_size) AS DOUBLE) AS orig_max,
       0.0 AS scaled_min, 1.0 AS scaled_max FROM part
UNION ALL
SELECT 'p_retailprice', min(p_retailprice), max(p_retailprice), 0.0, 1.0 FROM part""")
def scaler_ranges(spark, sf_dir):
    """Original and post-scaling ranges."""
    p = table(spark, sf_dir, "part").select(*SCALE_COLS)
    r = en.scaler_ranges(p, en.minmax_scale(p, SCALE_COLS), SCALE_COLS)
    return r.select("feature", *[_r(F.col(c)).alias(c) for c in ("orig_min", "orig_max", "scaled_min", "scaled_max")])


Z_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


@register("zscore", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, """ + ", ".join(
    f"round(CASE WHEN stddev_pop({c}) OVER () = 0 THEN 0.0 ELSE ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () END, 6) AS {c}"
    for c in Z_COLS) + " FROM lineitem")
def zscore(spark, sf_dir):
    """Z-score with the population std."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *Z_COLS)
    z = en.zscore(li, Z_COLS)
    return z.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *[_r(F.col(c)).alias(c) for c in Z_COLS])


D1_SELECT = """SELECT rid, quantity, price, discount, ship_days, CAST(grp = 'R' AS INTEGER) AS returned,
  CASE WHEN discount < 0.04 THEN 0.0 ELSE discount END AS disc_zero FROM lab"""
D1_COLS = ["quantity", "price", "discount", "ship_days", "returned", "disc_zero"]


def _d1_df(spark, sf_dir):
    lab = fx.lab(spark, sf_dir)
    return lab.select("rid", "quantity", "price", "discount", "ship_days",
                      (F.col("grp") == "R").cast("int").alias("returned"),
                      F.when(F.col("discount") < 0.04, F.lit(0.0)).otherwise(F.col("discount")).alias("disc_zero"))


def _d1_case(c: str) -> str:
    return f"""CASE
  WHEN (SELECT count(*) FILTER (WHERE {c} = 0) / count({c}) FROM d) > 0.3 THEN
    CASE WHEN {c} = 0 THEN '{c}_zero' WHEN {c} IS NOT NULL THEN '{c}_non_zero' END
  WHEN (SELECT count(DISTINCT {c}) FROM d) <= 3 THEN '{c}_' || CAST({c} AS VARCHAR)
  WHEN {c} IS NULL THEN NULL
  WHEN (SELECT count(DISTINCT e) FROM (SELECT unnest([min({c}), quantile_cont({c}, 1.0/3.0),
            quantile_cont({c}, 2.0/3.0), max({c})]) AS e FROM d)) = 4 THEN
    CASE WHEN {c} <= (SELECT quantile_cont({c}, 1.0/3.0) FROM d) THEN '{c}_low'
         WHEN {c} <= (SELECT quantile_cont({c}, 2.0/3.0) FROM d) THEN '{c}_med' ELSE '{c}_high' END
  ELSE
    CASE WHEN {c} <= (SELECT min({c}) + (max({c}) - min({c})) / 3 FROM d) THEN '{c}_low'
         WHEN {c} <= (SELECT min({c}) + 2 * ((max({c}) - min({c})) / 3) FROM d) THEN '{c}_med' ELSE '{c}_high' END
END AS {c}_bin"""


@register("adaptive_bins", with_(LAB) + f", d AS ({D1_SELECT})\nSELECT rid, "
          + ",\n".join(_d1_case(c) for c in D1_COLS) + " FROM d")
def adaptive_bins(spark, sf_dir):
    """Per-column strategy chosen from one profile aggregation."""
    d = _d1_df(spark, sf_dir)
    b = en.adaptive_bins(d, D1_COLS)
    return b.select("rid", *[f"{c}_bin" for c in D1_COLS])


D2_COLS = ["quantity", "price", "ship_days", "returned"]


@register("median_binarise", with_(LAB) + f", d AS ({D1_SELECT})\nSELECT rid, "
          + ", ".join(f"coalesce({c} > (SELECT quantile_cont({c}, 0.5) FROM d), false) AS {c}" for c in D2_COLS[:-1])
          + ", coalesce(returned <> 0, false) AS returned FROM d")
def median_binarise(spark, sf_dir):
    """Above-median flags (binary columns: != 0); NULL -> false."""
    d = _d1_df(spark, sf_dir).select("rid", *D2_COLS)
    return en.median_binarise(d, D2_COLS)


@register("risk_bands", with_(SCORES) + """
SELECT doc_id, round(score / (SELECT max(score) FROM scores), 6) AS p,
  CASE WHEN score / (SELECT max(score) FROM scores) > 0 AND score / (SELECT max(score) FROM scores) <= 0.3 THEN 'low'
       WHEN score / (SELECT max(score) FROM scores) > 0.3 AND score / (SELECT max(score) FROM scores) <= 0.7 THEN 'medium'
       WHEN score / (SELECT max(score) FROM scores) > 0.7 AND score / (SELECT max(score) FROM scores) <= 1.0 THEN 'high'
  END AS band
FROM scores""")
def risk_bands(spark, sf_dir):
    """D3 on a score normalised to [0, 1]."""
    s = fx.scores(spark, sf_dir)
    s = s.withColumn("p", F.col("score") / s.select(F.max("score")).scalar())
    return s.select("doc_id", _r(F.col("p")).alias("p"), en.risk_band(F.col("p")).alias("band"))
