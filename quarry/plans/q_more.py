"""Sinks and sources read back (S1, S3-S6, S8, S9), header audit, joins, sorts,
order statistic, curve interpolation, adaptive support and checks of fitted
models by their exact properties."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from ..operators import columns as co
from ..operators import encode as en
from ..operators import evaluate as ev
from ..operators import impute as im
from ..operators import mining as mi
from ..operators import profile as pr
from ..operators import quantile as qu
from ..operators import timeseries as ts
from ..session import checkpoint_dir
from ..sources import files
from ..sources import fixtures as fx
from ..sources.tables import table
from .q_mining import TYPE_FI_SQL, TYPE_RULES_SQL, type_baskets, type_itemsets, type_rules
from .q_timeseries import FILL_SQL
from .registry import register
from .sqlfix import DEMO, DOC_FEATURES, LAB, OUTCOME, PV_GRID, SCORES, with_

LAB_COLS = ["quantity", "price", "discount", "tax", "ship_days"]
# A header mapping in the form the reference keeps as a JSON file.
MAPPING = {"c_custkey": "code", "c_mktsegment": "age_band", "c_acctbal": "balance"}


def _r(c, n=6):
    return F.round(c, n)


def _folder(spark, name):
    """A new folder in the shared storage that the session names."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


DEMO_SCHEMA = "code long, age_band string, gender string, balance double"
DEMO_SQL = with_(DEMO) + "SELECT code, age_band, gender, balance FROM demo"


@register("csv_round_trip", DEMO_SQL)
def csv_round_trip(spark, sf_dir):
    """S4 then S1: written as CSV with a header, scanned with a schema."""
    path = _folder(spark, "csv")
    files.write_csv(fx.demo(spark, sf_dir), path)
    return files.read_csv(spark, path, DEMO_SCHEMA)


@register("signed_csv_round_trip", DEMO_SQL)
def signed_csv_round_trip(spark, sf_dir):
    """S4 with a byte order mark in front of every file, then S1."""
    path = _folder(spark, "signed")
    files.write_csv(fx.demo(spark, sf_dir), path, signed=True)
    return files.read_csv(spark, path, DEMO_SCHEMA)


@register("json_round_trip", DEMO_SQL)
def json_round_trip(spark, sf_dir):
    """Written as JSON lines and read back."""
    path = _folder(spark, "json")
    files.write_json(fx.demo(spark, sf_dir), path)
    return spark.read.schema(DEMO_SCHEMA).json(path)


@register("json_by_key", DEMO_SQL + " WHERE gender = 'Male'")
def json_by_key(spark, sf_dir):
    """One folder per key; reading one key opens that folder only."""
    path = _folder(spark, "json-by-key")
    files.write_json(fx.demo(spark, sf_dir), path, partition_by=["gender"])
    return spark.read.schema(DEMO_SCHEMA).json(path).where(F.col("gender") == "Male")


@register("filled_series", with_(PV_GRID) + FILL_SQL + """
SELECT series, t, round(power_filled, 6) AS power_filled FROM filled""")
def filled_series(spark, sf_dir):
    """The filled series materialised by series, then read by later jobs."""
    path = _folder(spark, "filled")
    files.write_parquet(ts.tod_mean_fill(fx.pv_grid(spark, sf_dir), "power"), path, partition_by=["series"])
    return spark.read.parquet(path).select("series", "t", _r(F.col("power_filled")).alias("power_filled"))


@register("mapped_scan", "SELECT c_custkey AS code, c_mktsegment AS age_band, c_acctbal AS balance FROM customer")
def mapped_scan(spark, sf_dir):
    """S3 + P2: headers renamed by a mapping read from a JSON file."""
    path = _folder(spark, "mapping")
    spark.createDataFrame([(json.dumps(MAPPING),)], "value string").coalesce(1).write.text(path)
    mapping = files.read_mapping(spark, path)
    return co.clean_headers(table(spark, sf_dir, "customer").select(*mapping), mapping)


@register("header_audit", """
SELECT feature, n FROM (SELECT count(c_name) AS c_name, count(c_nationkey) AS c_nationkey FROM customer)
UNPIVOT (n FOR feature IN (c_name, c_nationkey))""")
def header_audit(spark, sf_dir):
    """Columns that the mapping does not cover, with how many values each holds."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal")
    left = co.unmapped_columns(co.clean_headers(cust, MAPPING).columns, MAPPING)
    return cust.agg(*[F.count(c).alias(c) for c in left]).unpivot([], left, "feature", "n")


@register("model_round_trip", "SELECT count(*) AS rows, 0 AS differing FROM embeddings")
def model_round_trip(spark, sf_dir):
    """A fitted model saved and loaded assigns every row as before."""
    from pyspark.ml.clustering import KMeans, KMeansModel

    from .q_models import zvectors
    v, path = zvectors(spark, sf_dir), _folder(spark, "model")
    model = KMeans(k=4, seed=1, maxIter=5).fit(v)
    files.save_model(model, path)
    one = model.transform(v).select("vec_id", F.col("prediction").alias("a"))
    two = KMeansModel.load(path).transform(v).select("vec_id", F.col("prediction").alias("b"))
    both = one.join(two, "vec_id")
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("a") != F.col("b")).cast("int").alias("differing"))


@register("kmeans_check", "SELECT count(*) AS rows, count(DISTINCT vec_id) AS ids, 0 AS not_nearest FROM embeddings")
def kmeans_check(spark, sf_dir):
    """Every id once, and no row nearer to another cluster's centre."""
    from ..operators import cluster as cu
    from .q_models import K_OVERALL, zvectors
    v = zvectors(spark, sf_dir)
    model = cu.kmeans_best(v, K_OVERALL)
    centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()])
    dist = F.transform(centres, lambda c: F.aggregate(F.zip_with("v", c, lambda a, b: (a - b) * (a - b)), F.lit(0.0),
                                                      lambda s, x: s + x))
    got = model.transform(v).select("vec_id", "prediction", dist.alias("d"))
    worse = F.element_at("d", F.col("prediction") + 1) > F.array_min("d") + 1e-9
    return got.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("vec_id").alias("ids"),
                   F.count_if(worse).cast("int").alias("not_nearest"))


@register("iforest_check", with_(PV_GRID) + """
SELECT count(*) AS rows, true AS share_kept, true AS scores_in_range FROM pv_grid
WHERE power IS NOT NULL AND generation IS NOT NULL""")
def iforest_check(spark, sf_dir):
    """Every point scored once, at most the contamination share flagged,
    scores within (0, 1)."""
    from .q_models import iforest_points
    r = iforest_points(spark, sf_dir)
    n = F.count(F.lit(1))
    return r.agg(n.alias("rows"), (F.count_if(F.col("label") == -1) <= F.ceil(0.01 * n)).alias("share_kept"),
                 ((F.min("score") > 0) & (F.max("score") < 1)).alias("scores_in_range"))


@register("importance_check", with_(DOC_FEATURES) + """
SELECT len(list_distinct(flatten(list(map_keys(m))))) AS features, 1.0 AS total, true AS sorted
FROM (SELECT map {'n_chars': n_chars, 'n_words': n_words, 'n_lines': n_lines, 'upper_share': upper_share,
                  'digit_share': digit_share, 'punct_share': punct_share, 'lang_code': lang_code} AS m
      FROM doc_features)""")
def importance_check(spark, sf_dir):
    """Importances sum to 1 and come sorted; the top three are the
    three largest."""
    from ..operators import classify as cl
    from .q_boost import gbt_importance
    imp = gbt_importance(spark, sf_dir)
    values = [r["importance"] for r in imp.collect()]  # a row per feature
    top = [r["importance"] for r in cl.importance_top(imp, 3).collect()]
    return imp.agg(F.count(F.lit(1)).cast("int").alias("features"), _r(F.sum("importance")).alias("total")).withColumn(
        "sorted", F.lit(values == sorted(values, reverse=True) and top == values[:3]))


@register("demo_inner_join", with_(DEMO, OUTCOME) + """
SELECT o.oid, o.code, d.age_band, d.gender, o.deceased FROM outcome o JOIN demo d ON o.code = d.code""")
def demo_inner_join(spark, sf_dir):
    """Outcome rows with their features, inner."""
    return fx.outcome(spark, sf_dir).join(fx.demo(spark, sf_dir), "code").select(
        "oid", "code", "age_band", "gender", "deceased")


@register("cluster_demo_join", with_(DEMO, OUTCOME) + """
SELECT a.priority AS cluster, d.age_band, count(*) AS n FROM outcome a LEFT JOIN demo d ON a.code = d.code GROUP BY ALL""")
def cluster_demo_join(spark, sf_dir):
    """Cluster assignments (priority per order row) left-joined to the
    demographics; sizes per cluster and age band."""
    a = fx.outcome(spark, sf_dir).select("code", F.col("priority").alias("cluster"))
    return a.join(fx.demo(spark, sf_dir), "code", "left").groupBy("cluster", "age_band").agg(
        F.count(F.lit(1)).alias("n"))


@register("strong_rules", TYPE_RULES_SQL + """
SELECT rule, round(lift, 6) AS lift, round(support, 6) AS support FROM rules WHERE lift >= 1.0 AND support >= 0.06""")
def strong_rules(spark, sf_dir):
    """Rules by lift and support (thresholds that this data's rules reach)."""
    r = mi.rule_text(mi.strong_rules(type_rules(spark, sf_dir), 1.0, 0.06))
    return r.select("rule", _r(F.col("lift")).alias("lift"), _r(F.col("support")).alias("support"))


@register("itemsets_top20", TYPE_FI_SQL + """
SELECT array_to_string(items, ', ') AS itemset, round(support, 6) AS support FROM fi
ORDER BY fi.support DESC, array_to_string(items, ', ') LIMIT 20""")
def itemsets_top20(spark, sf_dir):
    """T5: the 20 itemsets of highest support over all lengths."""
    t = mi.top_itemsets(type_itemsets(spark, sf_dir), 20)
    return t.select("itemset", _r(F.col("support")).alias("support"))


@register("adaptive_itemsets", TYPE_FI_SQL + """
SELECT array_to_string(items, ', ') AS itemset, count, round(support, 6) AS support FROM fi""")
def adaptive_itemsets(spark, sf_dir):
    """M3: itemsets at max(.05, 10 / N), with a fallback run if there are no pairs."""
    fi = mi.adaptive_itemsets(type_baskets(spark, sf_dir), 3)
    return fi.select(F.concat_ws(", ", "items").alias("itemset"), "count", _r(F.col("support")).alias("support"))


@register("null_ratio_sorted", with_(LAB) + "SELECT row_number() OVER (ORDER BY ratio DESC, feature) AS place, feature, "
          "round(ratio, 6) AS ratio FROM (" + " UNION ALL ".join(
              f"SELECT '{c}' AS feature, avg(CAST({c} IS NULL AS DOUBLE)) AS ratio FROM lab" for c in LAB_COLS) + ")")
def null_ratio_sorted(spark, sf_dir):
    """Columns by missing ratio, highest first."""
    p = pr.sorted_rows(pr.null_profile(fx.lab(spark, sf_dir), LAB_COLS), [F.col("ratio").desc(), F.col("feature")])
    return p.select("place", "feature", _r(F.col("ratio")).alias("ratio"))


@register("value_counts_by_key", """
SELECT row_number() OVER (ORDER BY l_quantity) AS place, l_quantity AS quantity, count(*) AS n FROM lineitem
GROUP BY l_quantity""")
def value_counts_by_key(spark, sf_dir):
    """Value counts in key order."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_quantity").alias("quantity"))
    return pr.sorted_rows(pr.value_counts(li, "quantity"), [F.col("quantity")]).select("place", "quantity", "n")


@register("order_stat", """
SELECT max(total) AS total, max(v) FILTER (WHERE pos = floor(0.95 * total)) AS value
FROM (SELECT l_extendedprice AS v, row_number() OVER (ORDER BY l_extendedprice) - 1 AS pos, count(*) OVER () AS total
      FROM lineitem)""")
def order_stat(spark, sf_dir):
    """The element at floor(.95 n) of the sorted prices."""
    return qu.order_statistic(table(spark, sf_dir, "lineitem"), "l_extendedprice", 0.95)


@register("zero_fill", with_(LAB) + "SELECT rid, " + ", ".join(
    f"coalesce({c}, 0.0) AS {c}" for c in LAB_COLS) + " FROM lab")
def zero_fill(spark, sf_dir):
    """Missing values as 0 before clustering."""
    return im.sentinel_impute(fx.lab(spark, sf_dir), LAB_COLS, 0.0).select("rid", *LAB_COLS)


@register("band_counts", with_(SCORES) + """,
b AS (SELECT score / (SELECT max(score) FROM scores) AS p FROM scores)
SELECT CASE WHEN p > 0 AND p <= 0.3 THEN 'low' WHEN p > 0.3 AND p <= 0.7 THEN 'medium'
            WHEN p > 0.7 AND p <= 1.0 THEN 'high' END AS risk_level, count(*) AS n FROM b GROUP BY 1""")
def band_counts(spark, sf_dir):
    """Rows per risk band, on a score scaled to [0, 1]."""
    from ..operators import classify as cl
    s = fx.scores(spark, sf_dir)
    top = s.select(F.max("score")).scalar()
    return cl.band_counts(s.select(en.risk_band(F.col("score") / top).alias("risk_level")))


CURVE_SQL = with_(SCORES) + """,
f AS (SELECT doc_id % 5 AS fold, y, score FROM scores),
d AS (SELECT fold, score, sum(y) AS pos, sum(1 - y) AS neg FROM f GROUP BY ALL),
c AS (SELECT fold, sum(neg) OVER w / sum(neg) OVER t AS x, sum(pos) OVER w / sum(pos) OVER t AS v FROM d
      WINDOW w AS (PARTITION BY fold ORDER BY score DESC), t AS (PARTITION BY fold)),
pts AS (SELECT fold, x, v FROM c UNION ALL SELECT DISTINCT fold, 0.0, 0.0 FROM f),
g AS (SELECT unnest(range(100)) AS i),
lo AS (SELECT fold, i, max(struct_pack(x := x, v := v)) AS p FROM pts, g WHERE x <= i / 99.0 GROUP BY ALL),
hi AS (SELECT fold, i, min(struct_pack(x := x, v := v)) AS p FROM pts, g WHERE x > i / 99.0 GROUP BY ALL),
m AS (SELECT lo.fold, lo.i, CASE WHEN hi.p IS NULL THEN lo.p.v
        ELSE lo.p.v + (hi.p.v - lo.p.v) * (i / 99.0 - lo.p.x) / (hi.p.x - lo.p.x) END AS v
      FROM lo LEFT JOIN hi USING (fold, i))
SELECT CAST(i AS INTEGER) AS i, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std FROM m GROUP BY i"""


@register("mean_roc_curve", CURVE_SQL)
def mean_roc_curve(spark, sf_dir):
    """K4 + X11: ROC curves of five given folds, each interpolated at 100
    points, then their mean and spread."""
    s = fx.scores(spark, sf_dir).withColumn("fold", F.col("doc_id") % 5)
    c = ev.mean_curve(ev.fold_roc(s, "fold"), "fold", 100)
    return c.select("i", _r(F.col("mean")).alias("mean"), _r(F.col("std")).alias("std"))
