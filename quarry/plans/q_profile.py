"""Profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import columns as cols_
from ..operators import profile as pr
from ..sources import fixtures as fx
from ..sources.fixtures import LAB_FEATURES
from ..sources.tables import table
from .registry import register
from .sqlfix import DEMO, LAB, OUTCOME, PV_GRID, with_


def _r(c, n=6):
    return F.round(c, n)


LABF = list(LAB_FEATURES)


@register("value_counts", """
SELECT o_orderpriority, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct
FROM orders GROUP BY 1""")
def value_counts(spark, sf_dir):
    v = pr.value_counts(table(spark, sf_dir, "orders"), "o_orderpriority")
    return v.withColumn("pct", _r(F.col("pct")))


@register("count_of_counts", """
SELECT n_records, count(*) AS n_keys FROM (SELECT o_custkey, count(*) AS n_records FROM orders GROUP BY 1) GROUP BY 1""")
def count_of_counts(spark, sf_dir):
    return pr.count_of_counts(table(spark, sf_dir, "orders"), "o_custkey")


@register("examples_per_count", """
WITH k AS (SELECT o_custkey, count(*) AS n_records FROM orders GROUP BY 1),
r AS (SELECT *, row_number() OVER (PARTITION BY n_records ORDER BY o_custkey) AS rn FROM k)
SELECT n_records, string_agg(CAST(o_custkey AS VARCHAR), ',' ORDER BY o_custkey) AS examples
FROM r WHERE rn <= 5 GROUP BY 1""")
def examples_per_count(spark, sf_dir):
    return pr.examples_per_count(table(spark, sf_dir, "orders"), "o_custkey")


_NULLP_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} IS NULL) AS missing, count(*) AS n FROM lab" for c in LABF)


@register("null_profile", with_(LAB) + f"""
, p AS ({_NULLP_SQL})
SELECT feature, missing, round(missing / n, 6) AS ratio,
       CASE WHEN missing / n > 0.5 THEN 'red' WHEN missing / n > 0.1 THEN 'orange' ELSE 'blue' END AS severity,
       CASE WHEN missing / n <= 0.3 THEN 'low' WHEN missing / n <= 0.6 THEN 'medium'
            WHEN missing / n <= 0.8 THEN 'high' ELSE 'extreme' END AS tier
FROM p""")
def null_profile(spark, sf_dir):
    p = pr.null_profile(fx.lab(spark, sf_dir), LABF)
    return p.withColumn("ratio", _r(F.col("ratio")))


@register("dropped_row_audit", with_(LAB) + """
SELECT rid, 'quantity' AS feature FROM lab WHERE quantity IS NULL
UNION ALL SELECT rid, 'price' AS feature FROM lab WHERE price IS NULL""")
def dropped_row_audit(spark, sf_dir):
    return pr.dropped_row_audit(fx.lab(spark, sf_dir), "rid", ["quantity", "price"])


@register("dropped_row_counts", with_(LAB) + """
SELECT '_rows_before' AS feature, count(*) AS n FROM lab
UNION ALL SELECT '_rows_after', count(*) FROM lab WHERE quantity IS NOT NULL AND price IS NOT NULL
UNION ALL SELECT 'quantity', count(*) FROM lab WHERE quantity IS NULL
UNION ALL SELECT 'price', count(*) FROM lab WHERE price IS NULL""")
def dropped_row_counts(spark, sf_dir):
    return pr.dropped_row_counts(fx.lab(spark, sf_dir), ["quantity", "price"])


VC_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_linenumber"]
_NUM = {"l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"}


@register("variable_classes", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS nunique, "
    f"CASE WHEN count(DISTINCT {c}) = 2 THEN 'binary' WHEN {str(c in _NUM).upper()} THEN 'continuous' "
    f"ELSE 'discrete' END AS class FROM lineitem" for c in VC_COLS))
def variable_classes(spark, sf_dir):
    return pr.variable_classes(table(spark, sf_dir, "lineitem"), VC_COLS)


FT_SELECT = """l_quantity AS quantity, l_discount AS discount, l_tax AS tax, l_linenumber AS linenumber,
  CAST(l_returnflag = 'R' AS INTEGER) AS returned, CAST(l_linestatus = 'O' AS INTEGER) AS Tested_open,
  CAST(l_discount > 0.05 AS INTEGER) AS Missing_high_discount"""
FT_COLS = ["quantity", "discount", "tax", "linenumber", "returned", "Tested_open", "Missing_high_discount"]


@register("feature_types", f"WITH f AS (SELECT {FT_SELECT} FROM lineitem) " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS nunique, CASE "
    f"WHEN '{c}' LIKE 'Missing\\_%' ESCAPE '\\' THEN 'missing_indicator' "
    f"WHEN '{c}' LIKE 'Tested\\_%' ESCAPE '\\' THEN 'tested_indicator' "
    f"WHEN count(DISTINCT {c}) = 2 AND count(*) FILTER (WHERE {c} IS NOT NULL AND CAST({c} AS DOUBLE) NOT IN (0.0, 1.0)) = 0 "
    f"THEN 'binary' WHEN count(DISTINCT {c}) > 2 AND count(DISTINCT {c}) <= 10 THEN 'categorical' "
    f"ELSE 'continuous' END AS type FROM f" for c in FT_COLS))
def feature_types(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    f = li.select(F.col("l_quantity").alias("quantity"), F.col("l_discount").alias("discount"),
                  F.col("l_tax").alias("tax"), F.col("l_linenumber").alias("linenumber"),
                  (F.col("l_returnflag") == "R").cast("int").alias("returned"),
                  (F.col("l_linestatus") == "O").cast("int").alias("Tested_open"),
                  (F.col("l_discount") > 0.05).cast("int").alias("Missing_high_discount"))
    return pr.feature_types(f, FT_COLS)


_DP = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, count({c}) AS n, count(DISTINCT {c}) AS n_unique,
    count(*) FILTER (WHERE {c} = 0) AS zero_count, min({c}) AS min, max({c}) AS max,
    quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.75) AS q75
    FROM lab""" for c in LABF)


@register("dist_profile", with_(LAB) + f""", d AS ({_DP})
SELECT feature, n, n_unique, zero_count, round(min, 6) AS min, round(max, 6) AS max,
       round(q25, 6) AS q25, round(median, 6) AS median, round(q75, 6) AS q75 FROM d""")
def dist_profile(spark, sf_dir):
    d = pr.dist_profile(fx.lab(spark, sf_dir), LABF)
    return d.select("feature", "n", "n_unique", "zero_count",
                    *[_r(F.col(c)).alias(c) for c in ("min", "max", "q25", "median", "q75")])


@register("box_stats", """
WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                  quantile_cont(value, 0.75) AS q3, count(value) AS n FROM events GROUP BY 1),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_fence, q3 + 1.5 * (q3 - q1) AS hi_fence FROM q)
SELECT f.event_type, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, n,
       round(lo_fence, 6) AS lo_fence, round(hi_fence, 6) AS hi_fence,
       round(min(CASE WHEN value BETWEEN lo_fence AND hi_fence THEN value END), 6) AS whisker_lo,
       round(max(CASE WHEN value BETWEEN lo_fence AND hi_fence THEN value END), 6) AS whisker_hi,
       count(*) FILTER (WHERE NOT (value BETWEEN lo_fence AND hi_fence)) AS outliers
FROM f JOIN events e ON e.event_type = f.event_type
GROUP BY f.event_type, q1, median, q3, n, lo_fence, hi_fence""")
def box_stats(spark, sf_dir):
    b = pr.box_stats(table(spark, sf_dir, "events"), "value", ["event_type"])
    return b.select("event_type", *[_r(F.col(c)).alias(c) for c in ("q1", "median", "q3")], "n",
                    *[_r(F.col(c)).alias(c) for c in ("lo_fence", "hi_fence", "whisker_lo", "whisker_hi")],
                    "outliers")


@register("hist_fixed", """
WITH c AS (SELECT CAST(least(floor((value - 0.0) * 60 / (60.0 - 0.0)), 59) AS INTEGER) AS bin, count(*) AS n
           FROM events WHERE value >= 0.0 AND value <= 60.0 GROUP BY 1)
SELECT CAST(b.bin AS INTEGER) AS bin, coalesce(c.n, 0) AS n, round(b.bin * 1.0 + 0.0, 6) AS lo,
       round(CASE WHEN b.bin + 1 = 60 THEN 60.0 ELSE (b.bin + 1) * 1.0 + 0.0 END, 6) AS hi
FROM range(60) b(bin) LEFT JOIN c ON c.bin = b.bin""")
def hist_fixed(spark, sf_dir):
    h = pr.fixed_histogram(table(spark, sf_dir, "events"), "value", 0.0, 60.0, 60)
    return h.select("bin", "n", _r(F.col("lo")).alias("lo"), _r(F.col("hi")).alias("hi"))


@register("hist_p99", """
WITH p AS (SELECT quantile_cont(value, 0.99) AS hi FROM events),
c AS (SELECT CAST(least(floor(value * 49 / p.hi), 48) AS INTEGER) AS bin, count(*) AS n
      FROM events, p WHERE value >= 0 AND value <= p.hi GROUP BY 1)
SELECT CAST(b.bin AS INTEGER) AS bin, coalesce(c.n, 0) AS n, round(b.bin * ((p.hi - 0.0) / 49) + 0.0, 6) AS lo,
       round(CASE WHEN b.bin + 1 = 49 THEN p.hi ELSE (b.bin + 1) * ((p.hi - 0.0) / 49) + 0.0 END, 6) AS hi
FROM range(49) b(bin) CROSS JOIN p LEFT JOIN c ON c.bin = b.bin""")
def hist_p99(spark, sf_dir):
    h = pr.percentile_histogram(table(spark, sf_dir, "events"), "value", 0.99, 49)
    return h.select("bin", "n", _r(F.col("lo")).alias("lo"), _r(F.col("hi")).alias("hi"))


@register("hist_minmax30", """
WITH m AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
c AS (SELECT CAST(least(floor((l_extendedprice - m.lo) * 30 / (m.hi - m.lo)), 29) AS INTEGER) AS bin, count(*) AS n
      FROM lineitem, m GROUP BY 1)
SELECT CAST(b.bin AS INTEGER) AS bin, coalesce(c.n, 0) AS n, round(b.bin * ((m.hi - m.lo) / 30) + m.lo, 6) AS lo,
       round(CASE WHEN b.bin + 1 = 30 THEN m.hi ELSE (b.bin + 1) * ((m.hi - m.lo) / 30) + m.lo END, 6) AS hi
FROM range(30) b(bin) CROSS JOIN m LEFT JOIN c ON c.bin = b.bin""")
def hist_minmax30(spark, sf_dir):
    h = pr.minmax_histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice", 30)
    return h.select("bin", "n", _r(F.col("lo")).alias("lo"), _r(F.col("hi")).alias("hi"))


def auto_bins_sql(long_sql: str, keys: str) -> str:
    """DuckDB version of profile.auto_bin_stats + bin_index over a long CTE
    ``long(keys..., x)``; returns CTEs ``st`` and ``binned``."""
    return f""",
st0 AS (SELECT {keys}, count(*) AS n, min(x) AS mn, max(x) AS mx, quantile_cont(x, 0.25) AS q1,
               quantile_cont(x, 0.75) AS q3 FROM ({long_sql}) WHERE x IS NOT NULL GROUP BY {keys}),
st1 AS (SELECT *, mx - mn AS rng, 2.0 * (q3 - q1) * pow(CAST(n AS DOUBLE), -1.0 / 3.0) AS fd,
               (mx - mn) / (log2(CAST(n AS DOUBLE)) + 1.0) AS sturges, (mx - mn) / sqrt(CAST(n AS DOUBLE)) AS sqw FROM st0),
st2 AS (SELECT *, least(greatest(fd, sqw / 2), sturges) AS width FROM st1),
st AS (SELECT {keys}, n, CASE WHEN rng = 0 THEN mn - 0.5 ELSE mn END AS first,
              CASE WHEN rng = 0 THEN mx + 0.5 ELSE mx END AS last FROM st2),
stn AS (SELECT st.*, CAST(CASE WHEN s.width > 0 THEN ceil((st.last - st.first) / s.width) ELSE 1 END AS BIGINT) AS nb
        FROM st JOIN st2 s USING ({keys})),
b0 AS (SELECT l.*, stn.first, stn.last, stn.nb,
              least(CAST(trunc((l.x - stn.first) / (stn.last - stn.first) * stn.nb) AS BIGINT), stn.nb - 1) AS i0
       FROM ({long_sql}) l JOIN stn USING ({keys}) WHERE l.x IS NOT NULL),
b1 AS (SELECT *, CASE WHEN x < (CASE WHEN i0 = nb THEN last ELSE CAST(i0 AS DOUBLE) * ((last - first) / nb) + first END)
                      THEN i0 - 1 ELSE i0 END AS i1 FROM b0),
binned AS (SELECT *, CASE WHEN x >= (CASE WHEN i1 + 1 = nb THEN last ELSE CAST(i1 + 1 AS DOUBLE) * ((last - first) / nb) + first END)
                           AND i1 <> nb - 1 THEN i1 + 1 ELSE i1 END AS bin FROM b1)"""


def edge_sql(i: str) -> str:
    return f"(CASE WHEN {i} = nb THEN last ELSE CAST({i} AS DOUBLE) * ((last - first) / nb) + first END)"


LAB_LONG_SQL = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS x FROM lab" for c in LABF)


@register("hist_auto", with_(LAB) + auto_bins_sql(LAB_LONG_SQL, "feature") + f"""
SELECT feature, bin, round({edge_sql('bin')}, 6) AS lo, round({edge_sql('bin + 1')}, 6) AS hi, count(*) AS n
FROM binned GROUP BY feature, bin, first, last, nb""")
def hist_auto(spark, sf_dir):
    h = pr.auto_histogram(fx.lab(spark, sf_dir), LABF)
    return h.select("feature", "bin", _r(F.col("lo")).alias("lo"), _r(F.col("hi")).alias("hi"), "n")


@register("cluster_profile", """
WITH d AS (SELECT label, unnest(range(64)) AS dim, unnest(embedding) AS x FROM embeddings),
s AS (SELECT label, count(*) AS size FROM embeddings GROUP BY 1)
SELECT d.label, CAST(dim AS INTEGER) AS dim, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std,
       s.size, round(s.size * 100.0 / (SELECT count(*) FROM embeddings), 6) AS pct
FROM d JOIN s USING (label) GROUP BY d.label, dim, s.size""")
def cluster_profile(spark, sf_dir):
    """Per given cluster (embedding label) and dimension mean / std, size, share."""
    p = pr.array_profile(fx.vectors(spark, sf_dir), "label", "v")
    return p.select("label", "dim", _r(F.col("mean")).alias("mean"), _r(F.col("std")).alias("std"),
                    "size", _r(F.col("pct")).alias("pct"))


@register("top_variance", """
WITH d AS (SELECT unnest(range(64)) AS dim, unnest(embedding) AS x FROM embeddings)
SELECT CAST(dim AS INTEGER) AS dim, round(var_samp(x), 6) AS var FROM d GROUP BY dim
ORDER BY var_samp(x) DESC, dim LIMIT 20""")
def top_variance(spark, sf_dir):
    t = pr.top_variance(fx.vectors(spark, sf_dir), "v", 20)
    return t.select("dim", _r(F.col("var")).alias("var"))


@register("crosstab_pct", with_(DEMO) + """,
c AS (SELECT age_band, gender, count(*) AS n FROM demo GROUP BY ALL),
g AS (SELECT a.age_band, b.gender FROM (SELECT DISTINCT age_band FROM demo) a, (SELECT DISTINCT gender FROM demo) b)
SELECT g.age_band, g.gender, coalesce(c.n, 0) AS n,
       round(coalesce(c.n, 0) * 100.0 / sum(coalesce(c.n, 0)) OVER (PARTITION BY g.age_band), 6) AS pct
FROM g LEFT JOIN c USING (age_band, gender)""")
def crosstab_pct(spark, sf_dir):
    c = pr.crosstab_pct(fx.demo(spark, sf_dir), "age_band", "gender")
    return c.withColumn("pct", _r(F.col("pct")))


@register("rate_by_group", with_(DEMO, OUTCOME) + """,
r AS (SELECT d.age_band, avg(o.deceased) * 100 AS rate, count(*) AS n, CAST(sum(o.deceased) AS BIGINT) AS positives
      FROM outcome o LEFT JOIN demo d ON o.code = d.code GROUP BY 1)
SELECT age_band, round(rate, 6) AS rate, n, positives,
       CASE WHEN rate > (SELECT quantile_cont(rate, 0.5) FROM r) THEN 'above' ELSE 'below' END AS band FROM r""")
def rate_by_group(spark, sf_dir):
    """J1 + A23: outcome rows left-joined to demographics; rate per age band."""
    j = fx.outcome(spark, sf_dir).join(fx.demo(spark, sf_dir), "code", "left")
    r = pr.rate_by_group(j, "age_band", "deceased")
    return r.withColumn("rate", _r(F.col("rate")))


@register("demo_left_join", with_(DEMO, OUTCOME) + """
SELECT o.oid, o.code, d.age_band, d.gender, o.deceased FROM outcome o LEFT JOIN demo d ON o.code = d.code""")
def demo_left_join(spark, sf_dir):
    """Many-to-one join of outcome rows to demographics (the
    dimension side is left to AQE: broadcast when its runtime size is small,
    sort-merge otherwise)."""
    j = fx.outcome(spark, sf_dir).join(fx.demo(spark, sf_dir), "code", "left")
    return j.select("oid", "code", "age_band", "gender", "deceased")


@register("outcome_fanout", with_(OUTCOME) + """,
fan AS (SELECT a.priority AS cluster, b.deceased FROM outcome a JOIN outcome b ON a.code = b.code)
SELECT cluster, round(avg(deceased) * 100, 6) AS rate, count(*) AS n, CAST(sum(deceased) AS BIGINT) AS deaths
FROM fan GROUP BY 1""")
def outcome_fanout(spark, sf_dir):
    """J3 (trap B3 kept for parity): cluster assignments (priority per order row)
    joined to the outcome rows on the *repeated* customer key.  Computed
    without materialising the pairs: per (key, cluster) assignment counts times
    per-key outcome counts, so a hot key costs one row, not n^2."""
    o = fx.outcome(spark, sf_dir)
    a = o.groupBy("code", F.col("priority").alias("cluster")).agg(F.count(F.lit(1)).alias("na"))
    b = o.groupBy("code").agg(F.count(F.lit(1)).alias("nb"), F.sum("deceased").alias("db"))
    j = a.join(b, "code")
    r = j.groupBy("cluster").agg(F.sum(F.col("na") * F.col("nb")).alias("n"),
                                 F.sum(F.col("na") * F.col("db")).cast("bigint").alias("deaths"))
    return r.select("cluster", _r(F.col("deaths") * 100.0 / F.col("n")).alias("rate"), "n", "deaths")


@register("outcome_by_row", with_(OUTCOME) + """
SELECT priority AS cluster, round(avg(deceased) * 100, 6) AS rate, count(*) AS n,
       CAST(sum(deceased) AS BIGINT) AS deaths FROM outcome GROUP BY 1""")
def outcome_by_row(spark, sf_dir):
    """J3 corrected: assignments joined to outcomes on the row id (no fan-out)."""
    o = fx.outcome(spark, sf_dir)
    a = o.select("oid", F.col("priority").alias("cluster"))
    j = a.join(o.select("oid", "deceased"), "oid")
    r = j.groupBy("cluster").agg((F.avg("deceased") * 100).alias("rate"), F.count(F.lit(1)).alias("n"),
                                 F.sum("deceased").cast("bigint").alias("deaths"))
    return r.withColumn("rate", _r(F.col("rate")))


@register("corr_matrix", with_(LAB) + " UNION ALL ".join(
    (f"SELECT '{a}' AS a, '{b}' AS b, 1.0 AS r" if a == b else f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lab")
    for a in LABF for b in LABF))
def corr_matrix(spark, sf_dir):
    c = pr.corr_matrix(fx.lab(spark, sf_dir), LABF)
    return c.withColumn("r", _r(F.col("r")))


COHORT_SQL = """
cohort AS (
  SELECT 'C' || c_custkey AS code, c_name AS name, c_acctbal AS balance, 'customer' AS cohort FROM customer
  WHERE c_name IS NOT NULL AND lower(trim(c_name)) <> 'n/a'
  UNION ALL
  SELECT 'S' || s_suppkey AS code, s_name AS name, s_acctbal AS balance, 'supplier' AS cohort FROM supplier
  WHERE s_name IS NOT NULL AND lower(trim(s_name)) <> 'n/a')"""


def cohort_stack_df(spark, sf_dir):
    """P7 + P8 + U1: two cohorts with their own feature names renamed to common
    ones, null-token rows removed, stacked by name."""
    def side(tab, key, name, bal, prefix, label):
        d = table(spark, sf_dir, tab).select(
            F.concat(F.lit(prefix), F.col(key).cast("string")).alias("code"),
            F.col(name).alias("name"), F.col(bal).alias("balance"), F.lit(label).alias("cohort"))
        return d.where(F.col("name").isNotNull() & (F.lower(F.trim("name")) != "n/a"))
    return side("customer", "c_custkey", "c_name", "c_acctbal", "C", "customer").unionByName(
        side("supplier", "s_suppkey", "s_name", "s_acctbal", "S", "supplier"))


@register("cohort_stack", with_(COHORT_SQL) + "SELECT code, name, round(balance, 6) AS balance, cohort FROM cohort")
def cohort_stack(spark, sf_dir):
    return cohort_stack_df(spark, sf_dir).withColumn("balance", _r(F.col("balance")))


@register("cohort_counts", with_(COHORT_SQL) + """
SELECT substring(code, 1, 1) AS grp, count(*) AS n, count(*) FILTER (WHERE starts_with(code, 'C')) AS n_customer,
       count(DISTINCT code) AS n_codes FROM cohort GROUP BY 1""")
def cohort_counts(spark, sf_dir):
    """P15 + A1 + A10: cohort key from the id prefix, counts per cohort."""
    c = cohort_stack_df(spark, sf_dir)
    return c.groupBy(F.substring("code", 1, 1).alias("grp")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("code").startswith("C")).alias("n_customer"),
        F.count_distinct("code").alias("n_codes"))


# Fixed feature mapping for the header clean-up (P1-P5): raw names carry stray
# spaces, a full-width bracket and two raw columns map to one label.
HEADER_MAP = {"c_custkey": " code ", "c_name": "name", "c_acctbal": "balance（USD）",
              "c_mktsegment": "segment", "c_nationkey": "segment"}


@register("renamed_scan", """
SELECT c_custkey AS "code", c_name AS "name", round(c_acctbal, 6) AS "balance(USD)",
       c_mktsegment AS "segment", c_nationkey AS "segment.1" FROM customer""")
def renamed_scan(spark, sf_dir):
    """Trim, map, unify brackets and de-duplicate names in one projection."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment", "c_nationkey")
    c = c.toDF(*[HEADER_MAP[n] for n in c.columns])
    out = cols_.clean_headers(c)
    return out.withColumn("balance(USD)", _r(F.col("`balance(USD)`")))


@register("distinct_values", with_(OUTCOME) + "SELECT DISTINCT priority, deceased FROM outcome")
def distinct_values(spark, sf_dir):
    """Distinct group values."""
    return fx.outcome(spark, sf_dir).select("priority", "deceased").distinct()


@register("summary_lines", with_(DEMO, OUTCOME) + """
SELECT 'age_band' AS metric, age_band AS key, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct
FROM demo GROUP BY age_band
UNION ALL
SELECT 'gender', gender, count(*), round(count(*) * 100.0 / sum(count(*)) OVER (), 6) FROM demo GROUP BY gender
UNION ALL
SELECT 'deceased', CAST(deceased AS VARCHAR), count(*), round(count(*) * 100.0 / sum(count(*)) OVER (), 6)
FROM outcome GROUP BY deceased
UNION ALL
SELECT 'records_per_code', CAST(c AS VARCHAR), count(*), round(count(*) * 100.0 / sum(count(*)) OVER (), 6)
FROM (SELECT code, count(*) AS c FROM outcome GROUP BY code) GROUP BY c""")
def summary_lines(spark, sf_dir):
    """The summary report as one long (metric, key, n, pct) table built by
    unioning the value-count operators (A2, A3)."""
    d, o = fx.demo(spark, sf_dir), fx.outcome(spark, sf_dir)

    def vc(df, col, name):
        v = pr.value_counts(df.select(F.col(col).cast("string").alias("key")), "key")
        return v.select(F.lit(name).alias("metric"), "key", "n", _r(F.col("pct")).alias("pct"))

    per_code = o.groupBy("code").agg(F.count(F.lit(1)).alias("c"))
    return (vc(d, "age_band", "age_band").unionByName(vc(d, "gender", "gender"))
            .unionByName(vc(o, "deceased", "deceased")).unionByName(vc(per_code, "c", "records_per_code")))


@register("indicator_sums", with_(LAB) + """
SELECT 'Missing_price' AS feature, CAST(sum(CAST(price IS NOT NULL AS INTEGER)) AS BIGINT) AS ones,
       round(sum(CAST(price IS NOT NULL AS INTEGER)) * 100.0 / count(*), 6) AS pct FROM lab
UNION ALL
SELECT 'Tested_discount', CAST(sum(CAST(discount IS NOT NULL AS INTEGER)) AS BIGINT),
       round(sum(CAST(discount IS NOT NULL AS INTEGER)) * 100.0 / count(*), 6) FROM lab""")
def indicator_sums(spark, sf_dir):
    """Count and share of 1s of each indicator column of the tiered table."""
    lab = fx.lab(spark, sf_dir)
    ind = lab.select((F.col("price").isNotNull()).cast("int").alias("Missing_price"),
                     (F.col("discount").isNotNull()).cast("int").alias("Tested_discount"))
    s = pr.indicator_sums(ind, cols_.with_prefix(ind.columns, "Missing_", "Tested_"))
    return s.withColumn("pct", _r(F.col("pct")))


@register("scatter_points", with_(PV_GRID) + """
SELECT series, t, round(power, 6) AS power, round(generation, 6) AS generation FROM pv_grid
WHERE power IS NOT NULL""")
def scatter_points(spark, sf_dir):
    """The paired (power, generation) points behind the scatter / line charts."""
    g = fx.pv_grid(spark, sf_dir).where(F.col("power").isNotNull())
    return g.select("series", "t", _r(F.col("power")).alias("power"), _r(F.col("generation")).alias("generation"))


@register("head_preview", """
SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice
FROM orders ORDER BY o_orderkey LIMIT 10""")
def head_preview(spark, sf_dir):
    """The first rows in key order (a limit is the feature here)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                              _r(F.col("o_totalprice")).alias("o_totalprice"))
    return o.orderBy("o_orderkey").limit(10)


@register("column_picks", """
SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem WHERE l_returnflag = 'R'""")
def column_picks(spark, sf_dir):
    """Positional slice between two named columns, substring pick,
    dropped id columns and the numeric-minus-excluded mask, combined into one
    projection over the rows kept by a mask."""
    li = table(spark, sf_dir, "lineitem")
    sliced = cols_.between(li.columns, "l_quantity", "l_tax")                     # P13
    picked = cols_.containing(li.columns, ["price", "discount", "tax", "quantity"])  # P14
    kept = [c for c in sliced if c in picked]
    numeric = cols_.scalable_columns(li.select(*kept), exclude=["l_orderkey"])    # P16 / U4
    return cols_.keep_all(li, [F.col("l_returnflag") == "R"]).select(*numeric)    # P17, P12
