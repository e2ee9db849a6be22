"""Association-mining queries over order baskets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import mining as mi
from ..session import cut_lineage
from ..sources import fixtures as fx
from .registry import register
from .sqlfix import order_items, with_

# Fixed parameters of the catalogue queries (the reference's defaults).
TYPE_SUPPORT, TYPE_MAX_LEN = 0.05, 3
BRAND_SUPPORT, BRAND_MAX_LEN = 0.12, 2
SWEEP = (0.05, 0.10, 0.15, 0.20, 0.25, 0.30)
OUTCOME_ITEM = "status=P"


def _r(c, n=6):
    return F.round(c, n)


def type_baskets(spark, sf_dir):
    """Baskets are read by every mining level: materialised once (reliable
    checkpoint) instead of re-running the lineitem x part join per level."""
    return cut_lineage(fx.order_baskets(spark, sf_dir, "p_type"))


def brand_baskets(spark, sf_dir):
    return cut_lineage(fx.order_baskets(spark, sf_dir, "p_brand"))


def type_itemsets(spark, sf_dir):
    return mi.apriori(type_baskets(spark, sf_dir), TYPE_SUPPORT, TYPE_MAX_LEN)


def type_rules(spark, sf_dir):
    return mi.association_rules(type_itemsets(spark, sf_dir), "lift", 1.0)


def base_sql(attr: str = "p_type") -> str:
    return with_(order_items(attr)) + """,
base AS (SELECT oid AS tid, item FROM order_items WHERE oid IN (SELECT oid FROM order_items GROUP BY oid HAVING count(*) >= 2)),
nb AS (SELECT count(DISTINCT tid) * 1.0 AS n FROM base)"""


def itemsets_sql(attr: str, support: float, max_len: int) -> str:
    parts = ["SELECT [item] AS items, count(*) AS cnt FROM base GROUP BY item"]
    if max_len >= 2:
        parts.append("SELECT [a.item, b.item] AS items, count(*) AS cnt FROM base a JOIN base b "
                     "ON a.tid = b.tid AND a.item < b.item GROUP BY a.item, b.item")
    if max_len >= 3:
        parts.append("SELECT [a.item, b.item, c.item] AS items, count(*) AS cnt FROM base a JOIN base b "
                     "ON a.tid = b.tid AND a.item < b.item JOIN base c ON c.tid = a.tid AND b.item < c.item "
                     "GROUP BY a.item, b.item, c.item")
    return base_sql(attr) + f""",
lall AS ({" UNION ALL ".join(parts)}),
fi AS (SELECT items, cnt AS count, cnt / n AS support, len(items) AS length FROM lall, nb WHERE cnt / n >= {support})"""


_SPLITS = """,
splits AS (
  SELECT items AS x, support AS s_x, [items[1]] AS ant, [items[2]] AS cons FROM fi WHERE length = 2
  UNION ALL SELECT items, support, [items[2]], [items[1]] FROM fi WHERE length = 2
  UNION ALL SELECT items, support, [items[1]], [items[2], items[3]] FROM fi WHERE length = 3
  UNION ALL SELECT items, support, [items[2]], [items[1], items[3]] FROM fi WHERE length = 3
  UNION ALL SELECT items, support, [items[3]], [items[1], items[2]] FROM fi WHERE length = 3
  UNION ALL SELECT items, support, [items[1], items[2]], [items[3]] FROM fi WHERE length = 3
  UNION ALL SELECT items, support, [items[1], items[3]], [items[2]] FROM fi WHERE length = 3
  UNION ALL SELECT items, support, [items[2], items[3]], [items[1]] FROM fi WHERE length = 3),
r0 AS (SELECT s.*, a.support AS s_a, c.support AS s_c FROM splits s JOIN fi a ON a.items = s.ant JOIN fi c ON c.items = s.cons),
rules AS (
  SELECT ant, cons, array_to_string(ant, ', ') || ' -> ' || array_to_string(cons, ', ') AS rule,
         s_a AS antecedent_support, s_c AS consequent_support, s_x AS support, s_x / s_a AS confidence,
         s_x / s_a / s_c AS lift, s_x - s_a * s_c AS leverage,
         CASE WHEN s_x / s_a >= 1.0 THEN 'inf'::DOUBLE ELSE (1 - s_c) / (1 - s_x / s_a) END AS conviction,
         CASE WHEN greatest(s_x * (1 - s_a), s_a * (s_c - s_x)) = 0 THEN 0.0
              ELSE (s_x - s_a * s_c) / greatest(s_x * (1 - s_a), s_a * (s_c - s_x)) END AS zhang
  FROM r0 WHERE s_x / s_a / s_c >= 1.0)"""

TYPE_FI_SQL = itemsets_sql("p_type", TYPE_SUPPORT, TYPE_MAX_LEN)
TYPE_RULES_SQL = TYPE_FI_SQL + _SPLITS
METRIC_COLS = ("antecedent_support", "consequent_support", "support", "confidence", "lift", "leverage",
               "conviction", "zhang")


@register("basket_build", base_sql() + """
SELECT tid, array_to_string(list_sort(list(item)), '|') AS items, count(*) AS size FROM base GROUP BY tid""")
def basket_build(spark, sf_dir):
    """One basket per order: distinct part types + the order-status outcome item."""
    b = fx.order_baskets(spark, sf_dir, "p_type")
    return b.select("tid", F.array_join("items", "|").alias("items"), "size")


@register("item_freq", base_sql() + """
SELECT item, count(*) AS n, round(count(*) * 100.0 / (SELECT n FROM nb), 6) AS pct FROM base GROUP BY item""")
def item_freq(spark, sf_dir):
    f = mi.item_frequency(fx.order_baskets(spark, sf_dir, "p_type"))
    return f.withColumn("pct", _r(F.col("pct")))


@register("basket_stats", base_sql() + """
SELECT count(*) AS baskets, round(avg(size), 6) AS mean_len, max(size) AS max_len,
       (SELECT count(DISTINCT item) FROM base) AS distinct_items
FROM (SELECT tid, count(*) AS size FROM base GROUP BY tid)""")
def basket_stats(spark, sf_dir):
    s = mi.basket_stats(fx.order_baskets(spark, sf_dir, "p_type"))
    return s.withColumn("mean_len", _r(F.col("mean_len")))


@register("itemsets_k3", TYPE_FI_SQL + """
SELECT array_to_string(items, ', ') AS itemset, count, round(support, 6) AS support, length FROM fi""")
def itemsets_k3(spark, sf_dir):
    """M1: Apriori, support >= 0.05, up to 3 items."""
    fi = type_itemsets(spark, sf_dir)
    return fi.select(F.concat_ws(", ", "items").alias("itemset"), "count", _r(F.col("support")).alias("support"),
                     "length")


@register("fpgrowth_brand", itemsets_sql("p_brand", BRAND_SUPPORT, BRAND_MAX_LEN) + """
SELECT array_to_string(items, ', ') AS itemset, count, round(support, 6) AS support, length FROM fi""")
def fpgrowth_brand(spark, sf_dir):
    """M2: Spark ML FP-Growth on brand baskets, support >= 0.12, up to 2 items."""
    fi = mi.fpgrowth(brand_baskets(spark, sf_dir), BRAND_SUPPORT, BRAND_MAX_LEN)
    return fi.select(F.concat_ws(", ", "items").alias("itemset"), "count", _r(F.col("support")).alias("support"),
                     "length")


@register("apriori_fpgrowth_parity", TYPE_FI_SQL + """
SELECT count(*) AS "left", count(*) AS "right", CAST(0 AS BIGINT) AS mismatches FROM fi""")
def apriori_fpgrowth_parity(spark, sf_dir):
    """M9: Apriori and FP-Growth must give identical itemsets and counts."""
    b = type_baskets(spark, sf_dir)
    return mi.parity(mi.apriori(b, TYPE_SUPPORT, TYPE_MAX_LEN), mi.fpgrowth(b, TYPE_SUPPORT, TYPE_MAX_LEN))


@register("rules_all_metrics", TYPE_RULES_SQL + """
SELECT rule, array_to_string(ant, ', ') AS antecedents, array_to_string(cons, ', ') AS consequents, """
          + ", ".join(f"round({c}, 6) AS {c}" for c in METRIC_COLS) + " FROM rules")
def rules_all_metrics(spark, sf_dir):
    """M4 + M5: all splits of frequent itemsets, lift >= 1, six metrics."""
    r = mi.rule_text(type_rules(spark, sf_dir))
    return r.select("rule", F.concat_ws(", ", "antecedents").alias("antecedents"),
                    F.concat_ws(", ", "consequents").alias("consequents"),
                    *[_r(F.col(c)).alias(c) for c in METRIC_COLS])


@register("rules_topk", TYPE_RULES_SQL + """
SELECT rule, round(lift, 6) AS lift, round(confidence, 6) AS confidence, round(support, 6) AS support
FROM rules ORDER BY lift DESC, confidence DESC, support DESC, rule LIMIT 20""")
def rules_topk(spark, sf_dir):
    """Top 20 rules by (lift, confidence, support), rule text breaks ties."""
    t = mi.top_rules(type_rules(spark, sf_dir), 20)
    return t.select("rule", *[_r(F.col(c)).alias(c) for c in ("lift", "confidence", "support")])


@register("rules_per_metric", TYPE_RULES_SQL + """,
long AS (SELECT rule, 'confidence' AS metric, confidence AS value FROM rules
         UNION ALL SELECT rule, 'lift', lift FROM rules
         UNION ALL SELECT rule, 'conviction', conviction FROM rules
         UNION ALL SELECT rule, 'leverage', leverage FROM rules)
SELECT metric, rule, round(value, 6) AS value, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY metric ORDER BY value DESC, rule) AS rank FROM long) WHERE rank <= 20""")
def rules_per_metric(spark, sf_dir):
    """T4: top 20 rules for each of confidence, lift, conviction, leverage."""
    t = mi.top_rules_per_metric(type_rules(spark, sf_dir), k=20)
    return t.select("metric", "rule", _r(F.col("value")).alias("value"), F.col("rank").cast("bigint").alias("rank"))


@register("rules_outcome", TYPE_RULES_SQL + f"""
SELECT rule, round(confidence, 6) AS confidence, round(lift, 6) AS lift FROM rules
WHERE list_contains(cons, '{OUTCOME_ITEM}')""")
def rules_outcome(spark, sf_dir):
    """M6: rules predicting the outcome item."""
    r = mi.rule_text(mi.outcome_rules(type_rules(spark, sf_dir), OUTCOME_ITEM))
    return r.select("rule", _r(F.col("confidence")).alias("confidence"), _r(F.col("lift")).alias("lift"))


EDGES_SQL = TYPE_RULES_SQL + """,
edges AS (SELECT s AS source, t AS target, max(lift) AS lift
          FROM (SELECT unnest(ant) AS s, cons, lift FROM rules), LATERAL (SELECT unnest(cons) AS t) GROUP BY 1, 2)"""


@register("rule_graph", EDGES_SQL + " SELECT source, target, round(lift, 6) AS lift FROM edges")
def rule_graph(spark, sf_dir):
    """M7: antecedent item -> consequent item edges weighted by lift."""
    e, _ = mi.rule_graph(type_rules(spark, sf_dir))
    return e.withColumn("lift", _r(F.col("lift")))


@register("rule_nodes", EDGES_SQL + " SELECT source AS node FROM edges UNION SELECT target FROM edges")
def rule_nodes(spark, sf_dir):
    """M7 nodes / U2."""
    _, n = mi.rule_graph(type_rules(spark, sf_dir))
    return n


@register("node_degree", EDGES_SQL + """
SELECT node, count(*) AS degree FROM (SELECT source AS node FROM edges UNION ALL SELECT target FROM edges)
GROUP BY node ORDER BY degree DESC, node LIMIT 15""")
def node_degree(spark, sf_dir):
    """A32 + T8: top 15 nodes by degree."""
    e, _ = mi.rule_graph(type_rules(spark, sf_dir))
    return mi.node_degree(e, 15)


@register("rule_matrix", TYPE_RULES_SQL + """,
rt AS (SELECT array_to_string(ant, ', ') AS ant, array_to_string(cons, ', ') AS cons, confidence FROM rules),
ta AS (SELECT ant FROM rt GROUP BY ant ORDER BY max(confidence) DESC, ant LIMIT 10),
tc AS (SELECT cons FROM rt GROUP BY cons ORDER BY max(confidence) DESC, cons LIMIT 10)
SELECT ant, cons, round(avg(confidence), 6) AS confidence FROM rt
WHERE ant IN (SELECT ant FROM ta) AND cons IN (SELECT cons FROM tc) GROUP BY ant, cons""")
def rule_matrix(spark, sf_dir):
    """Mean confidence for the top-10 antecedents x top-10 consequents."""
    m = mi.rule_matrix(type_rules(spark, sf_dir), 10)
    return m.withColumn("confidence", _r(F.col("confidence")))


@register("support_sweep", TYPE_RULES_SQL + ",\nth AS (SELECT unnest([" + ", ".join(str(t) for t in SWEEP)
          + """]) AS min_support)
SELECT min_support, (SELECT count(*) FROM fi WHERE support >= min_support) AS itemsets,
       (SELECT count(*) FROM rules WHERE support >= min_support) AS rules FROM th""")
def support_sweep(spark, sf_dir):
    """M8: itemset and rule counts for six support thresholds from one mining run."""
    fi = type_itemsets(spark, sf_dir)
    r = mi.association_rules(fi, "lift", 1.0)
    return mi.support_sweep(fi, r, SWEEP)


@register("itemset_lengths", TYPE_FI_SQL + " SELECT length, count(*) AS n FROM fi GROUP BY length")
def itemset_lengths(spark, sf_dir):
    """Itemsets per length."""
    return mi.length_distribution(type_itemsets(spark, sf_dir), F.col("length"))


@register("rule_lengths", TYPE_RULES_SQL + " SELECT len(ant) + len(cons) AS length, count(*) AS n FROM rules GROUP BY 1")
def rule_lengths(spark, sf_dir):
    """Rules per total length."""
    r = type_rules(spark, sf_dir)
    return mi.length_distribution(r, F.size("antecedents") + F.size("consequents"))


@register("metric_ranges", TYPE_RULES_SQL + " " + " UNION ALL ".join(
    f"SELECT '{m}' AS metric, round(min({m}), 6) AS min, round(max({m}), 6) AS max FROM rules"
    for m in ("support", "confidence", "lift")))
def metric_ranges(spark, sf_dir):
    """Min / max of support, confidence and lift."""
    m = mi.metric_ranges(type_rules(spark, sf_dir), ["support", "confidence", "lift"])
    return m.select("metric", _r(F.col("min")).alias("min"), _r(F.col("max")).alias("max"))


@register("top_itemsets", TYPE_FI_SQL + """
SELECT length, itemset, round(support, 6) AS support, rank FROM (
  SELECT length, array_to_string(items, ', ') AS itemset, support,
         row_number() OVER (PARTITION BY length ORDER BY support DESC, array_to_string(items, ', ')) AS rank FROM fi)
WHERE rank <= 5""")
def top_itemsets(spark, sf_dir):
    """T5: five most supported itemsets per length."""
    t = mi.top_itemsets_per_length(type_itemsets(spark, sf_dir), 5)
    return t.select("length", "itemset", _r(F.col("support")).alias("support"), F.col("rank").cast("bigint").alias("rank"))


@register("basket_lines", base_sql() + """
SELECT CAST(tid AS VARCHAR) || ': ' || array_to_string(list_sort(list(item)), ', ') AS line FROM base GROUP BY tid""")
def basket_lines(spark, sf_dir):
    """The text form of every basket ('tid: item, item')."""
    from ..sources.files import basket_line
    return fx.order_baskets(spark, sf_dir, "p_type").select(basket_line().alias("line"))


MODULE_SUPPORT, MODULE_MAX_LEN = 0.05, 2


def _module_sql() -> str:
    body = []
    for attr, mod in (("p_type", "type"), ("p_brand", "brand")):
        pre = "type" if attr == "p_type" else "brand"
        body.append(f"""
  SELECT '{mod}' AS module, l_orderkey AS tid, '{pre}=' || {attr} AS item FROM lineitem JOIN part ON l_partkey = p_partkey
  UNION SELECT '{mod}', o_orderkey, 'status=' || o_orderstatus FROM orders
  WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)""")
    return f"""WITH mi AS ({" UNION ALL ".join(body)}),
mb AS (SELECT * FROM mi WHERE (module, tid) IN (SELECT module, tid FROM mi GROUP BY ALL HAVING count(*) >= 2)),
nb AS (SELECT module, count(DISTINCT tid) * 1.0 AS n FROM mb GROUP BY module),
lall AS (SELECT module, [item] AS items, count(*) AS cnt FROM mb GROUP BY module, item
         UNION ALL SELECT a.module, [a.item, b.item], count(*) FROM mb a JOIN mb b
         ON a.module = b.module AND a.tid = b.tid AND a.item < b.item GROUP BY a.module, a.item, b.item),
fi AS (SELECT l.module, items, cnt / n AS support, len(items) AS length FROM lall l JOIN nb USING (module)
       WHERE cnt / n >= {MODULE_SUPPORT}),
sp AS (SELECT module, items AS x, support AS s_x, [items[1]] AS ant, [items[2]] AS cons FROM fi WHERE length = 2
       UNION ALL SELECT module, items, support, [items[2]], [items[1]] FROM fi WHERE length = 2),
r AS (SELECT sp.module, array_to_string(ant, ', ') || ' -> ' || array_to_string(cons, ', ') AS rule, s_x AS support,
             s_x / a.support AS confidence, s_x / a.support / c.support AS lift
      FROM sp JOIN fi a ON a.module = sp.module AND a.items = sp.ant JOIN fi c ON c.module = sp.module AND c.items = sp.cons)
SELECT module, rule, round(support, 6) AS support, round(confidence, 6) AS confidence, round(lift, 6) AS lift, rank
FROM (SELECT *, row_number() OVER (PARTITION BY module ORDER BY lift DESC, confidence DESC, support DESC, rule) AS rank
      FROM r WHERE lift >= 1.0) WHERE rank <= 20"""


@register("module_rules", _module_sql())
def module_rules(spark, sf_dir):
    """Baskets of two modules (part types, brands) mined in one grouped
    level-wise pass; top 20 rules per module by (lift, confidence, support)."""
    from ..operators.common import top_k
    t = fx.order_baskets(spark, sf_dir, "p_type").withColumn("module", F.lit("type"))
    b = fx.order_baskets(spark, sf_dir, "p_brand").withColumn("module", F.lit("brand"))
    bk = cut_lineage(t.unionByName(b))
    fi = mi.apriori(bk, MODULE_SUPPORT, MODULE_MAX_LEN, group="module")
    r = mi.rule_text(mi.association_rules(fi, "lift", 1.0, group="module"))
    top = top_k(r, ["module"], [F.col("lift").desc(), F.col("confidence").desc(), F.col("support").desc(),
                                F.col("rule")], 20, salt_on=["rule"])
    return top.select("module", "rule", *[_r(F.col(c)).alias(c) for c in ("support", "confidence", "lift")],
                      F.col("rank").cast("bigint").alias("rank"))


@register("onehot_item_sums", base_sql() + """
SELECT item, count(*) AS n FROM base GROUP BY item""")
def onehot_item_sums(spark, sf_dir):
    """Column sums of the one-hot baskets: the items' frequencies."""
    return mi.encoded_item_sums(*mi.encode_baskets(fx.order_baskets(spark, sf_dir, "p_type")))


@register("onehot_basket_sizes", base_sql() + """
SELECT tid, count(*)::INTEGER AS size FROM base GROUP BY tid""")
def onehot_basket_sizes(spark, sf_dir):
    """Row sums of the one-hot baskets: their sizes."""
    return mi.encoded_sizes(mi.encode_baskets(fx.order_baskets(spark, sf_dir, "p_type"))[1])
