"""Frequent itemsets and association rules.

A basket is a row with its items.  Apriori works in the row: baskets are cut to
the frequent items, each makes its sets of the next length from its own frequent
sets, and only the sets' counts are shuffled, one exchange a level.  Per basket
this makes at most C(|L1|, k) sets, a constant fixed by the support and the
length, not by the data size.

Support is ``count / N`` compared as a double, like the reference.  Rules use
every antecedent / consequent split of each frequent itemset (Spark's own
``associationRules`` only emits single-item consequents), enumerated by bit
masks inside the JVM; itemset supports are looked up by array-keyed joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import join_small, top_k

RULE_METRICS = ("support", "confidence", "lift", "leverage", "conviction", "zhang")


# ---------------------------------------------------------------- baskets

def baskets(items: DataFrame, tid: str = "tid", item: str = "item", min_items: int = 2) -> DataFrame:
    """One row per basket ``(tid, items sorted, size)``; baskets with fewer
    than ``min_items`` items are dropped (the reference keeps >= 2)."""
    b = items.where(F.col(item).isNotNull()).groupBy(tid).agg(F.array_sort(F.collect_set(item)).alias("items"))
    return b.withColumn("size", F.size("items")).where(F.col("size") >= min_items)


def basket_items(b: DataFrame, tid: str = "tid") -> DataFrame:
    """Long form (tid, item) of a basket table."""
    return b.select(tid, F.explode("items").alias("item"))


def _item_counts(b: DataFrame) -> DataFrame:
    """(item, n, mean_len, max_len): baskets per item, and in the row of the
    null item all baskets and their lengths; the baskets are read once and this
    table, a row per item, is kept."""
    every = b.select("size", F.explode(F.concat("items", F.array(F.lit(None).cast("string")))).alias("item"))
    return cut_lineage(every.groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.avg("size").alias("mean_len"),
                                                 F.max("size").alias("max_len")))


def item_frequency(b: DataFrame) -> DataFrame:
    """Count per item and percent of baskets."""
    counts = _item_counts(b)
    n = counts.where("item IS NULL").select("n").first()
    return counts.where("item IS NOT NULL").select("item", "n", (F.col("n") * 100.0 / F.lit(n[0] if n else 1)).alias("pct"))


def basket_stats(b: DataFrame) -> DataFrame:
    """Number of baskets, mean / max length, distinct items."""
    whole = F.col("item").isNull()
    return _item_counts(b).agg(
        F.coalesce(F.max(F.when(whole, F.col("n"))), F.lit(0)).alias("baskets"),
        F.max(F.when(whole, F.col("mean_len"))).alias("mean_len"), F.max(F.when(whole, F.col("max_len"))).alias("max_len"),
        F.count("item").alias("distinct_items"))


def adaptive_min_support(n_baskets: int) -> tuple[float, float]:
    """M3: max(.05, 10/N) and the fallback max(.01, 5/N)."""
    n = max(n_baskets, 1)
    return max(0.05, 10.0 / n), max(0.01, 5.0 / n)


# ---------------------------------------------------------------- itemsets

def apriori(b: DataFrame, min_support: float, max_len: int = 3, tid: str = "tid",
            n_baskets: int | None = None, group: str | None = None) -> DataFrame:
    """M1 (and M10 with ``group``): frequent itemsets
    ``([group,] items array<string> sorted, count, support, length)``.

    A basket stays one row: its items are cut to the frequent ones, its sets of
    the next length are made in the row from its frequent sets, and only their
    counts are shuffled, once per level.  With ``group`` every key gains the
    group column and support is relative to the group's basket count, so
    several modules are mined in the same pass.  A level's frequent sets (a
    number set by ``min_support`` and the basket length, not by the data) go
    back to the baskets as one array per group."""
    g = [group] if group else []
    if group:
        n_tab = cut_lineage(b.groupBy(group).agg(F.count(F.lit(1)).cast("double").alias("_n")))
        n = F.col("_n")

        def with_n(df: DataFrame) -> DataFrame:
            return join_small(df, n_tab, [group])
    else:
        n = F.lit(float(n_baskets if n_baskets is not None else b.count()))

        def with_n(df: DataFrame) -> DataFrame:
            return df

    def keep(df: DataFrame, sets: Column, frequent: DataFrame, value: str) -> DataFrame:
        """``sets`` without what is not frequent."""
        known = F.collect_list(value)
        if group:
            df = join_small(df, cut_lineage(frequent.groupBy(group).agg(known.alias("_known"))), [group])
            return df.withColumn("_sets", F.array_intersect(sets, "_known")).drop("_known")
        return df.withColumn("_sets", F.array_intersect(sets, frequent.select(known).scalar()))

    def count(df: DataFrame, value: str) -> DataFrame:
        # explode_outer: explode would add a filter that evaluates the sets again
        found = df.select(*g, F.explode_outer("_sets").alias(value)).where(F.col(value).isNotNull())
        return cut_lineage(with_n(found.groupBy(*g, value).agg(F.count(F.lit(1)).alias("count")))
                           .where(F.col("count") / n >= min_support).select(*g, value, "count"))

    rows = b.select(*g, F.col("items").alias("_sets"))
    l1 = count(rows, "item")
    rows = keep(rows, F.col("_sets"), l1, "item").withColumnRenamed("_sets", "_items")
    rows = rows.withColumn("_sets", F.transform("_items", lambda x: F.array(x)))
    levels = [l1.select(*g, F.array("item").alias("items"), "count")]
    for k in range(2, max_len + 1):
        longer = F.flatten(F.transform("_sets", lambda s: F.transform(
            F.filter("_items", lambda y: y > F.element_at(s, -1)), lambda y: F.concat(s, F.array(y)))))
        rows = rows.withColumn("_sets", F.when(F.size("_items") >= k, longer).otherwise(F.slice("_sets", 1, 0)))
        levels.append(count(rows, "items"))
        if k < max_len:
            rows = keep(rows, F.col("_sets"), levels[-1], "items")
    out = levels[0]
    for lk in levels[1:]:
        out = out.unionByName(lk)
    return with_n(out).select(*g, "items", "count", (F.col("count") / n).alias("support"),
                              F.size("items").alias("length"))


def adaptive_itemsets(b: DataFrame, max_len: int = 3) -> DataFrame:
    """M3: Apriori at the adaptive support, run again at the fallback support
    if it finds no set of two or more items."""
    n = b.count()
    first, second = adaptive_min_support(n)
    out = apriori(b, first, max_len, n_baskets=n)
    return out if not out.where("length >= 2").isEmpty() else apriori(b, second, max_len, n_baskets=n)


def strong_rules(r: DataFrame, min_lift: float = 1.2, min_support: float = 0.05) -> DataFrame:
    """Rules by lift and support."""
    return r.where((F.col("lift") >= min_lift) & (F.col("support") >= min_support))


def top_itemsets(fi: DataFrame, k: int = 20) -> DataFrame:
    """T5: the ``k`` itemsets of highest support over all lengths."""
    t = fi.withColumn("itemset", F.concat_ws(", ", "items"))
    return t.orderBy(F.col("support").desc(), "itemset").limit(k)


def fpgrowth(b: DataFrame, min_support: float, max_len: int | None = None) -> DataFrame:
    """M2: Spark ML FP-Growth (parallel FP-growth), same output layout as
    ``apriori``; ``max_len`` is applied afterwards (FPGrowth has no such knob,
    so prefer ``apriori`` for low supports)."""
    from pyspark.ml.fpm import FPGrowth
    n = float(b.count())
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=1.0).fit(b.select("items"))
    fi = model.freqItemsets.select(F.array_sort("items").alias("items"), F.col("freq").alias("count"))
    fi = fi.where(F.col("count") / n >= min_support)
    if max_len:
        fi = fi.where(F.size("items") <= max_len)
    return fi.select("items", "count", (F.col("count") / n).alias("support"), F.size("items").alias("length"))


# ---------------------------------------------------------------- rules

def _proper_subsets(items: Column) -> Column:
    """All non-empty proper subsets of a (short) array, by bit mask."""
    n = F.size(items)
    masks = F.sequence(F.lit(1), (F.pow(F.lit(2), n) - 2).cast("int"))
    return F.transform(masks, lambda m: F.filter(items, lambda _x, i: F.floor(m / F.pow(F.lit(2), i)) % 2 == 1))


def association_rules(itemsets: DataFrame, metric: str = "lift", min_threshold: float = 1.0,
                      group: str | None = None) -> DataFrame:
    """M4: every split A -> C of every frequent itemset X (|X| >= 2):
    support = s(X); confidence = s(X)/s(A); lift = confidence/s(C);
    leverage = s(X) - s(A)s(C); conviction = (1 - s(C))/(1 - confidence)
    (infinite when confidence = 1); Zhang = leverage /
    max(s(X)(1 - s(A)), s(A)(s(C) - s(X))) (0 when that is 0).
    Kept when ``metric >= min_threshold``; ``group`` keeps modules apart."""
    g = [group] if group else []
    sup = itemsets.select(*g, "items", "support")
    x = itemsets.where(F.col("length") >= 2).select(*g, F.col("items").alias("x"), F.col("support").alias("s_x"))
    splits = x.select(*g, "x", "s_x", F.explode(_proper_subsets(F.col("x"))).alias("ant")) \
              .withColumn("cons", F.array_except("x", "ant"))
    r = (splits.join(sup.select(*g, F.col("items").alias("ant"), F.col("support").alias("s_a")), [*g, "ant"])
         .join(sup.select(*g, F.col("items").alias("cons"), F.col("support").alias("s_c")), [*g, "cons"]))
    conf = F.col("s_x") / F.col("s_a")
    lev = F.col("s_x") - F.col("s_a") * F.col("s_c")
    den = F.greatest(F.col("s_x") * (1 - F.col("s_a")), F.col("s_a") * (F.col("s_c") - F.col("s_x")))
    out = r.select(
        *g, F.col("ant").alias("antecedents"), F.col("cons").alias("consequents"),
        F.col("s_a").alias("antecedent_support"), F.col("s_c").alias("consequent_support"),
        F.col("s_x").alias("support"), conf.alias("confidence"), (conf / F.col("s_c")).alias("lift"),
        lev.alias("leverage"),
        F.when(conf >= 1.0, F.lit(float("inf"))).otherwise((1 - F.col("s_c")) / (1 - conf)).alias("conviction"),
        F.when(den == 0, F.lit(0.0)).otherwise(lev / den).alias("zhang"))
    return out.where(F.col(metric) >= min_threshold)


def rule_text(r: DataFrame) -> DataFrame:
    """M5: human-readable rule 'a, b -> c' plus lengths."""
    return r.withColumn("rule", F.concat(F.concat_ws(", ", "antecedents"), F.lit(" -> "),
                                         F.concat_ws(", ", "consequents"))) \
            .withColumn("rule_length", F.size("antecedents") + F.size("consequents"))


def top_rules(r: DataFrame, k: int = 20) -> DataFrame:
    """Top ``k`` by (lift, confidence, support) desc, rule text as tie-break."""
    rt = rule_text(r) if "rule" not in r.columns else r
    return rt.orderBy(F.col("lift").desc(), F.col("confidence").desc(), F.col("support").desc(),
                      F.col("rule")).limit(k)


def top_rules_per_metric(r: DataFrame, metrics: Sequence[str] = ("confidence", "lift", "conviction", "leverage"),
                         k: int = 20) -> DataFrame:
    """T4: top ``k`` rules for each metric (unpivoted metric, rank per metric)."""
    rt = rule_text(r)
    long = rt.select("rule", *[F.col(m).cast("double").alias(m) for m in metrics]) \
             .unpivot(["rule"], list(metrics), "metric", "value")
    return top_k(long, ["metric"], [F.col("value").desc(), F.col("rule")], k, salt_on=["rule"])


def top_itemsets_per_length(fi: DataFrame, k: int = 5) -> DataFrame:
    """T5: top ``k`` itemsets by support for each length (ties by item text)."""
    t = fi.withColumn("itemset", F.concat_ws(", ", "items"))
    return top_k(t, ["length"], [F.col("support").desc(), F.col("itemset")], k, salt_on=["itemset"])


def outcome_rules(r: DataFrame, item: str, side: str = "consequents") -> DataFrame:
    """Rules whose consequent (or antecedent) contains ``item``."""
    return r.where(F.array_contains(side, item))


def rule_graph(r: DataFrame, weight: str = "lift") -> tuple[DataFrame, DataFrame]:
    """M7: edges (source, target, weight) between every antecedent item and
    every consequent item (max weight over rules), and the distinct nodes."""
    e = (r.select(F.explode("antecedents").alias("source"), "consequents", weight)
         .select("source", F.explode("consequents").alias("target"), weight)
         .groupBy("source", "target").agg(F.max(weight).alias(weight)))
    nodes = e.select(F.col("source").alias("node")).union(e.select(F.col("target").alias("node"))).distinct()
    return e, nodes


def node_degree(edges: DataFrame, k: int | None = 15) -> DataFrame:
    """A32 + T8: occurrences of each node over the edges, top ``k``."""
    d = (edges.select(F.explode(F.array("source", "target")).alias("node"))
         .groupBy("node").agg(F.count(F.lit(1)).alias("degree")))
    return d.orderBy(F.col("degree").desc(), F.col("node")).limit(k) if k else d


def rule_matrix(r: DataFrame, k: int = 10) -> DataFrame:
    """Mean confidence per (antecedent text, consequent text) for the top
    ``k`` antecedents and consequents, chosen by their best confidence then by
    text (trap B16: the reference took them from an unordered set)."""
    rt = r.select(F.concat_ws(", ", "antecedents").alias("ant"), F.concat_ws(", ", "consequents").alias("cons"),
                  "confidence")
    top_a = (rt.groupBy("ant").agg(F.max("confidence").alias("m"))
             .orderBy(F.col("m").desc(), F.col("ant")).limit(k).select("ant"))
    top_c = (rt.groupBy("cons").agg(F.max("confidence").alias("m"))
             .orderBy(F.col("m").desc(), F.col("cons")).limit(k).select("cons"))
    return (rt.join(top_a, "ant", "left_semi").join(top_c, "cons", "left_semi")
            .groupBy("ant", "cons").agg(F.avg("confidence").alias("confidence")))


def support_sweep(fi: DataFrame, rules: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """M8: itemsets and rules per support threshold, from one mining run at the
    lowest threshold.  Rules of a higher threshold are those whose itemset
    support clears it (every subset then clears it too: anti-monotonicity).
    One conditional count per threshold, unpivoted, joined on the threshold."""
    names = [f"t{i}" for i in range(len(thresholds))]

    def counts(df: DataFrame, label: str) -> DataFrame:
        one = df.agg(*[F.count_if(F.col("support") >= t).alias(n) for n, t in zip(names, thresholds)])
        return one.select(F.explode(F.array(*[
            F.struct(F.lit(float(t)).alias("min_support"), F.col(n).alias(label))
            for n, t in zip(names, thresholds)])).alias("r")).select("r.*")

    return counts(fi, "itemsets").join(counts(rules, "rules"), "min_support")


def parity(a: DataFrame, b: DataFrame) -> DataFrame:
    """M9: full outer join of two itemset tables on the items: sizes and the
    number of itemsets missing on either side or with different counts."""
    j = a.select("items", F.col("count").alias("ca")).join(
        b.select("items", F.col("count").alias("cb")), "items", "full_outer")
    return j.agg(F.count("ca").alias("left"), F.count("cb").alias("right"),
                 F.count_if(F.col("ca").isNull() | F.col("cb").isNull() | (F.col("ca") != F.col("cb")))
                 .alias("mismatches"))


def length_distribution(df: DataFrame, col: Column, name: str = "length") -> DataFrame:
    """Count per itemset / rule length."""
    return df.groupBy(col.alias(name)).agg(F.count(F.lit(1)).alias("n"))


def metric_ranges(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Min and max per metric, long form."""
    one = df.agg(*[F.struct(F.min(m).cast("double").alias("mn"), F.max(m).cast("double").alias("mx")).alias(m)
                   for m in metrics])
    return one.unpivot([], list(metrics), "metric", "r").select("metric", F.col("r.mn").alias("min"),
                                                                 F.col("r.mx").alias("max"))


__all__ = ["baskets", "item_frequency", "basket_stats", "apriori", "fpgrowth", "association_rules",
           "rule_text", "top_rules", "top_rules_per_metric", "top_itemsets_per_length", "outcome_rules",
           "rule_graph", "node_degree", "rule_matrix", "support_sweep", "parity", "length_distribution",
           "metric_ranges", "adaptive_min_support", "Window"]


# ---------------------------------------------------------------- encoded baskets

def encode_baskets(baskets: DataFrame, items: str = "items", vocabulary: int = 1 << 18):
    """(model, rows with ``encoded``): one sparse 0/1 vector per basket, the
    items in the order of their frequency; at most ``vocabulary`` items, an
    error beyond (nothing is left out in silence)."""
    from pyspark.ml.feature import CountVectorizer
    model = CountVectorizer(inputCol=items, outputCol="encoded", binary=True, vocabSize=vocabulary).fit(baskets)
    if len(model.vocabulary) == vocabulary:
        raise ValueError(f"{vocabulary} items or more")
    return model, model.transform(baskets)


def encoded_item_sums(model, encoded: DataFrame) -> DataFrame:
    """(item, n): column sums of the encoded baskets, added up sparsely."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.stat import Summarizer
    total = encoded.select(vector_to_array(Summarizer.sum(F.col("encoded"))).alias("s"))
    names = F.array(*[F.lit(i) for i in model.vocabulary])
    rows = total.select(F.explode(F.arrays_zip(names.alias("item"), F.col("s").alias("n"))).alias("r"))
    return rows.select("r.item", F.col("r.n").cast("long").alias("n"))


def encoded_sizes(encoded: DataFrame, key: str = "tid") -> DataFrame:
    """(key, size): row sums of the encoded baskets."""
    from pyspark.ml.functions import vector_to_array
    ones = F.aggregate(vector_to_array("encoded"), F.lit(0.0), lambda s, x: s + x)
    return encoded.select(key, ones.cast("int").alias("size"))
