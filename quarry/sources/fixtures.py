"""Derived inputs: the reference's data shapes rebuilt from the driver's tables.

The reference works on a PV time series, a clinical laboratory table with
tiered missingness, demographic / outcome tables, baskets of items, scores
with labels and feature vectors.  None of its inputs ship, so each shape is
derived deterministically from the driver tables here; its work grows with
those tables.  The same definitions exist as SQL CTEs in
``quarry.plans.oracle`` for the DuckDB cross-check.

Time is carried as epoch seconds (BIGINT, UTC) so that slot arithmetic stays
integer and identical in both engines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table

SLOT_SECONDS = 900          # 15-minute cadence of the PV series
DAY_SECONDS = 86400

# Fixed values of the stand-ins (chosen here, documented in FIXTURES.md).
LAB_NULL_PCT = {"quantity": 12, "price": 45, "discount": 70, "tax": 90}
LAB_FEATURES = ("quantity", "price", "discount", "tax", "ship_days")
SHIP_EPOCH = "1995-01-01"


def epoch_seconds(ts: Column) -> Column:
    """Whole epoch seconds of a TIMESTAMP_NTZ column, independent of the
    session time zone (difference of two zone-less timestamps; a cast to
    TIMESTAMP would shift by the session offset)."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def pv_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """15-minute grid per event type with ``power`` (gappy) and ``generation``.

    series x slot from the first to the last whole day of each series (W11).
    The raw events are pre-aggregated to one row per (series, slot) before the
    join, so a hot series only costs map-side combine work; the grid side is
    bounded by span / 15 min per series.
    power = mean value in the slot, NULL when empty or masked
    (slot % 11 < 2, or series 'error' between 03:00 and 04:00);
    generation = sum of values, 0 when empty.
    """
    from ..operators.timeseries import regular_grid
    ev = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("series"), epoch_seconds(F.col("ts")).alias("t"), "value")
    g = regular_grid(ev, "series", "t", SLOT_SECONDS, [F.avg("value").alias("p"), F.sum("value").alias("s")])
    masked = (F.col("slot") % 11 < 2) | ((F.col("series") == "error") & (F.floor((F.col("t") % DAY_SECONDS) / 3600) == 3))
    return g.select(
        "series", "t", "slot", "n",
        (F.col("t") / DAY_SECONDS).cast("bigint").alias("day"),
        (F.col("t") % DAY_SECONDS).alias("tod"),
        F.when(masked, F.lit(None).cast("double")).otherwise(F.col("p")).alias("power"),
        F.coalesce(F.col("s"), F.lit(0.0)).alias("generation"))


def lab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Laboratory-style table with tiered missingness, from ``lineitem``.

    rid identifies a row; group = l_returnflag; four features get NULLs by a
    deterministic row mask so that each missing-rate tier occurs.
    """
    li = table(spark, sf_dir, "lineitem")
    m = (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 100

    def masked(c: Column, name: str) -> Column:
        return F.when(m < LAB_NULL_PCT[name], F.lit(None).cast("double")).otherwise(c.cast("double")).alias(name)

    return li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("rid"),
        F.col("l_returnflag").alias("grp"),
        masked(F.col("l_quantity"), "quantity"),
        masked(F.col("l_extendedprice"), "price"),
        masked(F.col("l_discount"), "discount"),
        masked(F.col("l_tax"), "tax"),
        F.datediff(F.col("l_shipdate").cast("date"), F.lit(SHIP_EPOCH).cast("date")).cast("double").alias("ship_days"))


def demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demographic table: code, age band (market segment), gender (sign of balance)."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("code"),
        F.col("c_mktsegment").alias("age_band"),
        F.when(F.col("c_acctbal") >= 0, F.lit("Male")).otherwise(F.lit("Female")).alias("gender"),
        F.col("c_acctbal").alias("balance"))


def outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome table: one row per order, key = customer (repeats), label = status 'P'."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("oid"),
        F.col("o_custkey").alias("code"),
        (F.col("o_orderstatus") == "P").cast("int").alias("deceased"),
        F.col("o_totalprice").alias("total"),
        F.col("o_orderpriority").alias("priority"))


def order_items(spark: SparkSession, sf_dir: str, attr: str = "p_type") -> DataFrame:
    """(oid, item) rows: the distinct part attribute values of an order's lines
    plus one ``status=<o_orderstatus>`` outcome item per order."""
    prefix = {"p_type": "type", "p_brand": "brand"}[attr]
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("oid"), F.col("l_partkey").alias("pk"))
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("pk"), F.col(attr).alias("v"))
    lines = li.join(part, "pk").select("oid", F.concat(F.lit(prefix + "="), "v").alias("item"))
    status = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("oid"), F.concat(F.lit("status="), "o_orderstatus").alias("item"))
    # status rows only for orders that have lines (inner semantics of the basket)
    status = status.join(lines.select("oid").distinct(), "oid", "left_semi")
    return lines.unionByName(status).distinct()


def order_baskets(spark: SparkSession, sf_dir: str, attr: str = "p_type") -> DataFrame:
    """(tid, items sorted, size): the same baskets as ``order_items`` grouped,
    built as one aggregation per order (bounded by its line count) plus one
    join with ``orders`` on the key the aggregate is already partitioned by."""
    prefix = {"p_type": "type", "p_brand": "brand"}[attr]
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("oid"), F.col("l_partkey").alias("pk"))
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("pk"), F.col(attr).alias("v"))
    per_order = li.join(part, "pk").groupBy("oid").agg(
        F.collect_set(F.concat(F.lit(prefix + "="), "v")).alias("its"))
    status = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("oid"), F.concat(F.lit("status="), "o_orderstatus").alias("st"))
    b = per_order.join(status, "oid").select(
        F.col("oid").alias("tid"), F.array_sort(F.array_union("its", F.array("st"))).alias("items"))
    return b.withColumn("size", F.size("items")).where(F.col("size") >= 2)


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, y, score): quality label against document length."""
    lab_ = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("y"))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").cast("double").alias("score"))
    return lab_.join(docs, "doc_id")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, v array<double>, label)."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("v"), "label")


def mixed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixed-content lab result text (blank / 'Negative' / junk / numbers)."""
    r = F.col("event_id") % 5
    txt = (F.when(r == 0, F.lit(None).cast("string"))
           .when(r == 1, F.lit("Negative"))
           .when(r == 2, F.lit(" negative "))
           .when(r == 3, F.lit("x"))
           .otherwise(F.col("value").cast("string")))
    return table(spark, sf_dir, "events").select("event_id", txt.alias("troponin"))


def scale_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices with injected order-of-magnitude errors (x1000 on ~0.3 % of rows)."""
    li = table(spark, sf_dir, "lineitem")
    hit = (F.col("l_orderkey") * 31 + F.col("l_linenumber") * 17 + F.col("l_partkey")) % 1000 < 3
    return li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("rid"),
        F.when(hit, F.col("l_extendedprice") * 1000).otherwise(F.col("l_extendedprice")).alias("price"),
        F.col("l_quantity").alias("quantity"))
