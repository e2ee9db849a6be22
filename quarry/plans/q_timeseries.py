"""Time-series queries: grid availability, fills, sliding windows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import timeseries as ts
from ..session import cut_lineage
from ..sources import fixtures as fx
from ..sources.tables import table
from .registry import register
from .sqlfix import PV_GRID, with_

R6 = 6


def _r(c, n=R6):
    return F.round(c, n)


def filled_grid(spark, sf_dir):
    """pv_grid with W6 fills of power and generation, materialised once: the
    window queries read it from several branches, and the grid is bounded by
    series x slots however many raw events feed it."""
    g = fx.pv_grid(spark, sf_dir)
    g = ts.tod_mean_fill(g, "power")
    return cut_lineage(ts.tod_mean_fill(g, "generation"))


FILL_SQL = """,
filled AS (
  SELECT *, coalesce(power, avg(power) OVER (PARTITION BY series, tod ORDER BY t
              RANGE BETWEEN 1296000 PRECEDING AND 1296000 FOLLOWING)) AS power_filled,
            coalesce(generation, avg(generation) OVER (PARTITION BY series, tod ORDER BY t
              RANGE BETWEEN 1296000 PRECEDING AND 1296000 FOLLOWING)) AS generation_filled
  FROM pv_grid)"""


@register("grid_availability", with_(PV_GRID) + """
SELECT power IS NOT NULL AS power_present, generation IS NOT NULL AS generation_present,
       count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM pv_grid), 6) AS pct
FROM pv_grid GROUP BY ALL""")
def grid_availability(spark, sf_dir):
    m = ts.availability_matrix(fx.pv_grid(spark, sf_dir), "power", "generation")
    return m.withColumn("pct", _r(F.col("pct")))


@register("missing_timeline", with_(PV_GRID) + """
SELECT series, t, CAST(power IS NULL AS INTEGER) AS power_missing FROM pv_grid""")
def missing_timeline(spark, sf_dir):
    return ts.missing_indicator(fx.pv_grid(spark, sf_dir), "power")


@register("daily_missing_ratio", with_(PV_GRID) + """
SELECT series, CAST(DATE '1970-01-01' + CAST(day AS INTEGER) AS VARCHAR) AS date,
       round(avg(CASE WHEN power IS NULL THEN 1.0 ELSE 0.0 END), 6) AS power_missing_ratio,
       count(*) AS slots
FROM pv_grid GROUP BY ALL""")
def daily_missing_ratio(spark, sf_dir):
    d = ts.daily_missing_ratio(fx.pv_grid(spark, sf_dir), ["power"])
    return d.select("series", F.col("date").cast("string").alias("date"),
                    _r(F.col("power_missing_ratio")).alias("power_missing_ratio"), "slots")


@register("daily_fill_ratio", with_(PV_GRID) + FILL_SQL + """
SELECT series, CAST(DATE '1970-01-01' + CAST(day AS INTEGER) AS VARCHAR) AS date,
       round(avg(CASE WHEN power IS NULL THEN 1.0 ELSE 0.0 END), 6) AS missing_before,
       round(avg(CASE WHEN power_filled IS NULL THEN 1.0 ELSE 0.0 END), 6) AS missing_after,
       count(*) AS slots
FROM filled GROUP BY ALL""")
def daily_fill_ratio(spark, sf_dir):
    """Slice 0: grid -> null share per day before and after the same-time-of-day fill."""
    g = ts.tod_mean_fill(fx.pv_grid(spark, sf_dir), "power")
    d = ts.daily_missing_ratio(g, ["power", "power_filled"])
    return d.select("series", F.col("date").cast("string").alias("date"),
                    _r(F.col("power_missing_ratio")).alias("missing_before"),
                    _r(F.col("power_filled_missing_ratio")).alias("missing_after"), "slots")


@register("tod_mean_fill", with_(PV_GRID) + FILL_SQL + """
SELECT series, t, round(power, 6) AS power, round(power_filled, 6) AS power_filled FROM filled""")
def tod_mean_fill(spark, sf_dir):
    g = ts.tod_mean_fill(fx.pv_grid(spark, sf_dir), "power")
    return g.select("series", "t", _r(F.col("power")).alias("power"), _r(F.col("power_filled")).alias("power_filled"))


PERIODIC_SQL = """,
per AS (
  SELECT *, count(*) OVER w AS n_all, count(power_filled) OVER w AS n_val, avg(power_filled) OVER w AS m
  FROM filled
  WINDOW w AS (PARTITION BY series, tod ORDER BY t RANGE BETWEEN 1296000 PRECEDING AND 86400 PRECEDING)),
periodic AS (
  SELECT *, CASE WHEN n_all = 0 THEN 0.0 WHEN n_val < n_all THEN NULL ELSE m END AS periodic FROM per)"""


@register("periodic_feature", with_(PV_GRID) + FILL_SQL + PERIODIC_SQL + """
SELECT series, t, round(periodic, 6) AS periodic FROM periodic""")
def periodic_feature(spark, sf_dir):
    g = ts.periodic_feature(filled_grid(spark, sf_dir), "power_filled")
    return g.select("series", "t", _r(F.col("periodic")).alias("periodic"))


def _win_sql(value_expr: str, src: str = "filled") -> str:
    """Long-form windows of the three configurations (w, step) in DuckDB."""
    parts = []
    for w, s in ts.WINDOW_CONFIGS:
        parts.append(f"""
  SELECT series, {w} AS w, {s} AS step, k, slot - k * {s} AS j, {value_expr} AS v
  FROM {src}, LATERAL (SELECT unnest(range(
      CAST(greatest(ceil((slot - {w} + 1) / {s}), 0) AS BIGINT),
      CAST(least(floor(slot / {s}), floor((n - {w} - 1) / {s})) AS BIGINT) + 1)) AS k)""")
    return " UNION ALL ".join(parts)


SW_SQL = """,
win AS (""" + _win_sql("power_filled") + ")"


@register("sliding_windows", with_(PV_GRID) + FILL_SQL + SW_SQL + """
SELECT series, w, step, k, j, round(v, 6) AS power_filled FROM win""")
def sliding_windows(spark, sf_dir):
    win = ts.sliding_windows(filled_grid(spark, sf_dir), ["power_filled"])
    return win.select("series", "w", "step", "k", "j", _r(F.col("power_filled")).alias("power_filled"))


GAP_SQL = """,
nb AS (
  SELECT *, last_value(v IGNORE NULLS) OVER (PARTITION BY series, w, step, k ORDER BY j
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
            last_value(CASE WHEN v IS NOT NULL THEN j END IGNORE NULLS) OVER (PARTITION BY series, w, step, k ORDER BY j
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pj,
            first_value(v IGNORE NULLS) OVER (PARTITION BY series, w, step, k ORDER BY j
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv,
            first_value(CASE WHEN v IS NOT NULL THEN j END IGNORE NULLS) OVER (PARTITION BY series, w, step, k ORDER BY j
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nj,
            count(v) OVER (PARTITION BY series, w, step, k) AS has
  FROM win),
gap AS (
  SELECT series, w, step, k, j,
         CASE WHEN v IS NOT NULL THEN v WHEN pv IS NULL THEN nv WHEN nv IS NULL THEN pv
              ELSE pv + (nv - pv) * (j - pj) / (nj - pj) END AS v
  FROM nb WHERE has > 0)"""


@register("window_gap_fill", with_(PV_GRID) + """,
filled AS (SELECT *, power AS power_filled FROM pv_grid)""" + SW_SQL + GAP_SQL + """
SELECT series, w, step, k, j, round(v, 6) AS power FROM gap""")
def window_gap_fill(spark, sf_dir):
    """W1-W5 on the raw (unfilled) power: interpolate inside windows, drop empty ones."""
    g = fx.pv_grid(spark, sf_dir)
    win = ts.window_gap_fill(ts.sliding_windows(g, ["power"]), "power")
    return win.select("series", "w", "step", "k", "j", _r(F.col("power")).alias("power"))


@register("trend_period_windows", with_(PV_GRID) + FILL_SQL + PERIODIC_SQL + SW_SQL + GAP_SQL + """,
ends AS (
  SELECT g.series, g.w, g.step, g.k, p.periodic
  FROM (SELECT DISTINCT series, w, step, k FROM gap) g
  JOIN periodic p ON p.series = g.series AND p.slot = g.k * g.step + g.w - 1
  WHERE p.periodic IS NOT NULL)
SELECT g.series, g.w, g.step, g.k, g.j, round(g.v, 6) AS value FROM gap g
  JOIN ends e ON g.series = e.series AND g.w = e.w AND g.step = e.step AND g.k = e.k
UNION ALL
SELECT series, w, step, k, w AS j, round(periodic, 6) AS value FROM ends""")
def trend_period_windows(spark, sf_dir):
    """Gap-filled window of power_filled ++ periodic feature at the window end;
    windows whose feature is NULL are dropped (trap B6: aligned by k, not position)."""
    g = ts.periodic_feature(filled_grid(spark, sf_dir), "power_filled")
    win = ts.window_gap_fill(ts.sliding_windows(g, ["power_filled", "periodic"]), "power_filled")
    keys = ["series", "w", "step", "k"]
    last = F.col("j") == F.col("w") - 1
    win = win.withColumn("_end", F.max(F.when(last, F.col("periodic"))).over(Window.partitionBy(*keys)))
    body = F.struct("j", F.col("power_filled").alias("value"))
    tail = F.struct(F.col("w").cast("long").alias("j"), F.col("_end").alias("value"))
    rows = F.when(last, F.array(body, tail)).otherwise(F.array(body))
    win = win.where(F.col("_end").isNotNull()).select(*keys, F.explode(rows).alias("_r"))
    return win.select(*keys, "_r.j", _r(F.col("_r.value")).alias("value"))


def _around(v: str) -> str:
    """What a gap of column ``v`` is filled from, within its window."""
    at = f"CASE WHEN {v} IS NOT NULL THEN j END"
    return f"""
            last_value({v} IGNORE NULLS) OVER before AS p{v}, last_value({at} IGNORE NULLS) OVER before AS pj{v},
            first_value({v} IGNORE NULLS) OVER after AS n{v}, first_value({at} IGNORE NULLS) OVER after AS nj{v},
            count({v}) OVER whole AS has{v}"""


def _gap(v: str) -> str:
    return (f"CASE WHEN {v} IS NOT NULL THEN {v} WHEN p{v} IS NULL THEN n{v} WHEN n{v} IS NULL THEN p{v} "
            f"ELSE p{v} + (n{v} - p{v}) * (j - pj{v}) / (nj{v} - pj{v}) END")


@register("joint_windows", with_(PV_GRID) + FILL_SQL + """,
win AS MATERIALIZED (""" + _win_sql("power_filled AS a, generation_filled").replace("AS v", "AS b") + """),
nb AS MATERIALIZED (
  SELECT *, """ + _around("a") + ", " + _around("b") + """
  FROM win
  WINDOW before AS (PARTITION BY series, w, step, k ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         after AS (PARTITION BY series, w, step, k ORDER BY j ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
         whole AS (PARTITION BY series, w, step, k)),
both_filled AS MATERIALIZED (
  SELECT series, w, step, k, j, """ + _gap("a") + " AS a, " + _gap("b") + """ AS b FROM nb WHERE hasa > 0 AND hasb > 0)
SELECT series, w, step, k, j, round(a, 6) AS value FROM both_filled
UNION ALL SELECT series, w, step, k, j + w AS j, round(b, 6) AS value FROM both_filled""")
def joint_windows(spark, sf_dir):
    """Power window ++ generation window, each gap-filled on its own, joined on
    the window key (trap B7: not zipped by position).  Generation occupies j in
    [w, 2w).  Both values go through one window group."""
    keys = ["series", "w", "step", "k"]
    win = ts.sliding_windows(filled_grid(spark, sf_dir), ["power_filled", "generation_filled"])
    win = ts.window_gap_fill(ts.window_gap_fill(win, "power_filled"), "generation_filled")
    rows = F.array(F.struct("j", F.col("power_filled").alias("value")),
                   F.struct((F.col("j") + F.col("w")).alias("j"), F.col("generation_filled").alias("value")))
    win = win.select(*keys, F.explode(rows).alias("_r"))
    return win.select(*keys, "_r.j", _r(F.col("_r.value")).alias("value"))


# Six half-open slices, in the spirit of the reference's H1/H2/year/month/day cuts,
# placed on the events month and on the orders years.
EVENT_SLICES = (("week1", "2024-01-01", "2024-01-08"), ("week2", "2024-01-08", "2024-01-15"),
                ("mid_month", "2024-01-10", "2024-01-20"), ("day_15", "2024-01-15", "2024-01-16"))
ORDER_SLICES = (("h2_1996", "1996-07-01", "1997-01-01"), ("h1_1997", "1997-01-01", "1997-07-01"),
                ("y1998", "1998-01-01", "1999-01-01"))


def _slice_sql(tab, col, slices):
    return " UNION ALL ".join(
        f"SELECT '{tab}' AS tab, '{n}' AS slice, count(*) AS n FROM {tab} "
        f"WHERE {col} >= TIMESTAMP '{a}' AND {col} < TIMESTAMP '{b}'" for n, a, b in slices)


@register("time_slice_counts", _slice_sql("events", "ts", EVENT_SLICES) + " UNION ALL "
          + _slice_sql("orders", "o_orderdate", ORDER_SLICES))
def time_slice_counts(spark, sf_dir):
    """P11 + A1: row counts of half-open time slices; one pushed-down scan per table."""
    ev = ts.slice_counts(table(spark, sf_dir, "events"), "ts", EVENT_SLICES).withColumn("tab", F.lit("events"))
    od = ts.slice_counts(table(spark, sf_dir, "orders"), "o_orderdate", ORDER_SLICES).withColumn("tab", F.lit("orders"))
    return ev.unionByName(od).select("tab", "slice", "n")
