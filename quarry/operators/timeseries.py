"""Time-grid and sliding-window operators.

Layout of a series table: ``(series, t, slot, n, ...)`` where ``t`` is epoch
seconds on a regular grid, ``slot`` the 0-based row position inside its
series and ``n`` the series length.  Because the grid is regular, positions
are arithmetic on ``t``: no global ``row_number`` and no window over a whole
series is ever needed.  The only windows used are partitioned by
(series, time-of-day) - a group holds one row per day, bounded by the span in
days however many raw events feed the grid - or by (series, config, window),
bounded by the window width.

Windows are emitted in long form ``(series, cfg, k, j, value)``: window ``k``
of a configuration covers positions ``[k*step, k*step + w)``.  A row at
position p belongs to at most ceil(w/step) windows, so the explode costs a
small constant factor and the following shuffle on (series, cfg, k) spreads
even a single huge series over all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = 86400

# Window configurations of the reference: (width, step).
WINDOW_CONFIGS = ((7, 1), (15, 5), (30, 10))


def regular_grid(points: DataFrame, series: str, t: str, step: int, aggs: Sequence[Column]) -> DataFrame:
    """Regular ``step``-second grid per series from its first to last whole day,
    left-joined to the points bucketed into the grid (``aggs`` over each bucket).

    Output adds ``slot`` (position) and ``n`` (grid length of the series)."""
    bounds = points.groupBy(series).agg(
        (F.floor(F.min(t) / DAY) * DAY).cast("bigint").alias("_lo"),
        (F.floor(F.max(t) / DAY) * DAY + DAY - step).cast("bigint").alias("_hi"))
    grid = bounds.select(
        series, "_lo", (((F.col("_hi") - F.col("_lo")) / step).cast("bigint") + 1).alias("n"),
        F.explode(F.sequence("_lo", "_hi", F.lit(step).cast("bigint"))).alias(t))
    buckets = points.withColumn(t, (F.floor(F.col(t) / step) * step).cast("bigint")).groupBy(series, t).agg(*aggs)
    return (grid.join(buckets, [series, t], "left")
            .withColumn("slot", ((F.col(t) - F.col("_lo")) / step).cast("bigint"))
            .drop("_lo"))


def availability_matrix(df: DataFrame, x: str, y: str) -> DataFrame:
    """2x2 counts and percentages of (x present?) x (y present?)."""
    total = df.select(F.count(F.lit(1))).scalar()
    return (df.groupBy(F.col(x).isNotNull().alias(f"{x}_present"), F.col(y).isNotNull().alias(f"{y}_present"))
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("pct", F.col("n") * 100.0 / total))


def missing_indicator(df: DataFrame, value: str, keys: Sequence[str] = ("series", "t")) -> DataFrame:
    """0/1 missing indicator per time index."""
    return df.select(*keys, F.col(value).isNull().cast("int").alias(f"{value}_missing"))


def daily_missing_ratio(df: DataFrame, values: Sequence[str], series: str = "series", t: str = "t") -> DataFrame:
    """Share of missing slots per (series, date)."""
    return (df.groupBy(series, F.date_from_unix_date((F.col(t) / DAY).cast("int")).alias("date"))
            .agg(*[F.avg(F.col(v).isNull().cast("double")).alias(f"{v}_missing_ratio") for v in values],
                 F.count(F.lit(1)).alias("slots")))


def tod_mean_fill(df: DataFrame, value: str, days: int = 15, series: str = "series", t: str = "t",
                  out: str | None = None) -> DataFrame:
    """A NULL takes the mean of the non-NULL *original* values at the same
    time of day within [t - days, t + days] (inclusive); stays NULL if none.

    One range-frame window partitioned by (series, time-of-day): each group has
    one row per day of the series."""
    out = out or f"{value}_filled"
    w = (Window.partitionBy(series, F.col(t) % DAY).orderBy(t)
         .rangeBetween(-days * DAY, days * DAY))
    return df.withColumn(out, F.coalesce(F.col(value), F.avg(value).over(w)))


def periodic_feature(df: DataFrame, value: str, days: int = 15, series: str = "series", t: str = "t",
                     out: str = "periodic") -> DataFrame:
    """Mean of ``value`` at t - d days for d = 1..days over the instants that
    exist in the grid; 0.0 when none exists; NULL when any existing one is NULL."""
    w = (Window.partitionBy(series, F.col(t) % DAY).orderBy(t)
         .rangeBetween(-days * DAY, -DAY))
    n_all = F.count(F.lit(1)).over(w)
    n_val = F.count(value).over(w)
    return df.withColumn(out, F.when(n_all == 0, F.lit(0.0))
                         .when(n_val < n_all, F.lit(None).cast("double"))
                         .otherwise(F.avg(value).over(w)))


def _window_ids(pos: Column, n: Column, w: int, step: int, include_last: bool) -> Column:
    """Array of window indices k whose range [k*step, k*step+w) holds ``pos``.

    Window k is kept iff k*step + w < n (strict, the reference drops the last
    full window) or <= n with ``include_last``."""
    lim = n - w if include_last else n - w - 1          # last admissible start
    k_hi = F.least(F.floor(pos / step), F.floor(lim / step))
    k_lo = F.greatest(F.ceil((pos - w + 1) / step), F.lit(0))
    return F.when((lim >= 0) & (k_hi >= k_lo), F.sequence(k_lo.cast("bigint"), k_hi.cast("bigint"))) \
        .otherwise(F.array().cast("array<bigint>"))


def sliding_windows(df: DataFrame, values: Sequence[str], configs: Sequence[tuple[int, int]] = WINDOW_CONFIGS,
                    series: str = "series", pos: str = "slot", n: str = "n", include_last: bool = False) -> DataFrame:
    """Count-based sliding windows for several (width, step) configurations
    in one pass.  Output long form ``(series, w, step, k, j, *values)`` where
    ``j`` is the position inside the window."""
    for c in values:
        if c not in df.columns:
            raise ValueError(f"attribute {c!r} not in {df.columns}")
    def tag(w: int, s: int):
        return lambda k: F.struct(F.lit(w).alias("w"), F.lit(s).alias("step"), k.alias("k"))

    cfgs = F.flatten(F.array(*[
        F.transform(_window_ids(F.col(pos), F.col(n), w, s, include_last), tag(w, s)) for w, s in configs]))
    return (df.select(series, pos, *values, F.explode(cfgs).alias("c"))
            .select(series, "c.w", "c.step", "c.k", (F.col(pos) - F.col("c.k") * F.col("c.step")).alias("j"),
                    *values))


def window_gap_fill(win: DataFrame, value: str, keys: Sequence[str] = ("series", "w", "step", "k"),
                    j: str = "j", out: str | None = None) -> DataFrame:
    """W4 + W5: linear interpolation by position inside each window, ends take the
    nearest value; windows without any value are dropped.

    Window groups hold at most ``w`` rows, so the frame is small."""
    out = out or value
    g = Window.partitionBy(*keys)
    before = g.orderBy(j).rowsBetween(Window.unboundedPreceding, 0)
    after = g.orderBy(j).rowsBetween(0, Window.unboundedFollowing)
    pv = F.last(value, ignorenulls=True).over(before)
    pj = F.last(F.when(F.col(value).isNotNull(), F.col(j)), ignorenulls=True).over(before)
    nv = F.first(value, ignorenulls=True).over(after)
    nj = F.first(F.when(F.col(value).isNotNull(), F.col(j)), ignorenulls=True).over(after)
    filled = (F.when(F.col(value).isNotNull(), F.col(value))
              .when(pv.isNull(), nv).when(nv.isNull(), pv)
              .otherwise(pv + (nv - pv) * (F.col(j) - pj) / (nj - pj)))
    return (win.withColumn("_has", F.count(value).over(g))
            .where(F.col("_has") > 0)
            .withColumn(out, filled).drop("_has"))


def windows_to_arrays(win: DataFrame, values: Sequence[str], keys: Sequence[str] = ("series", "w", "step", "k"),
                      j: str = "j") -> DataFrame:
    """Collapse long-form windows to one row per window with value arrays
    (ordered by position).  Each group is at most ``w`` rows."""
    agg = F.array_sort(F.collect_list(F.struct(j, *values)))
    return win.groupBy(*keys).agg(agg.alias("_r")).select(
        *keys, *[F.col(f"_r.{v}").alias(v) for v in values])


def attach_window_end(win_arrays: DataFrame, series_df: DataFrame, cols: Sequence[str],
                      series: str = "series", pos: str = "slot") -> DataFrame:
    """W7/W8 alignment by key (not by position): join each window to the series row
    at its last position k*step + w - 1."""
    end = (F.col("k") * F.col("step") + F.col("w") - 1).alias(pos)
    return (win_arrays.withColumn(pos, end)
            .join(series_df.select(series, pos, *cols), [series, pos], "inner"))


def time_slice(df: DataFrame, ts_col: str, start: str, end: str) -> DataFrame:
    """Half-open [start, end) slice.  Bare comparisons against literals of the
    column's own type so the predicate reaches the parquet scan."""
    typ = df.schema[ts_col].dataType.simpleString()
    return df.where((F.col(ts_col) >= F.lit(start).cast(typ)) & (F.col(ts_col) < F.lit(end).cast(typ)))


def slice_counts(df: DataFrame, ts_col: str, slices: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Row count of several (possibly overlapping) slices in one scan: the union
    range is pushed down, each slice is a conditional count, then unpivoted."""
    typ = df.schema[ts_col].dataType.simpleString()
    lo = min(a for _, a, _ in slices)
    hi = max(b for _, _, b in slices)
    c = F.col(ts_col)
    one = time_slice(df, ts_col, lo, hi).agg(*[
        F.count_if((c >= F.lit(a).cast(typ)) & (c < F.lit(b).cast(typ))).alias(n) for n, a, b in slices])
    return one.unpivot([], [n for n, _, _ in slices], "slice", "n")
