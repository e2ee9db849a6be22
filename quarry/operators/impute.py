"""Missing-value treatment.

Peak-bin imputation in one pass over the data after the bin geometry: every
row is assigned its numpy bin, and per (key, bin) we keep the count, the sum,
the half-open member sums (x < upper edge) and the sums of values lying
exactly on the lower edge.  From that small per-bin table both variants
follow without another scan:
  * lab4 (half-open [lo, hi)): mean of the half-open members of the peak bin,
    falling back to the key's mean when that set is empty;
  * lab3 (closed [lo, hi]): the peak bin plus the next bin's lower-edge values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import join_small, long_form
from .quantile import counted, modes
from .profile import auto_bin_stats, bin_edge, bin_index, missing_tier

SENTINEL = -999.0


def peak_fill_values(long: DataFrame, keys: Sequence[str], x: str = "x", closed: bool = False,
                     rule: str = "2.x") -> DataFrame:
    """(keys..., fill, peak_lo, peak_hi, mean) per key from long-form values."""
    keys = list(keys)
    long = long.where(F.col(x).isNotNull())
    st = cut_lineage(auto_bin_stats(long, keys, x, rule).drop("n"))
    j = join_small(long, st, keys)
    first, last, nb = F.col("first"), F.col("last"), F.col("nb")
    b = bin_index(F.col(x), first, last, nb)
    j = j.withColumn("bin", b)
    hi = bin_edge(F.col("bin") + 1, first, last, nb)
    lo = bin_edge(F.col("bin"), first, last, nb)
    n, total = F.lit(1), F.col(x)
    per_bin = j.groupBy(*keys, "first", "last", "nb", "bin").agg(
        F.sum(n).alias("cnt"), F.sum(total).alias("s"),
        F.sum(F.when(F.col(x) < hi, total)).alias("hs"),
        F.coalesce(F.sum(F.when(F.col(x) < hi, n)), F.lit(0)).alias("hn"),
        F.sum(F.when(F.col(x) == lo, total)).alias("es"),
        F.coalesce(F.sum(F.when(F.col(x) == lo, n)), F.lit(0)).alias("en"))
    # small (keys x bins) and read twice below: materialise instead of re-scanning the data
    per_bin = cut_lineage(per_bin)
    pk = per_bin.groupBy(*keys).agg(
        F.max_by("bin", F.struct(F.col("cnt"), -F.col("bin"))).alias("p"),
        (F.sum("s") / F.sum("cnt")).alias("mean"))
    pb = per_bin.join(pk, keys)
    at_p = F.col("bin") == F.col("p")
    nxt = F.col("bin") == F.col("p") + 1
    agg = pb.groupBy(*keys, "first", "last", "nb", "p", "mean").agg(
        F.sum(F.when(at_p, F.col("hs"))).alias("hs"), F.sum(F.when(at_p, F.col("hn"))).alias("hn"),
        F.sum(F.when(at_p, F.col("s"))).alias("s"), F.sum(F.when(at_p, F.col("cnt"))).alias("cnt"),
        F.coalesce(F.sum(F.when(nxt, F.col("es"))), F.lit(0.0)).alias("es"),
        F.coalesce(F.sum(F.when(nxt, F.col("en"))), F.lit(0)).alias("en"))
    if closed:
        fill = (F.col("s") + F.col("es")) / (F.col("cnt") + F.col("en"))
    else:
        fill = F.when(F.col("hn") > 0, F.col("hs") / F.col("hn")).otherwise(F.col("mean"))
    return agg.select(*keys, fill.alias("fill"),
                      bin_edge(F.col("p"), first, last, nb).alias("peak_lo"),
                      bin_edge(F.col("p") + 1, first, last, nb).alias("peak_hi"), "mean")


def apply_fills(df: DataFrame, fills: DataFrame, cols: Sequence[str], group: str | None = None,
                value: str = "fill", round_to: int | None = None) -> DataFrame:
    """coalesce(col, fill) using a per-(group, feature) fill table; the table is
    pivoted to one row per group (bounded by #groups) and joined by key."""
    cols = list(cols)
    if group is None:
        # one fill per column: a bounded row, inlined as literals (no join)
        got = {r["feature"]: r[value] for r in fills.select("feature", value).collect()}
        exprs = {}
        for c in cols:
            v = F.coalesce(F.col(c), F.lit(got.get(c)).cast("double"))
            exprs[c] = F.bround(v, round_to) if round_to is not None else v
        return df.withColumns(exprs)
    wide = fills.groupBy(group).pivot("feature", cols).agg(F.first(value))
    wide = wide.select(group, *[F.col(c).alias(f"_fill_{c}") for c in cols])
    out = join_small(df, cut_lineage(wide), [group], "left")
    for c in cols:
        v = F.coalesce(F.col(c), F.col(f"_fill_{c}"))
        out = out.withColumn(c, F.bround(v, round_to) if round_to is not None else v)
    return out.drop(*[f"_fill_{c}" for c in cols])


def peak_impute(df: DataFrame, cols: Sequence[str], group: str | None = None, closed: bool = False,
                round_to: int | None = None) -> DataFrame:
    """I1 (closed, ungrouped, rounded to 2) / I2 (half-open, optionally grouped)."""
    keys = ([group] if group else []) + ["feature"]
    long = long_form(df, [group] if group else [], cols)
    fills = peak_fill_values(long, keys, closed=closed)
    return apply_fills(df, fills, cols, group, round_to=round_to)


def mode_impute(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL <- most frequent value (smallest on ties).  One count over the
    unpivoted columns gives all modes (a bounded row each), inlined as literals."""
    found = modes(counted(long_form(df, [], cols), ["feature"]), ["feature"])
    mode = {r["feature"]: r["mode"] for r in found.collect()}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(mode.get(c)).cast(df.schema[c].dataType)) for c in cols})


def sentinel_impute(df: DataFrame, cols: Sequence[str], value: float = SENTINEL) -> DataFrame:
    """I4 (-999) / I5 (0)."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(value)) for c in cols})


def missing_plan(df: DataFrame, cols: Sequence[str]) -> dict[str, list[str]]:
    """I6 tiers from a one-row profile (the only values brought to the driver:
    one ratio per column)."""
    row = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols]).first()
    plan: dict[str, list[str]] = {"low": [], "medium": [], "high": [], "extreme": []}
    for c in cols:
        r = row[c]
        tier = "low" if r <= 0.3 else "medium" if r <= 0.6 else "high" if r <= 0.8 else "extreme"
        plan[tier].append(c)
    return plan


def tiered_treatment(df: DataFrame, cols: Sequence[str], group: str, polarity: str = "present") -> DataFrame:
    """Low -> grouped peak fill; medium -> Missing_ flag + grouped peak fill;
    high -> Tested_ flag + -999; extreme -> dropped.

    Flags are 1 when the value is *present* (the reference's behaviour, trap
    B1); ``polarity='missing'`` gives the name's meaning instead."""
    plan = missing_plan(df, cols)
    flag = (lambda c: F.col(c).isNotNull().cast("int")) if polarity == "present" else \
        (lambda c: F.col(c).isNull().cast("int"))
    out = df.drop(*plan["extreme"])
    out = out.withColumns({f"Missing_{c}": flag(c) for c in plan["medium"]})
    out = out.withColumns({f"Tested_{c}": flag(c) for c in plan["high"]})
    peak_cols = plan["low"] + plan["medium"]
    if peak_cols:
        out = peak_impute(out, peak_cols, group)
    return sentinel_impute(out, plan["high"])


def drop_sparse(df: DataFrame, cols: Sequence[str], max_missing: float = 0.5, min_valid: int = 5) -> list[str]:
    """I8: columns to drop (missing share > max_missing or fewer than min_valid values)."""
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(c) for c in cols]).first()
    n = row["_n"]
    return [c for c in cols if n == 0 or (n - row[c]) / n > max_missing or row[c] < min_valid]


__all__ = ["peak_fill_values", "apply_fills", "peak_impute", "mode_impute", "sentinel_impute",
           "missing_plan", "tiered_treatment", "drop_sparse", "missing_tier"]
