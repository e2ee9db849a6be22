"""Encoding, scaling and discretisation.

Whole-table statistics (min, max, mean, std, median, quantile edges) enter the
expressions as scalar subqueries; Catalyst merges the ones over the same
relation into a single aggregate job, so a K-column scaling costs one extra
scan, not K.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import join_small, stats_row

# ---------------------------------------------------------------- recodes


def mixed_text_code(c: Column, blank_as: int = 0) -> Column:
    """Lab result text -> 0/1.  NULL or blank -> ``blank_as`` (the reference
    code yields 1, its documentation 0: trap B2); 'negative' (any case/space)
    -> 0; a number > 0 -> 1; anything else -> 0."""
    s = F.trim(c)
    num = s.try_cast("double")
    return (F.when(c.isNull() | (s == ""), F.lit(blank_as))
            .when(F.lower(s) == "negative", F.lit(0))
            .when(num.isNotNull() & ~F.isnan(num) & (num > 0), F.lit(1))
            .otherwise(F.lit(0)))


def tested_flag(c: Column) -> Column:
    """Tested_ indicator: 1 when a result is present (not NULL)."""
    return c.isNotNull().cast("int")


def binary_recode(c: Column, mapping: Mapping = {1: 0, 2: 1}) -> Column:  # noqa: B006
    """Replace {1: 0, 2: 1}, other values (and NULL) unchanged."""
    out = None
    for k, v in mapping.items():
        out = (F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v)))
    return out.otherwise(c)


def map_encode(c: Column, mapping: Mapping) -> Column:
    """Fixed dictionary; unmapped values -> NULL."""
    m = F.create_map(*[x for kv in mapping.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return F.try_element_at(m, c)


def label_encode(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Sorted distinct values (lexicographic) -> 0..n-1.

    The distinct values are sorted by range and numbered part by part, and the
    codes are joined back by value."""
    from .profile import sorted_rows
    out = out or f"{col}_encoded"
    values = df.select(col).where(F.col(col).isNotNull()).distinct()
    codes = sorted_rows(values, [F.col(col)]).select(col, (F.col("place") - 1).cast("int").alias(out))
    return join_small(df, codes, [col], "left")


# ---------------------------------------------------------------- scaling


def minmax_scale(df: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """(x - min) / (max - min); a constant column maps to 0."""
    st = stats_row(df, **{f"lo{i}": F.min(c) for i, c in enumerate(cols)},
                   **{f"hi{i}": F.max(c) for i, c in enumerate(cols)})
    exprs = {}
    for i, c in enumerate(cols):
        lo, hi = st[f"lo{i}"], st[f"hi{i}"]
        exprs[c + suffix] = F.when(hi == lo, F.lit(0.0)).otherwise((F.col(c) - lo) / (hi - lo))
    return df.withColumns(exprs)


def scaler_ranges(df: DataFrame, scaled: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column the original range and the range after scaling (the
    reference only stored the latter, which is always [0, 1]: trap B4)."""
    a = df.agg(*[F.struct(F.min(c).cast("double").alias("mn"), F.max(c).cast("double").alias("mx")).alias(c)
                 for c in cols])
    b = scaled.agg(*[F.struct(F.min(c).cast("double").alias("mn"), F.max(c).cast("double").alias("mx")).alias(c)
                     for c in cols])
    ra = a.unpivot([], list(cols), "feature", "r").select("feature", F.col("r.mn").alias("orig_min"),
                                                         F.col("r.mx").alias("orig_max"))
    rb = b.unpivot([], list(cols), "feature", "r").select("feature", F.col("r.mn").alias("scaled_min"),
                                                         F.col("r.mx").alias("scaled_max"))
    return ra.join(rb, "feature")


def zscore(df: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """(x - mean) / population std; a constant column maps to 0."""
    st = stats_row(df, **{f"m{i}": F.avg(c) for i, c in enumerate(cols)},
                   **{f"s{i}": F.stddev_pop(c) for i, c in enumerate(cols)})
    exprs = {}
    for i, c in enumerate(cols):
        m, s = st[f"m{i}"], st[f"s{i}"]
        exprs[c + suffix] = F.when(s == 0, F.lit(0.0)).otherwise((F.col(c) - m) / s)
    return df.withColumns(exprs)


def zscore_array(df: DataFrame, vec: str, dim: int, out: str | None = None) -> DataFrame:
    """I15 on an array<double> column, per position (population std)."""
    out = out or vec
    st = stats_row(df, **{f"m{i}": F.avg(F.col(vec)[i]) for i in range(dim)},
                   **{f"s{i}": F.stddev_pop(F.col(vec)[i]) for i in range(dim)})
    ms = [st[f"m{i}"] for i in range(dim)]
    ss = [st[f"s{i}"] for i in range(dim)]
    return df.withColumn(out, F.array(*[
        F.when(ss[i] == 0, F.lit(0.0)).otherwise((F.col(vec)[i] - ms[i]) / ss[i]) for i in range(dim)]))


def zscore_array_by(df: DataFrame, vec: str, by: Sequence[str], out: str | None = None) -> DataFrame:
    """I15 on an array<double> column, per position within each group of ``by``
    (few groups, no NULL in their keys): one job for all groups."""
    by, out = list(by), out or vec
    st = df.select(*by, F.posexplode(vec).alias("_i", "_v")).groupBy(*by, "_i").agg(
        F.avg("_v").alias("m"), F.stddev_pop("_v").alias("s"))
    st = cut_lineage(st.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("_i", "m", "s"))).alias("_st")))

    def scaled(v: Column, i: Column) -> Column:
        at = F.get("_st", i)
        return F.when(at["s"] == 0, F.lit(0.0)).otherwise((v - at["m"]) / at["s"])

    return join_small(df, st, by).withColumn(out, F.transform(vec, scaled)).drop("_st")


# ---------------------------------------------------------------- discretisation


def risk_band(p: Column) -> Column:
    """D3: (0, .3] low, (.3, .7] medium, (.7, 1] high; 0 (or outside) -> NULL."""
    return (F.when((p > 0) & (p <= 0.3), "low").when((p > 0.3) & (p <= 0.7), "medium")
            .when((p > 0.7) & (p <= 1.0), "high"))


def median_binarise(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Columns with more than two distinct values -> x > median; binary
    columns -> x != 0.  NULL -> false (item absent; the reference turned NULL
    into True for binaries, trap B9)."""
    from .profile import column_profile
    prof = {r["feature"]: r for r in column_profile(df, cols, (0.5,)).collect()}
    exprs = {}
    for c in cols:
        p = prof.get(c)
        if p is not None and p["n_unique"] > 2:
            e = F.col(c) > F.lit(p["q"][0])
        else:
            e = F.col(c) != 0
        exprs[c] = F.coalesce(e, F.lit(False))
    return df.withColumns(exprs)


def adaptive_bin_profile(df: DataFrame, cols: Sequence[str]) -> dict:
    """Statistics D1 needs (a handful of numbers per column, brought to the
    driver to choose each column's strategy) from the shared column profile."""
    from .profile import column_profile
    rows = column_profile(df, cols, (0.25, 0.5, 0.75, 1.0 / 3.0, 2.0 / 3.0)).collect()
    out = {c: {"n": 0, "n_unique": 0, "zeros": 0, "min": None, "max": None, "q": [None] * 5} for c in cols}
    for r in rows:
        out[r["feature"]] = {"n": r["n"], "n_unique": r["n_unique"], "zeros": r["zero_count"],
                             "min": r["min"], "max": r["max"], "q": r["q"]}
    return out


def adaptive_bins(df: DataFrame, cols: Sequence[str], prof: dict | None = None) -> DataFrame:
    """Per column, zero share > 30 % -> {c}_zero / {c}_non_zero; <= 3
    distinct -> {c}_{value}; else tertiles (qcut: right-closed, lowest
    included) and, when an edge repeats, 3 equal-width bins (pandas cut, lowest
    edge lowered by 0.1 % of the range); labels {c}_low/_med/_high.
    NULL stays NULL (the reference labelled it non_zero: trap B14)."""
    prof = prof or adaptive_bin_profile(df, cols)
    exprs = {}
    for c in cols:
        p = prof[c]
        x = F.col(c)
        if p["n"] == 0:
            exprs[f"{c}_bin"] = F.lit(None).cast("string")
            continue
        if p["zeros"] / p["n"] > 0.3:
            e = F.when(x == 0, F.lit(f"{c}_zero")).when(x.isNotNull(), F.lit(f"{c}_non_zero"))
        elif p["n_unique"] <= 3:
            e = F.concat(F.lit(f"{c}_"), x.cast("string"))
        else:
            _, _, _, t1, t2 = p["q"]
            lo, hi = p["min"], p["max"]
            edges = [lo, t1, t2, hi]
            if len(set(edges)) < 4:
                step = (hi - lo) / 3
                edges = [lo - (hi - lo) * 0.001, lo + step, lo + 2 * step, hi]
            e = (F.when(x <= edges[1], F.lit(f"{c}_low")).when(x <= edges[2], F.lit(f"{c}_med"))
                 .when(x <= edges[3], F.lit(f"{c}_high")))
            e = F.when(x.isNotNull(), e)
        exprs[f"{c}_bin"] = e
    return df.withColumns(exprs)
