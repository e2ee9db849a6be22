"""Column profiling and data-behind-the-chart aggregates.

Every per-column loop of the reference is one wide aggregation or one unpivot
followed by a grouped aggregation; statistics are joined back as small
per-(group, feature) tables, never collected and re-broadcast by hand.
Exact quantiles (linear interpolation, equal to numpy's default and DuckDB's
``quantile_cont``) come from counts per value, see ``quantile``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import join_small, long_form, stats_row
from .quantile import quantile_row, row_quantiles


# ---------------------------------------------------------------- counts

def value_counts(df: DataFrame, col: str, dropna: bool = True) -> DataFrame:
    """A2: n and percent per value (percent of the rows considered)."""
    src = df.where(F.col(col).isNotNull()) if dropna else df
    total = src.select(F.count(F.lit(1))).scalar()
    return src.groupBy(col).agg(F.count(F.lit(1)).alias("n")).withColumn("pct", F.col("n") * 100.0 / total)


def sorted_rows(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """A profile (a row per column or per distinct value) in order,
    with each row's ``place``: sorted by range, numbered within each part, with
    the sizes of the parts before as offsets."""
    parts = cut_lineage(df.orderBy(*order).withColumn("_part", F.spark_partition_id()))
    sizes = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    start = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    rank = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (join_small(parts, start, ["_part"]).withColumn("place", F.col("_start") + rank)
            .drop("_part", "_start").orderBy("place"))


def count_of_counts(df: DataFrame, key: str) -> DataFrame:
    """A3: how many keys have n records."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("n_records"))
            .groupBy("n_records").agg(F.count(F.lit(1)).alias("n_keys")))


def examples_per_count(df: DataFrame, key: str, k: int = 5) -> DataFrame:
    """A4: the first ``k`` keys (by key order) having each record count.

    The bucket n_records = 1 usually holds most keys, so the per-bucket
    selection goes through the salted two-pass top-k."""
    from .common import top_k
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_records"))
    top = top_k(per_key, ["n_records"], [F.col(key)], k, salt_on=[key])
    return top.groupBy("n_records").agg(
        F.concat_ws(",", F.transform(F.array_sort(F.collect_list(F.col(key))), lambda x: x.cast("string")))
        .alias("examples"))


# ---------------------------------------------------------------- missingness

def null_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A5 + A6 + I6: per column missing count, ratio, severity band and tier,
    from one wide aggregation unpivoted to one row per column."""
    one = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = one.unpivot(["_n"], list(cols), "feature", "missing")
    ratio = F.col("missing") / F.col("_n")
    return long.select(
        "feature", "missing", ratio.alias("ratio"),
        F.when(ratio > 0.5, "red").when(ratio > 0.1, "orange").otherwise("blue").alias("severity"),
        missing_tier(ratio).alias("tier"))


def missing_tier(ratio: Column) -> Column:
    """<=.3 low, (.3,.6] medium, (.6,.8] high, >.8 extreme."""
    return (F.when(ratio <= 0.3, "low").when(ratio <= 0.6, "medium")
            .when(ratio <= 0.8, "high").otherwise("extreme"))


def dropped_row_audit(df: DataFrame, id_col: str, subset: Sequence[str]) -> DataFrame:
    """P10: one (column, id) row per missing cell of the ``dropna(subset)`` columns.

    Long form on purpose: a column's id list is unbounded, so it is never
    collected into one group."""
    return (df.select(id_col, *[F.col(c).isNull().alias(c) for c in subset])
            .unpivot([id_col], list(subset), "feature", "is_null").where("is_null").drop("is_null"))


def dropped_row_counts(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """P9 + P10 totals: missing count per column plus rows before / after dropna."""
    one = df.agg(F.count(F.lit(1)).alias("_rows_before"),
                 F.count_if(F.lit(True) if not subset else
                            _all_present(subset)).alias("_rows_after"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in subset])
    return one.unpivot([], ["_rows_before", "_rows_after", *subset], "feature", "n")


def _all_present(cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


# ---------------------------------------------------------------- classes and distributions

def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A10: exact non-null distinct count per column (Catalyst expands the
    distinct aggregates into one shuffle keyed by (column, value))."""
    one = df.agg(*[F.count_distinct(c).alias(c) for c in cols])
    return one.unpivot([], list(cols), "feature", "nunique")


def variable_classes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A11 (lab3 rule): nunique == 2 -> binary; numeric otherwise -> continuous;
    everything else -> discrete."""
    numeric = {f.name for f in df.schema.fields
               if f.dataType.typeName() in ("integer", "long", "double", "float", "short", "byte", "decimal")}
    nu = distinct_counts(df, cols)
    is_num = F.col("feature").isin(list(numeric)) if numeric else F.lit(False)
    return nu.withColumn("class", F.when(F.col("nunique") == 2, "binary")
                         .when(is_num, "continuous").otherwise("discrete"))


def feature_types(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A12 (lab4 rule): Missing_/Tested_ prefix -> indicator; nunique == 2 with values
    in {0,1} -> binary; 2 < nunique <= 10 -> categorical; else continuous."""
    one = df.agg(*[F.count_distinct(c).alias(f"n__{c}") for c in cols],
                 *[F.count_if(F.col(c).isNotNull() & ~F.col(c).cast("double").isin(0.0, 1.0)).alias(f"o__{c}")
                   for c in cols])
    rows = one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"n__{c}").alias("nunique"), F.col(f"o__{c}").alias("_other"))
        for c in cols])).alias("r")).select("r.*")
    col = F.col("feature")
    kind = (F.when(col.startswith("Missing_"), "missing_indicator")
            .when(col.startswith("Tested_"), "tested_indicator")
            .when((F.col("nunique") == 2) & (F.col("_other") == 0), "binary")
            .when((F.col("nunique") > 2) & (F.col("nunique") <= 10), "categorical")
            .otherwise("continuous"))
    return rows.select("feature", "nunique", kind.alias("type"))


def column_profile(df: DataFrame, cols: Sequence[str], quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Shared per-column profile (A13, and the input of D1 / D2): n, zero
    count, min, max, n_unique and the requested exact quantiles."""
    long = long_form(df, [], cols, "feature", "x").where("x is not null")
    main = long.groupBy("feature", "x").agg(F.count(F.lit(1)).alias("n")).groupBy("feature").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("x") == 0, F.col("n"))), F.lit(0)).alias("zero_count"),
        F.min("x").alias("min"), F.max("x").alias("max"), F.count(F.lit(1)).alias("n_unique"))
    return main.join(row_quantiles(long, ["feature"], quantiles).drop("total", "mn", "mx"), "feature")


def dist_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column n (non-null), n_unique, zero count, min, max, q25, median, q75."""
    p = column_profile(df, cols, (0.25, 0.5, 0.75))
    return p.select("feature", "n", "n_unique", "zero_count", "min", "max",
                    F.col("q")[0].alias("q25"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q75"))


def box_stats(df: DataFrame, value: str, group: Sequence[str] = ()) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers (most extreme values inside the fences)
    and outlier count per group.  The rows are never shuffled by group: they are
    only aggregated where they are."""
    g = list(group)
    long = df.select(*g, F.col(value).cast("double").alias("x")).where("x is not null")
    if not g:
        g, long = ["_all"], long.withColumn("_all", F.hash("x") * 0)
    q = row_quantiles(long, g, (0.25, 0.5, 0.75)).select(
        *g, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"),
        F.col("total").alias("n"))
    q = cut_lineage(q.withColumn("lo_fence", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")))
                    .withColumn("hi_fence", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))))
    x = F.col("x")
    inside = (x >= F.col("lo_fence")) & (x <= F.col("hi_fence"))
    j = join_small(long, q.select(*g, "lo_fence", "hi_fence"), g)
    w = j.groupBy(*g).agg(F.min(F.when(inside, x)).alias("whisker_lo"), F.max(F.when(inside, x)).alias("whisker_hi"),
                          F.count_if(~inside).alias("outliers"))
    return q.join(w, g).drop("_all")


# ---------------------------------------------------------------- histograms

def fixed_histogram(df: DataFrame, value: str, lo: float, hi: float, bins: int) -> DataFrame:
    """``bins`` equal bins on [lo, hi]; outside values excluded; the last bin
    is closed on the right (numpy convention).  Empty bins appear with 0."""
    x = F.col(value)
    b = F.least(F.floor((x - lo) * bins / (hi - lo)), F.lit(bins - 1)).cast("int")
    counts = df.where((x >= lo) & (x <= hi)).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edges = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return _edge_cols(edges.join(counts, "bin", "left").na.fill(0, ["n"]), F.lit(lo), F.lit(hi), bins)


def _edge_cols(df: DataFrame, lo: Column, hi: Column, bins) -> DataFrame:
    step = (hi - lo) / bins
    return df.withColumn("lo", F.col("bin") * step + lo).withColumn(
        "hi", F.when(F.col("bin") + 1 == bins, hi).otherwise((F.col("bin") + 1) * step + lo))


def percentile_histogram(df: DataFrame, value: str, q: float = 0.99, bins: int = 49) -> DataFrame:
    """``bins`` equal bins on [0, p_q]: the reference's linspace(0, p99, 50)."""
    hi = F.lit(quantile_row(df, value, [q])[0])
    x = F.col(value)
    b = F.least(F.floor(x * bins / hi), F.lit(bins - 1)).cast("int")
    counts = df.where((x >= 0) & (x <= hi)).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edges = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return _edge_cols(edges.join(counts, "bin", "left").na.fill(0, ["n"]), F.lit(0.0), hi, bins)


def minmax_histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """``bins`` equal-width bins over [min, max]."""
    st = stats_row(df, lo=F.min(value), hi=F.max(value))
    lo, hi = st["lo"], st["hi"]
    x = F.col(value)
    b = F.least(F.floor((x - lo) * bins / (hi - lo)), F.lit(bins - 1)).cast("int")
    counts = df.where(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edges = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return _edge_cols(edges.join(counts, "bin", "left").na.fill(0, ["n"]), lo, hi, bins)


def auto_bin_stats(long: DataFrame, keys: Sequence[str], x: str = "x", rule: str = "2.x") -> DataFrame:
    """A18 bin geometry per key (numpy ``bins='auto'``) from long-form values.

    n, min, max, IQR -> width = min(max(FD, sqrt/2), Sturges) (numpy 2.x) or
    FD > 0 ? min(FD, Sturges) : Sturges (numpy 1.x); bins = ceil(R / width),
    1 when the width is 0; a constant column gets [v - .5, v + .5]."""
    keys = list(keys)
    st = row_quantiles(long, keys, (0.25, 0.75), x).select(
        *keys, F.col("total").alias("n"), "mn", "mx", F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"))
    n = F.col("n").cast("double")
    rng = F.col("mx") - F.col("mn")
    fd = 2.0 * (F.col("q3") - F.col("q1")) * F.pow(n, -1.0 / 3.0)
    sturges = rng / (F.log2(n) + 1.0)
    sqrt_w = rng / F.sqrt(n)
    width = (F.least(F.greatest(fd, sqrt_w / 2), sturges) if rule == "2.x"
             else F.when(fd > 0, F.least(fd, sturges)).otherwise(sturges))
    first = F.when(rng == 0, F.col("mn") - 0.5).otherwise(F.col("mn"))
    last = F.when(rng == 0, F.col("mx") + 0.5).otherwise(F.col("mx"))
    nb = F.when(width > 0, F.ceil((last - first) / width)).otherwise(F.lit(1)).cast("bigint")
    return st.select(*keys, "n", first.alias("first"), last.alias("last"), nb.alias("nb"))


def bin_index(x: Column, first: Column, last: Column, nb: Column) -> Column:
    """numpy's uniform-bin index including its one-ULP edge corrections, so a value
    on an edge lands where ``np.histogram`` puts it (last bin closed)."""
    step = (last - first) / nb

    def edge(i: Column) -> Column:
        return F.when(i == nb, last).otherwise(i.cast("double") * step + first)

    i0 = F.least(((x - first) / (last - first) * nb).cast("bigint"), nb - 1)
    i1 = F.when(x < edge(i0), i0 - 1).otherwise(i0)
    return F.when((x >= edge(i1 + 1)) & (i1 != nb - 1), i1 + 1).otherwise(i1)


def bin_edge(i: Column, first: Column, last: Column, nb: Column) -> Column:
    return F.when(i == nb, last).otherwise(i.cast("double") * ((last - first) / nb) + first)


def auto_histogram(df: DataFrame, cols: Sequence[str], rule: str = "2.x") -> DataFrame:
    """Numpy 'auto' histogram per column: (column, bin, lo, hi, n) for
    non-empty bins."""
    long = long_form(df, [], cols, "feature", "x").where("x is not null")
    st = cut_lineage(auto_bin_stats(long, ["feature"], rule=rule).drop("n"))
    j = join_small(long, st, ["feature"])
    b = bin_index(F.col("x"), F.col("first"), F.col("last"), F.col("nb"))
    cnt = j.groupBy("feature", "first", "last", "nb", b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return cnt.select("feature", "bin", bin_edge(F.col("bin"), F.col("first"), F.col("last"), F.col("nb")).alias("lo"),
                      bin_edge(F.col("bin") + 1, F.col("first"), F.col("last"), F.col("nb")).alias("hi"), "n")


# ---------------------------------------------------------------- group profiles

def array_profile(df: DataFrame, group: str, vec: str) -> DataFrame:
    """A20 on an array<double> column: (group, dim, mean, std) + (size, pct)."""
    long = df.select(group, F.posexplode(vec).alias("dim", "x"))
    prof = long.groupBy(group, "dim").agg(F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"))
    total = df.select(F.count(F.lit(1))).scalar()
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("size")).withColumn("pct", F.col("size") * 100.0 / total)
    return prof.join(sizes, group)


def top_variance(df: DataFrame, vec: str, k: int = 20) -> DataFrame:
    """The ``k`` dimensions of highest sample variance (ties by dim)."""
    v = (df.select(F.posexplode(vec).alias("dim", "x")).groupBy("dim").agg(F.var_samp("x").alias("var")))
    return v.orderBy(F.col("var").desc(), F.col("dim")).limit(k)


def crosstab_pct(df: DataFrame, row: str, col: str) -> DataFrame:
    """Row-normalised crosstab in long form including empty cells (0).

    Cells are the distinct row values times the distinct column values, built
    from the counted cells (each row gets the array of all column values,
    which is as long as the crosstab is wide)."""
    cells = cut_lineage(df.groupBy(row, col).agg(F.count(F.lit(1)).alias("n")))
    values = cells.agg(F.collect_set(F.coalesce(F.col(col).cast("string"), F.lit("null"))).alias("v"))
    grid = cells.select(row).distinct().select(row, F.explode(values.scalar()).alias(col))
    found = cells.select(row, F.coalesce(F.col(col).cast("string"), F.lit("null")).alias(col), "n")
    same = found[row].eqNullSafe(grid[row]) & (found[col] == grid[col])
    long = grid.join(found, same, "left").select(grid[row], grid[col], F.coalesce("n", F.lit(0)).alias("n"))
    return long.withColumn("pct", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(row)))


def rate_by_group(df: DataFrame, group: str, label: str) -> DataFrame:
    """Mean * 100, count and sum of a 0/1 label per group; band above /
    below the median rate of the groups."""
    r = df.groupBy(group).agg((F.avg(label) * 100).alias("rate"), F.count(F.lit(1)).alias("n"),
                              F.sum(label).cast("bigint").alias("positives"))
    med = r.select(F.percentile("rate", 0.5)).scalar()
    return r.withColumn("band", F.when(F.col("rate") > med, "above").otherwise("below"))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair (pairwise complete), long form.
    Each unordered pair is aggregated once and mirrored; the diagonal is 1."""
    cols = list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    one = df.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs]) if pairs else None
    entries = [F.struct(F.lit(a).alias("a"), F.lit(a).alias("b"), F.lit(1.0).alias("r")) for a in cols]
    for a, b in pairs:
        entries.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{a}__{b}").alias("r")))
        entries.append(F.struct(F.lit(b).alias("a"), F.lit(a).alias("b"), F.col(f"{a}__{b}").alias("r")))
    base = one if one is not None else df.limit(1)
    return base.select(F.explode(F.array(*entries)).alias("p")).select("p.*")


def indicator_sums(df: DataFrame, cols: Sequence[str], k: int | None = None) -> DataFrame:
    """Count of 1 per indicator column with percent; ``k`` asks for the
    first so many columns only."""
    cols = list(cols)[:k]
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).cast("bigint").alias(c) for c in cols])
    return one.unpivot(["_n"], cols, "feature", "ones").select(
        "feature", "ones", (F.col("ones") * 100.0 / F.col("_n")).alias("pct"))
