"""Benchmark decontamination by winnowing; native expressions only.

Words are hashed, K consecutive words make a k-gram hash, and of every W
consecutive k-gram hashes the smallest is kept as a fingerprint.  A span of
K + W - 1 = 13 words holds a whole such window, whose smallest hash is the same
in a document and in a benchmark item: so every shared span of 13 words shares
a fingerprint.  Documents and items that share one are extended: their words
are compared along the diagonal (document position minus item position) on
which a fingerprint's k-gram meets, and every maximal run of equal words that
is long enough counts.  Items of fewer than 13 words are one window: their
whole-length gram is their fingerprint, against all grams of that length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import written

SPAN = 13
K = 6
W = SPAN - K + 1
# Fixed value: what stands between words once A-Z are lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Most rows of a table that is broadcast (a few longs each); larger ones join
# by shuffle.
BROADCAST_ROWS = 100_000
# Most bytes of item texts that are broadcast.
BROADCAST_BYTES = 32_000_000


def _words(text: Column) -> Column:
    """The words of a lower-cased text: the pieces between what is no word,
    without the empty piece before a first or behind a last such run."""
    return F.array_remove(F.split(text, BETWEEN, -1), "")


def _positions(n: Column) -> Column:
    """0 .. n - 1; none for n below 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _grams(hashes: Column, k: int) -> Column:
    """The hash of every k consecutive word hashes."""
    return F.transform(_positions(F.size(hashes) - (k - 1)),
                       lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(k)], F.lit(k)))


def _with_grams(df: DataFrame) -> DataFrame:
    """``hashes`` of ``words`` and ``grams``, the hash of every K of them.  K
    is 6: hashes of pairs, and of three pairs in a row.  Steps are columns of
    their own, since an expression inside a lambda is evaluated per element."""
    df = df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    df = df.withColumn("pairs", F.transform("hashes", lambda x, i: F.xxhash64(x, F.get("hashes", i + 1))))
    df = df.withColumn("triples", F.transform("pairs", lambda x, i: F.xxhash64(
        x, F.get("pairs", i + 2), F.get("pairs", i + 4))))
    return df.withColumn("grams", F.slice("triples", F.lit(1), F.greatest(F.size("hashes") - (K - 1), F.lit(0))))


def _with_window_minima(df: DataFrame) -> DataFrame:
    """``minima``: the smallest of every W consecutive ``grams``.  W is 8, so
    three rounds that each double the width do it; every round is a column of
    its own, since an expression inside a lambda is evaluated per element."""
    prev, width = "grams", 1
    while width < W:
        df = df.withColumn(f"min{2 * width}", _least_of(F.col(prev), width))
        prev, width = f"min{2 * width}", 2 * width
    full = F.greatest(F.size("grams") - (W - 1), F.lit(0))
    return df.withColumn("minima", F.slice(prev, F.lit(1), full))


def _least_of(values: Column, step: int) -> Column:
    return F.transform(values, lambda x, i: F.least(x, F.get(values, i + step)))


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _item_grams(items: DataFrame) -> DataFrame:
    """(k, gram, item, at): an item's fingerprints and where they are in it."""
    hashed = _with_grams(items)
    long = hashed.where(F.size("words") >= SPAN)

    def smallest(i: Column) -> Column:
        return F.array_min(F.transform(F.sequence(i, i + (W - 1)), lambda p: F.struct(
            F.get(F.col("grams"), p).alias("gram"), (-p).alias("place"))))

    # explode_outer, here and below: the filter that Spark infers from explode
    # is pushed down with the whole expression in it, lambdas inside lambdas
    long = (long.select("item", F.explode_outer(F.array_distinct(F.transform(
        _positions(F.size("grams") - (W - 1)), smallest))).alias("f"))
        .select(F.lit(K).alias("k"), F.col("f.gram").alias("gram"), "item", (-F.col("f.place")).alias("at")))
    short = hashed.where(F.size("words") < SPAN)
    whole = F.lit(None).cast("bigint")
    for k in range(1, SPAN):
        gram = F.get("grams", F.lit(0)) if k == K else F.xxhash64(*[F.get("hashes", F.lit(j)) for j in range(k)],
                                                                  F.lit(k))
        whole = F.when(F.size("words") == k, gram).otherwise(whole)
    return long.unionByName(short.select(F.size("words").alias("k"), whole.alias("gram"), "item",
                                         F.lit(0).alias("at")))


def find_contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Hit spans: (text_hash, text_crc, item_id, start, stop), in words of the
    document's text; runs of at least 13 words (or of a shorter item's whole
    length) that equal a run of the item.  Texts are named by two hashes, so
    exact copies are compared once."""
    return _prepare(docs, items)[1]


def _prepare(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    bench = items.select("item_id", _words(F.translate(F.coalesce(F.col("text"), F.lit("")), UPPER, LOWER))
                         .alias("words")).where(F.size("words") > 0)
    bench = written(bench.groupBy("words").agg(F.collect_set("item_id").alias("ids"))
                    .withColumn("item", F.monotonically_increasing_id()), "items")
    marks = written(_item_grams(bench), "item-grams")
    n_marks = marks.count()
    shorts = [r[0] for r in marks.where(F.col("k") < K).union(marks.where((F.col("k") > K) & (F.col("k") < SPAN)))
              .select("k").union(bench.where(F.size("words") == K).select(F.lit(K))).distinct().collect()]

    text = F.coalesce(F.col("text"), F.lit(""))
    key = [F.xxhash64(text).alias("text_hash"), F.crc32(text.cast("binary")).alias("text_crc")]
    # Coarse pass.  lower() also folds letters beyond A-Z; it keeps the number
    # of words and whatever is equal, so it only adds candidates here.
    coarse = _with_window_minima(_with_grams(docs.select("doc_id", *key, _words(F.lower(text)).alias("words"))))
    prints = F.array_distinct("minima")
    for k in shorts:
        prints = F.array_union(prints, F.col("grams") if k == K else _grams(F.col("hashes"), k))
    coarse = written(coarse.select("doc_id", "text_hash", "text_crc", F.size("hashes").cast("long").alias("n_words"),
                                   prints.alias("prints")), "prints")
    # the items' marks under the same folding
    folded = bench.withColumn("words", F.transform("words", lambda w: F.lower(w)))
    folded = written(_item_grams(folded).select("gram").distinct(), "folded")
    found = (coarse.select("text_hash", "text_crc", F.explode("prints").alias("gram"))
             .join(_small(folded, n_marks), "gram", "left_semi").select("text_hash", "text_crc").distinct())
    found = written(found, "candidates")
    n_found = found.count()

    # Fine pass over the candidates only, with exact words.
    fine = docs.select(*key, text.alias("text")).join(_small(found, n_found), ["text_hash", "text_crc"], "left_semi")
    fine = written(fine.dropDuplicates(["text_hash", "text_crc"]).select(
        "text_hash", "text_crc", _words(F.translate("text", UPPER, LOWER)).alias("words")), "words")
    hashes, grams = _with_grams(fine), None
    for k in sorted({K, *shorts}):
        part = hashes.select("text_hash", "text_crc", F.lit(k).alias("k"), F.posexplode_outer(
            F.col("grams") if k == K else _grams(F.col("hashes"), k)).alias("p", "gram"))
        grams = part if grams is None else grams.unionByName(part)
    diagonals = (grams.join(_small(marks, n_marks), ["k", "gram"])
                 .select("text_hash", "text_crc", "item", (F.col("p") - F.col("at")).alias("diagonal")).distinct())
    # extend along each diagonal
    held = bench.agg(F.coalesce(F.sum(F.octet_length(F.array_join("words", " "))), F.lit(0))
                     + F.coalesce(F.sum(16 * (F.size("words") + F.size("ids"))), F.lit(0))).first()[0]
    known = bench.select("item", "ids", F.col("words").alias("item_words"))
    pairs = (diagonals.join(fine, ["text_hash", "text_crc"])
             .join(F.broadcast(known) if held <= BROADCAST_BYTES else known, "item"))
    at = F.greatest(F.col("diagonal"), F.lit(0))
    pairs = pairs.select("text_hash", "text_crc", "ids", "item_words", "diagonal",
                         at.alias("first"), F.slice("words", at + 1, F.size("item_words")).alias("near"))
    # places of the item (and its end) at which the two differ
    breaks = F.filter(F.sequence(F.lit(0), F.size("item_words")), lambda j: ~F.coalesce(
        (j < F.size("item_words")) & (j + F.col("diagonal") >= 0)
        & (j + F.col("diagonal") - F.col("first") < F.size("near"))
        & (F.get("item_words", j) == F.get("near", j + F.col("diagonal") - F.col("first"))), F.lit(False)))
    least = F.least(F.size("item_words"), F.lit(SPAN))
    runs = F.filter(F.transform("breaks", lambda b, i: F.struct(
        F.when(i == 0, 0).otherwise(F.get("breaks", i - 1) + 1).alias("start"), b.alias("stop"))),
        lambda r: r["stop"] - r["start"] >= F.col("least"))
    hits = (pairs.select("text_hash", "text_crc", "ids", "diagonal", least.alias("least"), breaks.alias("breaks"))
            .select("text_hash", "text_crc", "ids", "diagonal", F.explode_outer(runs).alias("run"))
            .where("run is not null")
            .select("text_hash", "text_crc", "ids", (F.col("run.start") + F.col("diagonal")).alias("start"),
                    (F.col("run.stop") + F.col("diagonal")).alias("stop")))
    hits = written(hits, "hits")
    return coarse, hits.withColumn("item_id", F.explode_outer("ids")).drop("ids")


def _hit_words(hits: DataFrame) -> DataFrame:
    """(text_hash, text_crc, n_hit, ids): the size of the union of a text's
    hit spans, and the items that hit it."""
    by_text = Window.partitionBy("text_hash", "text_crc").orderBy("start", "stop")
    reached = F.max("stop").over(by_text.rowsBetween(Window.unboundedPreceding, -1))
    new = F.greatest(F.col("stop") - F.greatest(F.col("start"), F.coalesce(reached, F.lit(0))), F.lit(0))
    return (hits.withColumn("new", new).groupBy("text_hash", "text_crc")
            .agg(F.sum("new").alias("n_hit"), F.collect_set(F.col("item_id").cast("string")).alias("ids")))


def contamination(docs: DataFrame, items: DataFrame, share: int = 20) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit (words inside an occurrence
    of an item's window), n_items, items_sha256 (of the item_ids as sorted
    strings, comma-joined) and contaminated (n_hit > 0 and share * n_hit >=
    n_words).

    A null or empty text has no words and is never hit; an item without words
    has no window; an item with a null item_id marks words but is not listed;
    repeated rows get a row each; an empty ``docs`` gives no rows and an empty
    ``items`` no hits; other columns are ignored."""
    coarse, hits = _prepare(docs, items)
    per_text = _hit_words(hits)
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    ids = F.coalesce(F.col("ids"), F.array().cast("array<string>"))
    return (coarse.select("doc_id", "text_hash", "text_crc", "n_words")
            .join(per_text, ["text_hash", "text_crc"], "left")
            .select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
                    F.sha2(F.array_join(F.array_sort(ids), ","), 256).alias("items_sha256"),
                    ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated")))


def decontaminate(docs: DataFrame, items: DataFrame, share: int = 20) -> DataFrame:
    """The rows of ``docs``, all columns whatever their names, that are not
    contaminated: whether a row goes depends on its text alone."""
    coarse, hits = _prepare(docs, items)
    sizes = coarse.select("text_hash", "text_crc", "n_words").distinct()
    bad = written(_hit_words(hits).join(sizes, ["text_hash", "text_crc"])
                  .where((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))
                  .select(F.col("text_hash").alias("_hash"), F.col("text_crc").alias("_crc")), "contaminated")
    text = F.coalesce(F.col("text"), F.lit(""))
    # the row itself is one column, so no name in it can meet one used here
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       F.xxhash64(text).alias("_hash"), F.crc32(text.cast("binary")).alias("_crc"))
    return rows.join(_small(bad, bad.count()), ["_hash", "_crc"], "left_anti").select("_row.*")
