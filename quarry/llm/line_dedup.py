"""Cross-site boilerplate lines by distinct-site spread.

Every line is a hash with the site (``source``) of its document.  HyperLogLog
sketches of the sites per line merge by aggregation, before and after the
shuffle, so a line on every page costs one sketch per task.  Lines whose
estimate is clearly under or over the threshold are settled by it; those near
it (within the sketch's error bound and a margin) get an exact distinct count.
A line on at least ``min_sites`` sites is boilerplate and goes everywhere but
at its first place, so no text is lost altogether.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import written

LG_K = 12  # 2^12 registers: a standard error of about 1.6 %
MARGIN = 0.15
# Most rows of a broadcast table here (a few longs each).
BROADCAST_ROWS = 50_000


def _lines(docs: DataFrame) -> DataFrame:
    """(text_hash, text_crc, doc_id, site, line_no, line): hashes of all lines
    that are not blank; a line's hash leaves out white space at its ends."""
    text = F.coalesce(F.col("text"), F.lit(""))
    line = F.regexp_replace("raw", r"^[\t\r ]+|[\t\r ]+$", "")
    site = F.coalesce(F.xxhash64("source"), F.lit(0)) if "source" in docs.columns else F.lit(0).cast("long")
    parts = docs.select("doc_id", site.alias("site"), F.xxhash64(text).alias("text_hash"),
                        F.crc32(text.cast("binary")).alias("text_crc"), F.posexplode_outer(F.split(text, "\n", -1))
                        .alias("line_no", "raw"))
    return (parts.withColumn("line", line).where("line <> ''")
            .select("doc_id", "text_hash", "text_crc", "line_no", F.xxhash64("line").alias("line"),
                    F.crc32(F.col("line").cast("binary")).alias("line_crc"), "site"))


def boilerplate_lines(lines: DataFrame, min_sites: int) -> DataFrame:
    """(line, line_crc) of lines on at least ``min_sites`` distinct sites."""
    key = ["line", "line_crc"]
    spread = written(lines.groupBy(*key).agg(F.hll_sketch_agg("site", LG_K).alias("sketch"))
                     .select(*key, F.hll_sketch_estimate("sketch").alias("sites"))
                     .where(F.col("sites") >= min_sites * (1 - MARGIN)), "spread")
    near = F.col("sites") <= min_sites * (1 + MARGIN)
    exact = (lines.join(spread.where(near).select(*key), key, "left_semi").select(*key, "site").distinct()
             .groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") >= min_sites))
    return spread.where(~near).select(*key).unionByName(exact.select(*key))


def mark_boilerplate(docs: DataFrame, min_sites: int) -> DataFrame:
    """(text_hash, text_crc, doc_id, gone): the numbers of the lines to leave
    out, for documents that have any."""
    key = ["line", "line_crc"]
    lines = written(_lines(docs), "lines")
    boiler = written(boilerplate_lines(lines, min_sites), "boilerplate")
    few = boiler.count() <= BROADCAST_ROWS
    places = written(lines.join(F.broadcast(boiler) if few else boiler, key).select(
        *key, F.struct("doc_id", "text_hash", "text_crc", "line_no").alias("place")), "places")
    first = places.groupBy(*key).agg(F.min("place").alias("first"))
    # a row per boilerplate line: broadcast, the places of a line stay spread
    return (places.join(F.broadcast(first) if few else first, key).where(~F.col("place").eqNullSafe(F.col("first")))
            .groupBy("place.doc_id", "place.text_hash", "place.text_crc")
            .agg(F.collect_set("place.line_no").alias("gone")))


def without_lines(lines: Column, gone: Column) -> Column:
    """The lines whose numbers are not in ``gone``, joined again: the stretches
    between the numbers, so the work is linear in the lines."""
    marks = F.sort_array(gone)
    start = F.concat(F.array(F.lit(0)), F.transform(marks, lambda x: x + 1))
    stretches = F.filter(F.zip_with(start, F.concat(marks, F.array(F.size(lines))), lambda a, b: F.struct(
        a.alias("a"), b.alias("b"))), lambda r: r["b"] > r["a"])
    return F.array_join(F.transform(stretches, lambda r: F.array_join(
        F.slice(lines, r["a"] + 1, r["b"] - r["a"]), "\n")), "\n")


def remove_boilerplate(docs: DataFrame, min_sites: int = 5, counts: bool = True) -> DataFrame:
    """``docs`` with its columns, ``text`` without boilerplate lines, and with
    ``counts`` n_lines (of the text as it came) and n_removed after them.

    A line is boilerplate if it stands, but for white space at its ends, in
    documents of at least ``min_sites`` sources; its place with the smallest
    (doc_id, text hashes, line number) stays.  Blank lines stay and are not
    counted as repeated; a null source is one site of its own, and so are all
    documents of a table without that column.  A null text stays null with no
    lines; a very long text is handled whole, in time linear in its lines; rows
    equal in doc_id and text are handled alike, as one; an empty table gives no
    rows.  Other columns are carried along whatever their names, but columns
    called n_lines or n_removed make way for those of ``counts``."""
    marks = written(mark_boilerplate(docs, min_sites), "marks")
    marks = marks.select(F.col("doc_id").alias("_id"), "text_hash", "text_crc", "gone")
    text = F.coalesce(F.col("text"), F.lit(""))
    # the row itself is one column, so no name in it can meet one used here
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("doc_id").alias("_doc"),
                        F.xxhash64(text).alias("_hash"), F.crc32(text.cast("binary")).alias("_crc"))
    joined = keyed.join(marks, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("text_hash"))
                        & (F.col("_crc") == F.col("text_crc")), "left")
    joined = joined.select("_row", "gone", F.split("_row.text", "\n", -1).alias("_lines"))
    kept = F.when(F.col("gone").isNull(), F.col("_row.text")).otherwise(without_lines(F.col("_lines"), F.col("gone")))
    own = [F.coalesce(F.size("_lines"), F.lit(0)).cast("long").alias("n_lines"),
           F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed")] if counts else []
    return joined.select(*[kept.alias("text") if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in docs.columns
                           if not (own and c in ("n_lines", "n_removed"))], *own)


def line_dedup_digest(docs: DataFrame, min_sites: int = 5) -> DataFrame:
    """Per row: doc_id, n_lines, n_removed, n_chars_left, text_sha256 (of the
    text that is left; null for a null text)."""
    out = remove_boilerplate(docs.select("doc_id", "text", "source"), min_sites)
    return out.select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("n_chars_left"),
                      F.sha2("text", 256).alias("text_sha256"))


DIGEST_SQL = r"""
WITH l AS (
  SELECT d.doc_id, d.text, d.source, u.i - 1 AS line_no, u.line AS raw,
         regexp_replace(u.line, '^[\t\r ]+|[\t\r ]+$', '', 'g') AS line
  FROM documents d, LATERAL (SELECT unnest(string_split(d.text, chr(10))) AS line,
                                    generate_subscripts(string_split(d.text, chr(10)), 1) AS i) u
), boiler AS (
  SELECT line FROM l WHERE line <> '' GROUP BY line HAVING count(DISTINCT coalesce(source, chr(0))) >= 5
), ranked AS (
  SELECT l.*, b.line IS NOT NULL
              AND row_number() OVER (PARTITION BY l.line ORDER BY l.doc_id, l.line_no) > 1 AS gone
  FROM l LEFT JOIN boiler b ON b.line = l.line
), kept AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
         coalesce(string_agg(raw, chr(10) ORDER BY line_no) FILTER (WHERE NOT gone), '') AS text
  FROM ranked GROUP BY doc_id
)
SELECT doc_id, n_lines, n_removed, length(text) AS n_chars_left, sha256(text) AS text_sha256 FROM kept
"""
