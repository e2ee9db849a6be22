"""A bounded, repeatable sample of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def crc_mod(key: Column, n: int) -> Column:
    """crc32 of a key written as text, modulo n; null keys count as ''."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, max_rows: int) -> DataFrame:
    """(text, y): documents with a label 0 or 1 among the label rows for which
    ``learn`` holds; at most ``max_rows`` label rows, those with the smallest
    hash of their doc_id, and one document for each (the first text in order
    where a doc_id repeats).  The rows chosen are few by that bound, so they
    are broadcast to the documents."""
    rows = (labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & learn)
            .select("doc_id", F.col(label).cast("int").alias("y")))
    rows = rows.distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(max_rows)
    return (docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id")
            .groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("text", "y"))
