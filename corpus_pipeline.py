"""A training-data pipeline over ``documents``, one operator per stage.

Each stage takes (spark, docs, sf_dir) and returns what it keeps, with the
columns of ``documents`` (the last one returns token digests); ``run`` writes
every stage's result as Parquet and reads it back for the next one.

Rows with a null in any column pass through: a null text is an empty one to
every stage, and a document without a doc_id is never a group's first, so the
near-dedup stage keeps it.  An empty table stays empty.  Columns beyond those
of ``documents`` are carried along up to the last stage, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.decontaminate import decontaminate
from quarry.llm.labelled import crc_mod
from quarry.llm.line_dedup import remove_boilerplate
from quarry.llm.piece_codec import encode_documents
from quarry.llm.quality import fit_quality, keep_good
from quarry.llm.simhash import near_duplicates
from quarry.llm.tables import written
from quarry.sources.tables import table

TOKENIZER = "piece_bpe_32k.model"
MIN_SITES = 5


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the classifier predicts to be of low quality.  It learns from
    the labelled documents outside the held-out third."""
    learn = crc_mod(F.col("doc_id"), 3) != 1
    return keep_good(docs, fit_quality(docs, table(spark, sf_dir, "labels"), learn))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take boilerplate lines out of the texts; n_chars follows."""
    out = remove_boilerplate(docs, MIN_SITES, counts=False)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group: the one whose id names the group.
    Rows that repeat a kept one in doc_id and text go."""
    first = near_duplicates(docs, shingle=4, bits=4).where("doc_id = component_id").select("doc_id").distinct()
    # the row itself is one column, so no name in it can meet one used here
    named = docs.where("doc_id is not null").select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                                                    "doc_id", F.xxhash64("text").alias("_text"))
    kept = named.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id", "_text"]).select("_row.*")
    return kept.unionByName(docs.where("doc_id is null"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which a twentieth or more is benchmark text."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode and decode what is left: number of tokens and digests."""
    return encode_documents(docs, public_tokenizers.path(TOKENIZER), with_text=False)


STAGES = [
    ("quality classifier", quality_filter),
    ("line dedup", line_dedup),
    ("simhash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("sentencepiece encoding and decoding", piece_encoding),
]

# A fitted model and fingerprints have no SQL form; a test holds run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the whole table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
