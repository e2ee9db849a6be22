"""The subpackage's registered queries: thin digests of the operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import table
from . import collocations as phrases
from . import fim, line_dedup, warc
from .decontaminate import contamination
from .embed_dedup import link_vectors
from .line_dedup import line_dedup_digest
from .pii import personal_data_digest
from .piece_codec import encode_documents
from .quality import classify_quality
from .sharding import shard_documents
from .simhash import near_duplicates
from .token_counts import count_tokens
from .toxicity import classify_toxicity

TOKENIZER = "piece_bpe_32k.model"


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), shards=24)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), limit=4096)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), folds=5, held=0)


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data_digest(table(spark, sf_dir, "documents"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), folds=3, held=1)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup_digest(table(spark, sf_dir, "documents"), min_sites=5)


def op8_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), with_text=False)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4, bits=4)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.fill_in_middle(table(spark, sf_dir, "documents"), seed=7, rate=100, spm=50, with_text=False)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), longest=3, least=10, share=50, top=2000)


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"), min_bytes=0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_sharding, op2_token_counts, op3_toxicity, op4_personal_data, op5_embedding_dedup, op6_quality,
        op7_line_dedup, op8_piece_codec, op9_simhash, op10_decontamination, op11_fill_in_middle, op12_collocations,
        op13_warc)}
ORACLE: dict[str, str] = {"op7_line_dedup": line_dedup.DIGEST_SQL, "op11_fill_in_middle": fim.DIGEST_SQL,
                          "op12_collocations": phrases.DIGEST_SQL, "op13_warc": warc.DIGEST_SQL}
