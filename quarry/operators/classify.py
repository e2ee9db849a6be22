"""Features of whole texts for classification, and small result tables (K14,
K16); the models are in ``boosting``.

Features are computed with JVM built-ins (lengths, token and line counts,
character-class shares).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encode import map_encode, risk_band

# Language codes used as an ordinal feature.
LANG_CODES = {"en": 0, "de": 1, "fr": 2, "es": 3}

TEXT_FEATURES = ["n_chars", "n_words", "n_lines", "upper_share", "digit_share", "punct_share", "lang_code"]

def text_features(docs: DataFrame) -> DataFrame:
    """Per document numeric features over the whole text."""
    t = F.col("text")
    n = F.greatest(F.length(t), F.lit(1))
    share = lambda pat: F.length(F.regexp_replace(t, pat, "")) / n
    return docs.select(
        "doc_id", F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split(F.trim(t), r"\s+")).cast("double").alias("n_words"),
        F.size(F.split(t, "\n")).cast("double").alias("n_lines"),
        share("[^A-Z]+").alias("upper_share"), share("[^0-9]+").alias("digit_share"),
        share(r"[^\p{Punct}]+").alias("punct_share"),
        F.coalesce(map_encode(F.col("lang"), LANG_CODES), F.lit(len(LANG_CODES))).cast("double").alias("lang_code"))


def importance_top(imp: DataFrame, k: int) -> DataFrame:
    """The ``k`` most important features."""
    return imp.orderBy(F.col("importance").desc(), "feature").limit(k)


def band_counts(pred: DataFrame, level: str = "risk_level") -> DataFrame:
    """Rows per risk band."""
    return pred.groupBy(level).agg(F.count(F.lit(1)).alias("n"))
