"""Looking up one value per key from rows of which many may share a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keys held by at least this part of all rows go out by broadcast: there are
# at most so many of them, whatever the size of the tables.
SHARE = 1000
SALTS = 64


def looked_up(rows: DataFrame, answers: DataFrame, keys: Sequence[str], weight: str, total: int,
              share: int = SHARE) -> DataFrame:
    """``rows`` with the columns of ``answers`` (one row per key), null where
    there is none.  ``weight`` of a key is at least the number of rows that
    hold it, and the weights add up to ``total`` at most; it is left out.

    Keys of at least ``total / share`` rows are broadcast, at most ``share``
    of them; the rest is joined by a shuffle in which the rows already
    answered are spread by a salt, so no key there holds more than that."""
    values = [c for c in answers.columns if c not in (*keys, weight)]
    hot = F.col(weight) * share >= total
    first = answers.where(hot).select(*keys, *[F.col(c).alias(f"_hot_{c}") for c in values], F.lit(True).alias("_hot"))
    other = answers.where(~hot).select(*keys, *values, F.lit(0).cast("long").alias("_salt"))
    spread = F.when(F.col("_hot"), 1 + F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS))).otherwise(F.lit(0))
    out = rows.join(F.broadcast(first), list(keys), "left").withColumn("_salt", spread.cast("long"))
    out = out.join(other, [*keys, "_salt"], "left")
    return out.select(*rows.columns, *[F.coalesce(F.col(f"_hot_{c}"), F.col(c)).alias(c) for c in values])
