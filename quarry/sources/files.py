"""File sources and sinks.

Writers never collect: each is ``DataFrame.write`` with a mode, so the work
stays distributed and the output is one file per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Tokens read as missing, as in the reference inputs.
NULL_TOKENS = ("", "n/a", "NA")


def read_csv(spark: SparkSession, path: str, schema: str | None = None, null_value: str = "n/a") -> DataFrame:
    """Header CSV (UTF-8, a BOM is stripped by Spark's reader); give a
    schema at scale instead of inferring it."""
    r = spark.read.option("header", True).option("nullValue", null_value).option("encoding", "UTF-8")
    r = r.schema(schema) if schema else r.option("inferSchema", True)
    return r.csv(path)


def read_mapping(spark: SparkSession, path: str) -> dict[str, str]:
    """S3: a JSON object old-name -> new-name (a small config file)."""
    row = spark.read.option("multiLine", True).json(path).first()
    return {k: v for k, v in row.asDict().items() if v is not None} if row else {}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", signed: bool = False) -> None:
    """S4.  ``signed``: every file starts with the UTF-8 byte order mark that
    spreadsheets look for; it is the first character of the header line, which
    Spark writes to each file, so the rows are not touched."""
    if signed and df.columns:
        df = df.toDF("\ufeff" + df.columns[0], *df.columns[1:])
    df.write.mode(mode).option("header", True).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """S5 / S6 (one directory per key, e.g. itemset length)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path)


def write_text(df: DataFrame, path: str, line, mode: str = "overwrite") -> None:
    """One formatted line per row."""
    df.select(line.alias("value")).write.mode(mode).text(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Materialise a derived table (e.g. the filled series) for later jobs."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def save_model(model, path: str) -> None:
    """Spark ML writer (replaces pickles)."""
    model.write().overwrite().save(path)


def basket_line(tid: str = "tid", items: str = "items"):
    """S7 format of a basket: '<tid>: item, item, ...'."""
    return F.concat(F.col(tid).cast("string"), F.lit(": "), F.concat_ws(", ", items))
