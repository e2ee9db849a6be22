"""Written intermediate tables and small column helpers of the subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir

# Text handed to Python is worked on in slices of about this many bytes, so
# that a batch of very long documents never multiplies in memory.
SLICE_CHARS = 4_000_000


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage like ``checkpoint()``: the files are in shared storage, so
    a lost executor costs nothing, the plan behind them runs once, and their
    size is known to the planner."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/quarry-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def utf8_bytes(col: Column) -> Column:
    """UTF-8 length of a text; null counts as empty."""
    return F.coalesce(F.octet_length(col), F.lit(0)).cast("long")


def cut_batches(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_CHARS
                ) -> Iterator[pa.RecordBatch]:
    """Split Arrow batches, by the offsets of a text column alone, into parts
    of about ``limit`` bytes of text (a longer text is a part of its own).
    Nothing is converted or copied, so that only one part is worked on at a
    time."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
        ends = np.cumsum(size, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_CHARS
                ) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """The parts of ``cut_batches``, each with its texts; null texts become ''."""
    for part in cut_batches(batches, column, limit):
        yield part, ["" if t is None else t for t in part.column(column).to_pylist()]


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c.cast(f.type) if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type)
         for c, f in zip(columns, schema, strict=True)], schema=schema)
