"""A9 / A7 incrementally: share of empty 15-minute slots per (series, day)
over an event stream.

Two chained event-time aggregations in append mode: events -> one row per
occupied (series, 15-minute window) once the watermark passes it -> count of
occupied slots per (series, day).  State is bounded by the watermark (open
windows only), never by the stream's length.  ``missing_ratio`` = 1 -
occupied / 96 matches the batch ``daily_missing_ratio`` on days inside the
series' span (the batch grid also counts days before the first event).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
SLOTS_PER_DAY = 96


def event_stream(spark: SparkSession, directory: str, glob: str = "events*.parquet",
                 max_files: int = 1) -> DataFrame:
    return (spark.readStream.schema(EVENT_SCHEMA).option("pathGlobFilter", glob)
            .option("maxFilesPerTrigger", max_files).parquet(directory))


def daily_availability(events: DataFrame, watermark: str = "1 day") -> DataFrame:
    # Watermarks need a zone-aware TIMESTAMP; build it from the zone-less value's
    # UTC epoch (a plain cast would shift by the session offset), and label days
    # from epoch days, so windows and dates do not depend on the session zone.
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    ts = F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, F.col("ts")))
    ev = events.select(F.col("event_type").alias("series"), ts.alias("ts"))
    slots = (ev.withWatermark("ts", watermark)
             .groupBy("series", F.window("ts", "15 minutes").alias("slot"))
             .agg(F.count(F.lit(1)).alias("events")))
    days = (slots.groupBy("series", F.window(F.window_time("slot"), "1 day").alias("day"))
            .agg(F.count(F.lit(1)).alias("occupied"), F.sum("events").alias("events")))
    day = F.date_from_unix_date(F.floor(F.unix_seconds(F.col("day.start")) / 86400).cast("int"))
    return days.select("series", day.alias("date"), "occupied", "events",
                       (1.0 - F.col("occupied") / SLOTS_PER_DAY).alias("missing_ratio"))


def run_available_now(spark: SparkSession, directory: str, query_name: str = "daily_availability") -> DataFrame:
    """Drive the stream over the files present now (availableNow trigger) into
    a Parquet file sink and read it back.  Result and checkpoint are in a new
    folder of the shared checkpoint directory, so a second run starts afresh
    and nothing is held in the driver."""
    from ..session import checkpoint_dir
    base = f"{checkpoint_dir(spark).rstrip('/')}/stream-{query_name}-{uuid.uuid4().hex}"
    days = daily_availability(event_stream(spark, directory))
    q = (days.writeStream.outputMode("append").format("parquet").option("path", f"{base}/out")
         .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(days.schema).parquet(f"{base}/out")
