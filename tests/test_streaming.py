"""The streaming availability profile agrees with the batch aggregation on
the days the stream has closed."""

import pytest
from pyspark.sql import functions as F

from quarry.streaming.availability import SLOTS_PER_DAY, run_available_now

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata"])
def test_stream_matches_batch(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        out = run_available_now(spark, SF, "avail_" + zone.replace("/", "_"))
        _check(spark, out)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def _check(spark, out):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    batch = (ev.select(F.col("event_type").alias("series"), F.to_date("ts").alias("date"),
                       F.date_trunc("minute", "ts").alias("m"), F.minute("ts").alias("mi"), F.hour("ts").alias("h"))
             .select("series", "date", (F.col("h") * 4 + (F.col("mi") / 15).cast("int")).alias("slot"))
             .groupBy("series", "date").agg(F.count_distinct("slot").alias("occupied")))
    got = {(r["series"], r["date"]): r["occupied"] for r in out.collect()}
    want = {(r["series"], r["date"]): r["occupied"] for r in batch.collect()}
    assert got, "the stream emitted no closed day"
    for key, occ in got.items():
        assert want[key] == occ
        assert 0 < occ <= SLOTS_PER_DAY
