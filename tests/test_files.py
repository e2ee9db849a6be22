"""Sinks and sources round-trip through a scratch folder."""

import json
import tempfile
from pathlib import Path

from pyspark.sql import functions as F

from quarry.sources import files


def test_csv_json_text_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="quarry-files-")
    df = spark.createDataFrame([(1, "a", 2.5), (2, "n/a", None)], "id int, name string, x double")
    files.write_csv(df, f"{d}/csv")
    back = files.read_csv(spark, f"{d}/csv", "id int, name string, x double")
    assert sorted((r["id"], r["name"]) for r in back.collect()) == [(1, "a"), (2, None)]
    files.write_json(df.withColumn("length", F.col("id")), f"{d}/json", partition_by=["length"])
    assert spark.read.json(f"{d}/json").count() == 2
    files.write_text(df, f"{d}/txt", F.concat_ws(":", "id", "name"))
    assert sorted(r[0] for r in spark.read.text(f"{d}/txt").collect()) == ["1:a", "2:n/a"]
    with open(f"{d}/map.json", "w") as fh:
        json.dump({"old": "new", "a": "b"}, fh)
    assert files.read_mapping(spark, f"{d}/map.json") == {"old": "new", "a": "b"}


def test_signed_csv(spark):
    d = tempfile.mkdtemp(prefix="quarry-files-")
    rows = [(i, f"größe {i}", i / 2) for i in range(20)]
    schema = "id int, name string, x double"
    df = spark.createDataFrame(rows, schema).repartition(3)
    files.write_csv(df, f"{d}/signed", signed=True)
    parts = sorted(Path(f"{d}/signed").glob("part-*"))
    assert len(parts) == 3
    for part in parts:
        raw = part.read_bytes()
        assert raw.startswith(b"\xef\xbb\xbfid,name,x\n") and raw.count(b"\xef\xbb\xbf") == 1
    assert sorted(map(tuple, files.read_csv(spark, f"{d}/signed", schema).collect())) == rows
    assert files.read_csv(spark, f"{d}/signed").columns == ["id", "name", "x"]
    files.write_csv(df, f"{d}/plain")
    assert not next(Path(f"{d}/plain").glob("part-*")).read_bytes().startswith(b"\xef")


def test_model_sink_roundtrip(spark):
    from pyspark.ml.clustering import KMeans, KMeansModel
    from pyspark.ml.functions import array_to_vector
    d = tempfile.mkdtemp(prefix="quarry-model-")
    df = spark.createDataFrame([([0.0, 0.0],), ([0.1, 0.0],), ([5.0, 5.0],), ([5.1, 5.0],)], "v array<double>")
    vdf = df.select(array_to_vector("v").alias("features"))
    m = KMeans(k=2, seed=1).fit(vdf)
    files.save_model(m, f"{d}/kmeans")
    back = KMeansModel.load(f"{d}/kmeans")
    assert sorted(map(tuple, back.clusterCenters())) == sorted(map(tuple, m.clusterCenters()))
