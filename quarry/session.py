"""Session construction and checkpoint-directory handling."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files are removed once the checkpointed DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "quarry",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every query here assumes.

    On a cluster leave ``master`` as None so spark-submit decides; the shuffle
    partition count should then be sized to the data (about 128-256 MB per
    partition after the map-side combine), AQE coalesces the rest.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers that do not have it:
    functions in pandas steps are pickled by reference.  The archive holds the
    package's sources only and goes out once per session."""
    root = Path(__file__).resolve().parent
    sc = spark.sparkContext
    if any(Path(f).name == "quarry.zip" for f in getattr(sc, "_python_includes", [])):
        return
    archive = Path(tempfile.mkdtemp(prefix="quarry-")) / "quarry.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for f in sorted(root.rglob("*.py")):
            out.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory, setting it on the context.

    The cluster names it in ``spark.checkpoint.dir``; we only invent one when
    that is unset *and* the session runs in local mode (tests). On a cluster
    without the setting we refuse rather than write to a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint into the shared checkpoint directory (never
    localCheckpoint: its blocks die with the executor).  Used where a derived
    table is read several times by later stages (level-wise mining, iterative
    joins), so the plan does not re-inline its whole lineage each time."""
    from pyspark import StorageLevel
    checkpoint_dir(df.sparkSession)
    # persist first: the checkpoint write is a second job over the same RDD
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = df.checkpoint(eager=eager)
    if eager:
        df.unpersist()
    return out


def few_parts(df, rows: int = 20_000):
    """``df``, which is cheap to read (cut from its lineage), in as many parts as
    tasks run at once, or of ``rows`` rows on average if that is more: adaptive
    execution does not join the small parts of what was checkpointed."""
    return df.coalesce(max(1, df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows)))
