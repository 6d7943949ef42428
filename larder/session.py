"""Session construction and lineage cutting.

On a cluster the session already exists and ``spark.checkpoint.dir`` names a
shared folder; we only read it.  A folder of our own is set only when the
setting is missing (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join side even where the series window behind it then needs another shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str | None = None,
    app: str = "larder",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder named by the session, setting one only if unset."""
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if configured:
        if sc.getCheckpointDir() is None:  # each call would make another folder below it
            sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="larder-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path inside the shared checkpoint folder for intermediate tables."""
    return os.path.join(ensure_checkpoint_dir(spark), "tables", name)


BROADCAST_ROWS = 1 << 18


def few(df: DataFrame) -> DataFrame:
    """A table of keys with few values each, broadcast up to `BROADCAST_ROWS` rows (counted), else joined."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a table of its own into the scratch folder, once, and return its reader: what reads it often recomputes nothing."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
