"""Readers for the driver's parquet tables (one file per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# For benchmarks on one-file tables: spread these scans by their row keys where the session asks for it.
SPREAD_CONF = "spark.larder.spreadScans"
ROW_KEYS = {"lineitem": ("l_orderkey", "l_linenumber"), "orders": ("o_orderkey",), "events": ("event_id",)}


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read one table; naming the columns keeps the parquet ReadSchema narrow.

    A parquet file of one row group is read by one task.  Test tables are such
    files; a session that sets `spark.larder.spreadScans` gets their scans
    spread by a hash of the row keys (deterministic on retry).  The setting is
    off by default: large tables have many row groups and need no extra shuffle.
    """
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    df = df.select(*columns) if columns else df
    if spark.conf.get(SPREAD_CONF, "false") != "true":
        return df
    keys = [k for k in ROW_KEYS.get(name, ()) if k in df.columns]
    return df.repartition(spark.sparkContext.defaultParallelism, *keys) if keys else df
