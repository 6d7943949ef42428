"""Helpers that several corpus operators share."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.session import cut_lineage, scratch_path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table once into the shared scratch folder and return the reader of that table.

    A table read by several later jobs is then neither recomputed nor different
    on a second computation, and executors can be lost without losing it.
    """
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_memory() -> None:
    """Give freed memory back to the system at the end of a task: the worker process goes on to other stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has the call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A spanning forest of each batch of edges: the same components by fewer edges."""
    for batch in batches:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while (up := parent.get(top, top)) != top:
                top = up
            while x != top:
                parent[x], x = top, parent.get(x, x)
            return top

        for a, b in zip(batch["a"].tolist(), batch["b"].tolist(), strict=True):
            ra, rb = root(a), root(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
        nodes = list(parent)
        found = pd.DataFrame({"a": nodes, "b": [root(x) for x in nodes]}, dtype="int64")
        yield found[found["a"] != found["b"]]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of `edges` (a long, b long); root is the smallest node reachable.

    Edges are first reduced to a spanning forest per batch, then large-star and
    small-star rounds run until the edges no longer change.  Each round's edges go
    to the checkpoint folder; only a count and a hash sum come to the driver.
    A node with very many neighbours is met by partial minima and by a join that
    adaptive execution can split.
    """
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    e = cut_lineage(e.mapInPandas(_forest, "a long, b long").distinct())
    before = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = now
        both = e.union(e.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
            F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        e = cut_lineage(small.where("a <> b").distinct())
