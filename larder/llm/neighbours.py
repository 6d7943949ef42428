"""Approximate nearest neighbours by a few stable projections, a kd-tree and a chi-square stopping test.

Vectors are projected to `WIDTH` dimensions by a matrix of standard normals, so for a
vector at distance d the squared projected distance is d^2 times a chi-square
variable of that many degrees of freedom.  A query takes vectors in the order of
their projected distance, verifies each by its true distance, and may stop at
projected distance r once the chi-square test says that a vector nearer than its
k-th best d_k would lie within r with probability `CONFIDENCE`:
r^2 >= d_k^2 * quantile.

The projected space is parted into cells by a kd-tree fitted on a bounded sample of
rows; every row is indexed.  Each query first searches its home cell, which bounds
its d_k, and then every cell that lies within its stopping radius; in a cell, a
kd-tree of small leaves gives the projected neighbours nearest leaf first, and d_k
shrinks as it goes.  Cells with many rows and cells with many queries are worked
through in blocks.  Equal vectors are indexed once with their `k` + 1 smallest ids
(no more can be among the nearest), so a vector that a third of all rows share is
one entry.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components
are neither queries nor candidates, likewise rows without vec_id; vectors of another
length than the query's are no candidates; rows that repeat a vec_id and its vector
are one candidate; of several vectors with a query's vec_id the one of smallest hash
is the query; with fewer candidates than k all are returned; ties go to the
smaller vec_id.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from larder.llm.common import materialize
from larder.llm.vectors import (SAMPLE_ROWS, box_distances, chi_square_quantile, gaussian, kd_boxes, leaf_of, usable)

NEAREST, WIDTH, CONFIDENCE = 10, 12, 0.97
CELL_ROWS, LEAF_ROWS, QUERY_ROWS = 8192, 64, 2048


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def search_cell(points: np.ndarray, ids: list[list[int]], queries: np.ndarray, own: np.ndarray, bound: np.ndarray,
                k: int, width: int, quantile: float) -> list[list[tuple[float, int]]]:
    """Per query its k nearest (distance, id) found among `points`; `bound`: the squared d_k known so far."""
    matrix = gaussian(points.shape[1], width)
    shadow, seen = points @ matrix, queries @ matrix
    low, high, tree = kd_boxes(shadow, max(1, len(points) // LEAF_ROWS))
    leaf = leaf_of(shadow, tree)
    order = np.argsort(leaf, kind="stable")
    edges = np.searchsorted(leaf[order], np.arange(len(low) + 1))
    tight_low = np.array([shadow[order[a:b]].min(axis=0) if b > a else np.full(width, np.inf)
                          for a, b in zip(edges[:-1], edges[1:], strict=True)])
    tight_high = np.array([shadow[order[a:b]].max(axis=0) if b > a else np.full(width, np.inf)
                           for a, b in zip(edges[:-1], edges[1:], strict=True)])
    full = edges[1:] > edges[:-1]
    found = []
    for q in range(len(queries)):
        away = np.full(len(low), np.inf)
        away[full] = box_distances(seen[q:q + 1], tight_low[full], tight_high[full])[0]
        best: list[tuple[float, int]] = []  # squared distance, id
        limit = float(bound[q])
        for cell in np.argsort(away, kind="stable").tolist():
            if away[cell] > limit * quantile:
                break  # the chi-square test holds for all that is left
            at = order[edges[cell]:edges[cell + 1]]
            gap = shadow[at] - seen[q]
            at = at[(gap * gap).sum(axis=1) <= limit * quantile]
            gap = points[at] - queries[q]
            true = (gap * gap).sum(axis=1)
            near = true <= limit
            for i, d in zip(at[near].tolist(), true[near].tolist(), strict=True):
                best += [(d, x) for x in ids[i] if x != own[q]]
            if len(best) >= k:
                best = sorted(best)[:k]
                limit = min(limit, best[-1][0])
        found.append([(math.sqrt(d), x) for d, x in sorted(best)[:k]])
    return found


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int = NEAREST, width: int = WIDTH,
                       confidence: float = CONFIDENCE, cell_rows: int = CELL_ROWS,
                       query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of `queries` (vec_id, embedding) the k nearest of `vectors`."""
    kind = vectors.schema["embedding"].dataType.simpleString()  # array<float> or array<double>
    pick = lambda df: df.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast(kind).alias("vec")).where(
        F.col("id").isNotNull() & usable(F.col("vec"))).withColumn("size", F.size("vec"))
    keyed = pick(vectors).withColumn("key", F.struct(F.xxhash64("vec").alias("a"),
                                                     F.xxhash64(F.reverse("vec"), F.lit(1)).alias("b")))
    # of equal vectors the k + 1 smallest ids; the rank filter runs before the shuffle too
    few = keyed.dropDuplicates(["key", "id"]).withColumn("nth", F.row_number().over(
        W.partitionBy("key").orderBy("id"))).where(F.col("nth") <= k + 1)
    index = materialize(few.groupBy("key").agg(
        F.array_sort(F.collect_list("id")).alias("ids"), F.first("vec").alias("vec"), F.first("size").alias("size")
    ).drop("key"), "index")
    asked = materialize(pick(queries).groupBy("id").agg(F.min_by("vec", F.xxhash64("vec")).alias("vec"))
                        .withColumn("size", F.size("vec")), "queries")

    quantile = chi_square_quantile(confidence, width)
    rows = {r["size"]: r["rows"] for r in index.groupBy("size").agg(F.count("*").alias("rows")).collect()}
    sample = index.orderBy(F.xxhash64("vec"), F.col("ids")[0]).limit(SAMPLE_ROWS).select("size", "vec").toArrow()
    trees: dict[int, tuple] = {}
    for dim in rows:
        part = sample.filter(pa.compute.equal(sample.column("size"), dim))
        leaves = min(-(-rows[dim] // cell_rows), max(1, len(part) // 16))
        shadow = (_matrix(part.column("vec")) @ gaussian(dim, width)) if len(part) else np.empty((0, width))
        trees[dim] = kd_boxes(shadow, leaves)

    def routed(df: DataFrame, schema: str, ball: bool) -> DataFrame:
        """`df` (size, vec, bound...) with `cell`: the home cell, or all cells within the stopping radius but home."""
        names = df.columns

        def run(batches):
            for b in batches:
                sizes = b.column("size").to_numpy()
                for dim in np.unique(sizes).tolist():
                    if dim not in trees:
                        continue
                    low, high, tree = trees[dim]
                    part = b.filter(pa.array(sizes == dim))
                    shadow = _matrix(part.column("vec")) @ gaussian(dim, width)
                    home = leaf_of(shadow, tree)
                    if ball:
                        reach = part.column("bound").to_numpy() * quantile
                        row, cell = np.nonzero(box_distances(shadow, low, high) <= reach[:, None])
                        row, cell = row[cell != home[row]], cell[cell != home[row]]
                    else:
                        row, cell = np.arange(len(home)), home
                    taken = part.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays(taken.columns + [pa.array(cell.astype(np.int32))], [*names, "cell"])

        return df.mapInArrow(run, schema)

    placed = materialize(routed(index, f"ids array<long>, vec {kind}, size int, cell int", False), "cells")
    crowd = materialize(placed.groupBy("size", "cell").agg(F.ceil(F.count("*") / cell_rows).cast("int").alias("parts")),
                        "cell-sizes")

    def search(sent: DataFrame) -> DataFrame:
        """(query, vec_id, score) of queries sent to cells."""
        blocks = sent.groupBy("size", "cell").agg(F.ceil(F.count("*") / query_rows).cast("int").alias("blocks"))
        sizes = crowd.join(blocks, ["size", "cell"])
        ask = sent.join(sizes, ["size", "cell"]).select(
            "size", "cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
            F.pmod(F.xxhash64("id"), "blocks").cast("int").alias("block"), F.array("id").alias("ids"), "vec", "bound")
        have = placed.join(sizes, ["size", "cell"]).select(
            "size", "cell", F.pmod(F.xxhash64("vec"), "parts").cast("int").alias("part"),
            F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "ids", "vec",
            F.lit(None).cast("double").alias("bound"))

        def run(t: pa.Table) -> pa.Table:
            is_query = pa.compute.is_valid(t.column("bound"))
            q, p = t.filter(is_query), t.filter(pa.compute.invert(is_query))
            rows = []
            if len(q) and len(p):
                own = np.array([x[0] for x in q.column("ids").to_pylist()], np.int64)
                found = search_cell(_matrix(p.column("vec")), p.column("ids").to_pylist(), _matrix(q.column("vec")),
                                    own, q.column("bound").to_numpy(), k, width, quantile)
                rows = [(int(o), x, d) for o, f in zip(own, found, strict=True) for d, x in f]
            cols = list(zip(*rows, strict=True)) or [[]] * 3
            return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()),
                             "score": pa.array(cols[2], pa.float64())})

        return ask.unionByName(have).groupBy("size", "cell", "part", "block").applyInArrow(
            run, "query_id long, vec_id long, score double")

    best = W.partitionBy("query_id").orderBy("score", "vec_id")
    top = lambda df: df.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    home = routed(asked.withColumn("bound", F.lit(float("inf"))),
                  f"id long, vec {kind}, size int, bound double, cell int", False)
    first = materialize(top(search(home)), "home-cells")
    known = first.where(F.col("rank") == k).select(F.col("query_id").alias("id"), (F.col("score") ** 2 * (1 + 1e-12)).alias("bound"))
    again = asked.join(known, "id", "left").select("id", "vec", "size", F.coalesce("bound", F.lit(float("inf"))).alias("bound"))
    far = search(routed(again, f"id long, vec {kind}, size int, bound double, cell int", True))
    return top(first.drop("rank").unionByName(far)).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id",
                                                           "score")


def op8_neighbours(vectors: DataFrame) -> DataFrame:
    return nearest_neighbours(vectors, vectors.where(F.col("vec_id") % 100 == 0))
