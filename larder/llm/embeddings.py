"""Near-duplicate embeddings by a subspace pigeonhole join.

Unit vectors with cosine >= c have a squared distance of at most b = 2 - 2c.  All
vectors are rotated and split into blocks of a few dimensions; a block of k of the
d dimensions has the budget b * k / d, and a linked pair keeps within the budget in
at least one block.  Each block is a range join: its space is parted into kd-boxes
(fitted on a bounded sample), a vector is a target in its own box and a probe in all
boxes that its budget's ball reaches.  Pairs within a block's budget are candidates
and are verified by their cosine in double precision on the original components; a
pair that several blocks find counts in the first of them, so nothing but counts
and a spanning forest of the links leaves a box.

Only vectors of equal label and length meet.  Equal vectors of a label are taken
together first, and boxes with many vectors are worked through in tiles, so a
vector that a third of all rows share, or a crowded box, is no single large task.

Edge cases: rows with a null label, a null, empty or zero vector, or one with null
or non-finite components link with nothing (0 links, own component, kept); every
repeated row counts as a vector of its own that shares its vec_id; a row without
vec_id takes no part and has a null component; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import connected_components, materialize
from larder.llm.vectors import SAMPLE_ROWS, box_distances, kd_boxes, leaf_of, rotation, usable

BLOCK_DIMS, BOX_ROWS, TILE_ROWS, STRIP = 8, 8192, 4096, 256
SLACK = 1e-9  # room for rounding in the candidates' distances; links are verified without it


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _blocks(dim: int, block_dims: int) -> list[slice]:
    return [slice(k, min(dim, k + block_dims)) for k in range(0, dim, block_dims)]


def _unit(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _probes(distinct: DataFrame, boxes: dict[int, list], budget: float, block_dims: int) -> DataFrame:
    """Each vector under each block: as a target in its own box, as a probe in every box its ball reaches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = b.column("size").to_numpy()
            for dim in np.unique(sizes).tolist():
                part = b.filter(pa.array(sizes == dim))
                turned = _unit(_matrix(part.column("vec"))) @ rotation(dim)
                for k, block in enumerate(_blocks(dim, block_dims)):
                    x, radius = turned[:, block], budget * (block.stop - block.start) / dim + SLACK
                    fitted = boxes.get(dim)
                    if fitted is None:
                        home, row, box = np.zeros(len(x), np.int32), np.arange(len(x)), np.zeros(len(x), np.int32)
                    else:
                        low, high, tree = fitted[k]
                        home = leaf_of(x, tree)
                        row, box = np.nonzero(box_distances(x, low, high) <= radius)
                    taken = part.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays(
                        [taken.column(c) for c in ("label", "size", "rep", "n", "vec")]
                        + [pa.array(np.full(len(row), k, np.int32)), pa.array(box.astype(np.int32)),
                           pa.array(home[row] == box)],
                        ["label", "size", "rep", "n", "vec", "block", "box", "target"])

    schema = distinct.select("label", "size", "rep", "n", "vec").withColumns(
        {"block": F.lit(0), "box": F.lit(0), "target": F.lit(True)}).schema
    return distinct.mapInArrow(run, schema)


def _forest(node_a: np.ndarray, node_b: np.ndarray, label: np.ndarray) -> None:
    """Merge the classes of `label` (in place) along the links a-b."""
    while True:
        least = np.minimum(label[node_a], label[node_b])
        if (label[node_a] == least).all() and (label[node_b] == least).all():
            return
        old = label.copy()
        np.minimum.at(label, old[node_a], least)
        np.minimum.at(label, old[node_b], least)
        np.minimum.at(label, node_a, least)
        np.minimum.at(label, node_b, least)
        while (label[label] != label).any():
            label[:] = label[label]


def _tile(tile: pa.Table, cosine: float, block_dims: int) -> pa.Table:
    """Rows (rep, links, other): links of the targets of a tile, and edges (other not null) that connect them."""
    dim, block = tile.column("size")[0].as_py(), tile.column("block")[0].as_py()
    target = tile.column("target").to_numpy(zero_copy_only=False)
    probe = tile.column("probe").to_numpy(zero_copy_only=False)
    rep = tile.column("rep").to_numpy()
    weight = tile.column("n").to_numpy().astype(np.int64)
    unit = _unit(_matrix(tile.column("vec").combine_chunks()))
    turned, blocks, budget = unit @ rotation(dim), _blocks(dim, block_dims), 2 - 2 * cosine
    room = [budget * (s.stop - s.start) / dim + SLACK for s in blocks]
    here, those = np.flatnonzero(target), np.flatnonzero(probe)
    x = turned[:, blocks[block]]
    norm = (x * x).sum(axis=1)
    links, label = np.zeros(len(rep), np.int64), np.arange(len(rep))
    for k in range(0, len(here), STRIP):
        rows = here[k:k + STRIP]
        gap = norm[rows, None] + norm[None, those] - 2 * (x[rows] @ x[those].T)
        a, b = np.nonzero(gap <= room[block])
        a, b = rows[a], those[b]
        ok = rep[a] != rep[b]
        for earlier in range(block):  # the pair counts in the first block that finds it
            a, b = a[ok], b[ok]
            away = turned[a, blocks[earlier]] - turned[b, blocks[earlier]]
            ok = (away * away).sum(axis=1) > room[earlier]
        a, b = a[ok], b[ok]
        ok = (unit[a] * unit[b]).sum(axis=1) >= cosine
        a, b = a[ok], b[ok]
        np.add.at(links, a, weight[b])
        if len(a):
            _forest(a, b, label)
    some = np.flatnonzero(links)
    edge = np.flatnonzero(label != np.arange(len(label)))
    return pa.table({"rep": pa.array(np.concatenate((rep[some], rep[edge]))),
                     "links": pa.array(np.concatenate((links[some], np.zeros(len(edge), np.int64)))),
                     "other": pa.array(np.concatenate((rep[some], rep[label[edge]])),
                                       mask=np.arange(len(some) + len(edge)) < len(some))})


def embedding_links(distinct: DataFrame, cosine: float = 0.93, block_dims: int = BLOCK_DIMS,
                    box_rows: int = BOX_ROWS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(rep, links, other): for distinct vectors (label, size, rep, n, vec), see `_tile`."""
    sizes = distinct.groupBy("size").agg(F.count("*").alias("rows")).collect()  # one row per vector length
    most = {r["size"]: r["rows"] for r in distinct.groupBy("label", "size").count()
            .groupBy("size").agg(F.max("count").alias("rows")).collect()}
    sample = distinct.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE_ROWS).select("size", "vec").toArrow()
    boxes: dict[int, list] = {}
    for dim in (r["size"] for r in sizes):
        part = sample.filter(pa.compute.equal(sample.column("size"), dim))
        leaves = min(-(-most[dim] // box_rows), max(1, len(part) // 32))
        if leaves > 1:
            turned = _unit(_matrix(part.column("vec").combine_chunks())) @ rotation(dim)
            boxes[dim] = [kd_boxes(turned[:, s], leaves) for s in _blocks(dim, block_dims)]
    rows = _probes(distinct, boxes, 2 - 2 * cosine, block_dims)

    place = ["label", "size", "block", "box"]
    members = rows.groupBy(*place).agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("parts"))
    rows = rows.join(members, place).withColumn("part", F.pmod(F.xxhash64("rep"), "parts").cast("int"))
    # tile (i, j): the targets of part i against the probes of part j
    as_probe = rows.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("j", F.col("part"))
    as_target = (rows.where("target").withColumn("j", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
                 .withColumn("i", F.col("part")).where("i <> j"))
    own = F.col("target") & (F.col("part") == F.col("i"))
    keep = [*place, "i", "j", "rep", "n", "vec"]
    tiles = as_probe.select(*keep, own.alias("target"), F.lit(True).alias("probe")).unionByName(
        as_target.select(*keep, F.lit(True).alias("target"), F.lit(False).alias("probe")))
    return tiles.groupBy(*place, "i", "j").applyInArrow(lambda t: _tile(t, cosine, block_dims),
                                                        "rep long, links long, other long")


def embedding_near_duplicates(vectors: DataFrame, cosine: float = 0.93, block_dims: int = BLOCK_DIMS,
                              box_rows: int = BOX_ROWS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """vec_id, n_links, component_id, kept per row of `vectors` (vec_id, embedding, label)."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vec"), "label")
    part = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vec"))
    # equal vectors of a label: told apart by two independent 64-bit hashes
    rows = rows.withColumn("key", F.when(part, F.struct(
        "label", F.xxhash64("vec").alias("a"), F.xxhash64(F.reverse("vec"), F.lit(1)).alias("b"))))
    distinct = materialize(rows.where("key is not null").groupBy("key").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("vec").alias("vec"),
        F.first("label").alias("label")).withColumn("size", F.size("vec")), "distinct-vectors")
    found = materialize(embedding_links(distinct.select("label", "size", "rep", "n", "vec"), cosine, block_dims,
                                        box_rows, tile_rows), "links")
    links = found.where("other is null").groupBy("rep").agg(F.sum("links").alias("links"))
    roots = connected_components(found.where("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b")))
    named = (distinct.select("key", "rep", "n").join(links, "rep", "left")
             .join(roots, F.col("rep") == F.col("node"), "left")
             .select("key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                     F.coalesce("root", "rep").alias("component_id")))
    joined = rows.drop("vec", "label").join(named, "key", "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                         component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def op7_embeddings(vectors: DataFrame) -> DataFrame:
    return embedding_near_duplicates(vectors)
