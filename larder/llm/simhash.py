"""SimHash near-duplicates by an inverted index on byte positions with count filtering.

A fingerprint has eight positional bytes.  Two fingerprints that differ in at
most d <= 7 bits differ in at most d bytes, so they share at least 8 - d
positional bytes: the guaranteed minimum.  An index with a posting list per
(position, byte) would hold a 256th of the corpus per list, so the postings
here are keyed by groups of positions that every pair with the guaranteed
minimum must share at least once (for d <= 3: the 14 blocks of the Steiner
system S(3,4,8)).  Within a posting list the shared positional bytes of each
pair are tallied, pairs below the minimum dropped, and the rest verified by
their bit distance.  Posting lists that stay too long are indexed again by
further bits, so that no task ever meets an unbounded list, and a list gives a
spanning forest of its links instead of all its pairs.

Edge cases: a null text counts as empty; a text without words has fingerprint
zero and is linked like any other; repeated rows have the same fingerprint and
the same component; rows without doc_id keep a fingerprint and component but
never name a component.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import connected_components, materialize
from larder.session import cut_lineage

LIST_ROWS = 4096  # a posting list beyond this is indexed again by further bits
FULL = (1 << 64) - 1


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """64-bit SimHash over `width`-word shingles of the ASCII-lower-cased text, as a signed integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII rules only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - width + 1)
    digest, last = xxhash.xxh64_intdigest, min(width, len(words)) - 1
    h = np.array([digest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), ends[last:last + n].tolist(),
                                                            strict=True)], np.uint64)
    ones = np.zeros(64, np.int64)
    for k in range(0, n, 1 << 16):
        bits = np.unpackbits(h[k:k + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", width: int = 3, seed: int = 42) -> DataFrame:
    """`docs` without its text, with `fp` (signed 64-bit fingerprint).  Other columns are kept."""
    keep = [c for c in docs.columns if c not in (text, "fp")]
    src = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__text"))
    schema = src.drop("__text").withColumn("fp", F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = pa.array([fingerprint(t.as_py(), width, seed) for t in b.column("__text")], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [fp], keep + ["fp"])

    return src.mapInArrow(run, schema)


def _position_groups(distance: int) -> list[int]:
    """64-bit masks of byte groups; any 8 - distance positions contain one of the groups."""
    if not 0 <= distance <= 7:
        raise ValueError("the byte index serves distances from 0 to 7")
    if distance <= 3:  # the affine planes over three bits: any five positions contain one
        groups = [g for g in combinations(range(8), 4) if g[0] ^ g[1] ^ g[2] ^ g[3] == 0]
    else:
        groups = list(combinations(range(8), 8 - distance))
    return [sum(0xFF << (8 * p) for p in g) for g in groups]


def _children(mask: int, distance: int) -> list[int]:
    """The free bits in distance + 1 fields: a pair of the list agrees on one of them."""
    free = [b for b in range(64) if not mask >> b & 1]
    parts = np.array_split(np.array(free, dtype=object), distance + 1)
    return [mask | sum(1 << int(b) for b in part) for part in parts if len(part)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _postings(df: DataFrame, masks_of) -> DataFrame:
    """(mask, key, fp) rows: each fingerprint of (mask, fp) under each child mask."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for mask, part in b.groupby("mask"):
                fp = part["fp"].to_numpy()
                for child in masks_of(int(mask) & FULL):
                    m = np.int64(_signed(child))
                    yield pd.DataFrame({"mask": np.full(len(fp), m), "key": fp & m, "fp": fp})

    return df.select("mask", "fp").mapInPandas(run, "mask long, key long, fp long")


def links_of(fps: np.ndarray, distance: int) -> tuple[list[int], list[int]]:
    """A spanning forest of the links among the fingerprints of one posting list.

    Each fingerprint is held once against those not yet reached: shared
    positional bytes are tallied, pairs below the guaranteed minimum dropped,
    and the bit distance of the others verified.
    """
    left, right, least = [], [], 8 - distance
    if len(fps) == 2:  # most lists
        x = int(fps[0] ^ fps[1]) & FULL
        if sum(not x >> s & 0xFF for s in range(0, 64, 8)) >= least and x.bit_count() <= distance:
            return [int(fps[0])], [int(fps[1])]
        return left, right
    unreached = fps
    while len(unreached):
        stack, unreached = [unreached[0]], unreached[1:]
        while stack and len(unreached):
            top = stack.pop()
            x = unreached ^ top
            tally = 8 - (x.view(np.uint8).reshape(-1, 8) != 0).sum(axis=1)
            near = tally >= least
            near[near] = np.bitwise_count(x[near].view(np.uint64)) <= distance
            found = unreached[near]
            if len(found):
                left += [int(top)] * len(found)
                right += found.tolist()
                stack += list(found)
                unreached = unreached[~near]
    return left, right


def _list_links(postings: DataFrame, distance: int) -> DataFrame:
    """(a, b) links of bounded posting lists, one partition-ordered pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        rest: list[np.ndarray] = []

        def lists(block: np.ndarray) -> pd.DataFrame:
            cut = np.flatnonzero((np.diff(block[:, :2], axis=0) != 0).any(axis=1)) + 1
            edges = np.concatenate(([0], cut, [len(block)]))
            some = np.flatnonzero(np.diff(edges) > 1)
            fps = np.ascontiguousarray(block[:, 2])
            found = [links_of(fps[edges[s]:edges[s + 1]], distance) for s in some]
            a, b = ([x for f in found for x in f[k]] for k in (0, 1))
            return pd.DataFrame({"a": a, "b": b}, dtype="int64")

        for batch in batches:
            block = np.column_stack([batch[c].to_numpy() for c in ("mask", "key", "fp")])
            if rest:
                block = np.concatenate([*rest, block])
            last = np.flatnonzero((block[:, :2] != block[-1, :2]).any(axis=1))
            cut = int(last[-1]) + 1 if len(last) else 0
            rest = [block[cut:]]  # the open list, at most LIST_ROWS rows
            if cut:
                yield lists(block[:cut])
        if rest:
            yield lists(rest[0])

    def arrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in run(batches):
            yield pa.RecordBatch.from_pandas(found, preserve_index=False)

    ordered = postings.repartition("mask", "key").sortWithinPartitions("mask", "key", "fp")
    return ordered.mapInArrow(arrow, "a long, b long")


def fingerprint_links(distinct: DataFrame, distance: int = 3, list_rows: int = LIST_ROWS) -> DataFrame:
    """(a, b) links that connect all distinct fingerprints (`fp`) within `distance` bits of each other."""
    groups = _position_groups(distance)
    postings = materialize(_postings(distinct.select(F.lit(0).cast("long").alias("mask"), "fp"),
                                     lambda _: groups), "postings")
    found = None
    while True:
        sizes = postings.groupBy("mask", "key").count()
        long = cut_lineage(sizes.where(F.col("count") > list_rows).select("mask", "key"))
        more = not long.isEmpty()
        links = _list_links(postings.join(long, ["mask", "key"], "left_anti") if more else postings, distance)
        found = links if found is None else found.unionByName(links)
        if not more:
            return found
        heavy = postings.join(long, ["mask", "key"], "left_semi")
        postings = materialize(_postings(heavy, lambda mask: _children(mask, distance)), "postings")


def simhash_near_duplicates(docs: DataFrame, width: int = 3, distance: int = 3, seed: int = 42,
                            list_rows: int = LIST_ROWS) -> DataFrame:
    """(doc_id, fp, component_id) per row of `docs`; component_id is the smallest doc_id linked to it."""
    rows = materialize(fingerprints(docs.select("doc_id", "text"), width=width, seed=seed), "fingerprints")
    distinct = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = connected_components(fingerprint_links(distinct, distance, list_rows))
    placed = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = placed.join(least, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def op1_simhash(docs: DataFrame) -> DataFrame:
    found = simhash_near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
