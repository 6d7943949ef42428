"""Line de-duplication by pairwise alignment with earlier documents.

Documents of the same lines are one class: of each the earliest (smallest doc_id)
stays and the others lose all their lines, however short and however many
copies there are.  What follows works on the classes' first documents, so copies
change no count.

Every line that is not blank gets a hash of its content and of how often it has
occurred in its document so far, so a line hash is unique within a document.
Hashes of at most `rare_docs` documents are rare and pair each of their documents with every earlier one of
them, so a rare hash makes a bounded number of pairs.  The others pair a document with their
owner only, the earliest document that holds them, and so does every run of 2, 4, 8, .. such lines in a row
with the owner of the run: linear (but for a logarithm), and any run that an earlier document holds is covered
by two runs whose owners hold them.

Each pair is aligned by all lines that it shares, rare or not, by patience diff
(longest increasing run of positions); aligned lines that follow each other in
both documents form common blocks.  A block is deleted from the later document if
it has a rare line, of whatever length, or at least `min_chars` characters in all.

Edge cases: a null text counts as empty and stays as it is; blank lines are never
matched and stay; rows that repeat a doc_id are one document met twice and delete
nothing from each other; rows without doc_id are returned unchanged; an empty
table gives an empty table; other columns are kept, `n_chars` is set anew where
there is one.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import materialize

MIN_CHARS = 20
RARE_DOCS = 16
WHOLE = -1  # stands for the position of a whole document
BLANK = " \t\n\x0b\x0c\r"


def line_hashes(text: str) -> Iterator[tuple[int, int, str]]:
    """(number of the line, hash of its content and occurrence, content) of lines that are not blank."""
    seen: dict[str, int] = {}
    for k, line in enumerate(text.split("\n")):
        line = line.strip(BLANK)
        if line:
            n = seen.get(line, 0)
            seen[line] = n + 1
            h = xxhash.xxh64_intdigest(line.encode("utf-8", "surrogatepass"), n)
            yield k, h - (1 << 64) if h >> 63 else h, line


def whole_hash(hashes: list[int]) -> int:
    """One hash for all the lines of a document."""
    h = xxhash.xxh64_intdigest(np.array(hashes, np.int64).tobytes())
    return h - (1 << 64) if h >> 63 else h


def exploded_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, pos, hash, size, whole): `pos` counts the lines that are not blank, `size` their characters up to
    `min_chars`, `whole` is the hash of all of the document's lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, sizes, hashes, chars, whole = [], [], [], [], []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                found = [(h, min(len(line), min_chars)) for _, h, line in line_hashes(text.as_py() or "")]
                ids.append(doc_id)
                sizes.append(len(found))
                whole.append(whole_hash([h for h, _ in found]) if found else 0)
                hashes += [h for h, _ in found]
                chars += [n for _, n in found]
            n = np.array(sizes, np.int64)
            pos = np.arange(len(hashes)) - np.repeat(np.cumsum(n) - n, n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(ids, np.int64), n)), pa.array(pos.astype(np.int32)), pa.array(hashes, pa.int64()),
                 pa.array(chars, pa.int32()), pa.array(np.repeat(np.array(whole, np.int64), n))],
                ["doc_id", "pos", "hash", "size", "whole"])

    return docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(run, "doc_id long, pos int, hash long, size int, whole long")


def runs(lines: DataFrame) -> DataFrame:
    """(doc_id, run): a hash of every 2, 4, 8, .. lines of `lines` (doc_id, pos, hash) that follow each other in a document."""

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mix = np.uint64(0x9E3779B97F4A7C15)
        for b in batches:
            ids, found = [], []
            for doc_id, rows in zip(b.column("doc_id").to_pylist(), b.column("rows"), strict=True):
                pos = rows.values.field(0).to_numpy()
                h = rows.values.field(1).to_numpy().view(np.uint64)
                order = np.argsort(pos, kind="stable")
                pos, h, step = pos[order], h[order], 1
                while step < len(pos):
                    next_ = np.searchsorted(pos, pos + step)  # rows that repeat a doc_id may hold a position twice
                    ok = np.flatnonzero(next_ < len(pos))
                    ok = ok[pos[next_[ok]] == pos[ok] + step]
                    if not len(ok):
                        break
                    pos, h = pos[ok], (h[ok] * mix ^ (h[ok] >> np.uint64(31))) * np.uint64(2 * step + 1) + h[next_[ok]]
                    ids.append(np.full(len(h), doc_id))
                    found.append(h.view(np.int64))
                    step *= 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x) if x else np.empty(0, np.int64), pa.int64()) for x in (ids, found)], ["doc_id", "run"])

    return lines.groupBy("doc_id").agg(F.collect_list(F.struct("pos", "hash")).alias("rows")).mapInArrow(
        one, "doc_id long, run long")


def aligned_blocks(pairs: list[tuple[int, int, int]], enough: int = 1) -> list[tuple[int, int]]:
    """Blocks (first, last position) of the later document that patience diff aligns with an earlier one.

    `pairs`: (position, position in the earlier one, weight) of the shared hashes of one pair of
    documents; a block counts if its weights add up to `enough`.
    """
    pairs = sorted(pairs)
    tails: list[int] = []  # earlier document's positions that end the best run of each length
    ends: list[int] = []
    back: list[int] = []
    for k, (_, theirs, _) in enumerate(pairs):
        at = bisect_left(tails, theirs)
        back.append(ends[at - 1] if at else -1)
        if at == len(tails):
            tails.append(theirs)
            ends.append(k)
        else:
            tails[at], ends[at] = theirs, k
    run, k = [], ends[-1] if ends else -1
    while k >= 0:
        run.append(pairs[k])
        k = back[k]
    run.reverse()
    blocks, start = [], 0
    for k in range(1, len(run) + 1):
        if k == len(run) or run[k][0] != run[k - 1][0] + 1 or run[k][1] != run[k - 1][1] + 1:
            if sum(weight for *_, weight in run[start:k]) >= enough:
                blocks.append((run[start][0], run[k - 1][0]))
            start = k
    return blocks


def overlaps(docs: DataFrame, min_chars: int = MIN_CHARS, rare_docs: int = RARE_DOCS) -> DataFrame:
    """(doc_id, shared): the hashes shared with each partner, an earlier document, as (owner, pos, owner_pos, weight, hash);
    for a copy of an earlier document the position is WHOLE and the hash that of all of its lines."""
    lines = materialize(exploded_lines(docs, min_chars), "lines")
    texts = lines.where("pos = 0").select("doc_id", "whole").distinct()
    classes = materialize(texts.groupBy("whole").agg(F.min("doc_id").alias("doc_id")), "classes")
    copies = texts.join(classes, ["doc_id", "whole"], "left_anti")
    lines = lines.join(classes, ["doc_id", "whole"], "left_semi").drop("whole")
    owned = lines.groupBy("hash").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("last > first")
    held = materialize(lines.join(owned.drop("last"), "hash").distinct(), "shared-lines")  # repeated rows count once
    holders = held.select("hash", "doc_id").distinct().groupBy("hash").agg((F.count("*") <= rare_docs).alias("rare"))
    marked = materialize(held.join(holders, "hash"), "marked-lines")
    rare, common = marked.where("rare").drop("rare"), marked.where("not rare").drop("rare")
    theirs = lambda rows: rows.select("hash", F.col("doc_id").alias("owner"), F.col("pos").alias("owner_pos"))
    columns = ["doc_id", "owner", "pos", "owner_pos", "weight", "hash"]
    by_rare = rare.join(theirs(rare), "hash").where("doc_id > owner").withColumn("weight", F.lit(min_chars)).select(*columns)
    run = runs(common)
    run_owners = run.groupBy("run").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last")).where("last > owner")
    pairs = materialize(by_rare.select("doc_id", "owner").unionByName(
        common.where("doc_id > first").select("doc_id", F.col("first").alias("owner"))).unionByName(
        run.join(run_owners, "run").where("doc_id > owner").select("doc_id", "owner")).distinct(), "pairs")
    by_common = common.withColumnRenamed("size", "weight").join(pairs, "doc_id").join(theirs(common), ["owner", "hash"])
    whole = copies.select("doc_id", F.col("doc_id").alias("owner"), F.lit(WHOLE).alias("pos"), F.lit(WHOLE).alias("owner_pos"),
                          F.lit(min_chars).alias("weight"), F.col("whole").alias("hash"))
    shared = by_rare.unionByName(by_common.select(*columns)).unionByName(whole)
    return shared.groupBy("doc_id").agg(
        F.collect_list(F.struct("owner", "pos", "owner_pos", "weight", "hash")).alias("shared"))


def delete_common_blocks(docs: DataFrame, min_chars: int = MIN_CHARS, rare_docs: int = RARE_DOCS) -> DataFrame:
    """`docs` without the line blocks that an earlier document has; all rows and columns are kept."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    found = overlaps(docs.select("doc_id", "text"), min_chars, rare_docs).withColumnRenamed("doc_id", "__id")
    joined = docs.select(row.alias("__row"), F.col("doc_id").alias("__doc"), F.col("text").cast("string").alias("__text"))
    joined = joined.join(found, joined["__doc"] == found["__id"], "left").drop("__id", "__doc")
    schema = joined.select("__row", "__text").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for text, shared in zip(b.column("__text"), b.column("shared"), strict=True):
                text, shared = text.as_py(), shared.as_py()
                texts.append(remove_blocks(text, shared, min_chars) if shared else text)
            yield pa.RecordBatch.from_arrays([b.column("__row"), pa.array(texts, pa.string())], ["__row", "__text"])

    cleaned = joined.mapInArrow(run, schema)
    columns = [F.col("__text").alias("text") if c == "text"
               else F.coalesce(F.char_length("__text"), F.lit(0)).cast(t).alias(c) if c == "n_chars"
               else F.col(f"__row.`{c}`").alias(c) for c, t in docs.dtypes]
    return cleaned.select(*columns)


def remove_blocks(text: str, shared: list[dict], min_chars: int = MIN_CHARS) -> str:
    """`text` without the blocks aligned with its partners."""
    lines = text.split("\n")
    numbers, hashes = [], []
    for k, h, _ in line_hashes(text):
        numbers.append(k)
        hashes.append(h)
    by_owner: dict[int, set[tuple[int, int, int]]] = {}
    if any(s["pos"] == WHOLE and s["hash"] == whole_hash(hashes) for s in shared):  # an earlier document has the same lines
        dropped = set(numbers)
        return "\n".join(line for k, line in enumerate(lines) if k not in dropped)
    for s in shared:  # rows that repeat a doc_id come together here; each goes by its own lines
        if WHOLE < s["pos"] < len(hashes) and hashes[s["pos"]] == s["hash"]:
            by_owner.setdefault(s["owner"], set()).add((s["pos"], s["owner_pos"], s["weight"]))
    gone: set[int] = set()
    for pairs in by_owner.values():
        for first, last in aligned_blocks(list(pairs), min_chars):
            gone.update(range(first, last + 1))
    dropped = {numbers[p] for p in gone}
    return "\n".join(line for k, line in enumerate(lines) if k not in dropped)


def op5_lines(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines and n_deleted (lines that are not blank), the text that stays, its n_chars and kept_crc32 per document."""
    texts = docs.select("doc_id", "text", F.col("text").alias("before"))
    count = lambda c: F.size(F.filter(F.split(F.coalesce(c, F.lit("")), "\n"), lambda x: x.rlike(r"\S")))
    cleaned = delete_common_blocks(texts)
    return cleaned.select("doc_id", "text", count(F.col("before")).alias("n_lines"),
                          (count(F.col("before")) - count(F.col("text"))).alias("n_deleted"),
                          F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"),
                          F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("kept_crc32"))
