"""Ranked lexical search by Block-Max MaxScore over sharded inverted indexes.

Index (`build_index`): each partition cuts its documents into shards of bounded
size, sorted by doc_id, and writes a row per shard and term: the postings
(document number and frequency) in compressed blocks of 128, and for each block
its last document and its outline, the (frequency, length) pairs that no other
pair of the block beats in both.  A posting's worth rises with the frequency
and falls with the document's length, so whatever the collection's statistics
turn out to be, a block's greatest worth is that of a pair of its outline: shards never
wait for the totals, and new shards can be added.

Search (`search`): counts over the index give N, L and every query term's df
and weight.  Queries go in blocks of `query_block`; the lists of a block's
terms meet the block's queries in one task per shard.  There, for each query,
lists are ordered by their bound (weight times greatest worth in the shard).
The longest prefix of lists whose bounds together cannot beat the k-th score so far
is not essential: only documents of the other, essential lists are candidates, and of
these, those whose score so far plus the maxima of the blocks that would hold
them cannot beat it are rejected before any block of a non-essential list is
decompressed.  The others are completed list by list, with the same test.  The heaps of all
shards are merged by a window over (query, score, doc_id).

Documents of a shard are met by rising doc_id, so a later document must beat
the k-th score, and equal scores go to the smaller doc_id.  All scores are
64-bit integers; results are exactly those of scoring everything.

Edge cases: a null or empty text, or one without terms, is in no list and does not
count in N; queries without terms or with unknown terms only have no rows, nor
has a document with score 0; rows without doc_id come last among equal scores;
repeated rows are documents (or queries) like any other; a very long text makes
a shard of its own; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from larder.llm.common import materialize, release_memory
from larder.session import scratch_path

# Fixed values of the ranking: what a term is, and the weights in the integer score.
SEPARATORS = "\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
LENGTH_SHARE, TF_SCALE, WORTH_SCALE = 25, 12, 1_000_000_000

BLOCK, TOP = 128, 20
SHARD_CHARS, SHARD_DOCS = 1 << 24, 1 << 14  # a shard's size; a task holds one at a time
QUERY_BLOCK = 256
BROADCAST_TERMS = 1 << 18  # distinct query terms that are sent to every task; more are joined
#: A list: its blocks' last documents, the number of pairs and the pairs (frequency, length) of their outlines, and its
#: postings.  A shard's documents (term null): their ids, lengths and whether they have an id.
INDEX_SCHEMA = ("shard long, term string, df long, last binary, outline_sizes binary, outline binary, gaps binary, "
                "tfs binary, tokens long")
INDEX_ARROW = pa.schema([(c.split()[0], {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[c.split()[1]])
                         for c in INDEX_SCHEMA.split(", ")])


#: Per byte of UTF-8: a space for what separates terms, lower case for A-Z, every other byte itself.
TERM_BYTES = re.sub(f"[{SEPARATORS}]", " ", "".join(map(chr, range(128)))).lower().encode() + bytes(range(128, 256))


def terms_of(text: str | None) -> list[bytes]:
    """Terms in their order, in UTF-8."""
    return text.encode().translate(TERM_BYTES).split() if text else []


def length_weight(n: np.ndarray, docs: int, tokens: int) -> np.ndarray:
    """A document's m: what its length adds below the line (exact; by Python's integers where 64 bits are too few)."""
    top = int(n.max(initial=0))
    if LENGTH_SHARE * top * max(docs, 1) < 1 << 63:
        return 100 - LENGTH_SHARE + (LENGTH_SHARE * n * docs) // max(tokens, 1)
    return np.array([100 - LENGTH_SHARE + (LENGTH_SHARE * int(x) * docs) // tokens for x in n], np.int64)


def worth(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (WORTH_SCALE * tf) // (1000 * tf + TF_SCALE * m)


def weight(df: int, docs: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


# ---------------------------------------------------------------- index


class _Numbered(dict):
    """Numbers its keys as they come."""

    def __missing__(self, key: bytes) -> int:
        self[key] = n = len(self)
        return n


def _binary(kind: pa.DataType, data: bytes, offsets: np.ndarray) -> pa.Array:
    """An Arrow array of slices of `data`, without a Python object for each."""
    place = pa.py_buffer(offsets.astype(np.int64))
    big = pa.Array.from_buffers(pa.large_string() if kind == pa.string() else pa.large_binary(), len(offsets) - 1,
                                [None, place, pa.py_buffer(data)])
    return big.cast(kind)


def _offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, .. of each range, one after the other."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - _offsets(sizes)[:-1], sizes)


class Shard:
    """Documents gathered for one shard; `batches` are its index rows."""

    def __init__(self):
        self.terms, self.ids, self.words, self.chars = _Numbered(), [], [], 0

    def add(self, doc_id: int | None, terms: list[bytes], chars: int) -> None:
        self.ids.append(doc_id)
        self.words.append(np.fromiter(map(self.terms.__getitem__, terms), np.int64, len(terms)))
        self.chars += chars

    def batches(self, number: int) -> Iterator[pa.RecordBatch]:
        if not self.ids:
            return
        docs = len(self.ids)
        order = sorted(range(docs), key=lambda k: (self.ids[k] is None, self.ids[k] or 0))
        lengths = np.array([len(self.words[k]) for k in order], np.int64)
        known = np.array([self.ids[k] is not None for k in order])
        ids = np.array([self.ids[k] or 0 for k in order], np.int64)
        head = [number, None, docs, ids.tobytes(), None, lengths.tobytes(), known.tobytes(), None, int(lengths.sum())]
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(head, INDEX_ARROW, strict=True)],
                                         schema=INDEX_ARROW)
        place = np.repeat(np.arange(docs), lengths)
        key, tf = np.unique(np.concatenate([self.words[k] for k in order]) * docs + place, return_counts=True)
        term, doc = np.divmod(key, docs)
        df = np.bincount(term, minlength=len(self.terms))
        start = _offsets(df)
        gap = np.diff(doc, prepend=-1) - 1  # documents between a posting and the one before
        gap[start[:-1]] = doc[start[:-1]]
        blocks = -(-df // BLOCK)
        block_of_list = _offsets(blocks)
        block = block_of_list[term] + (np.arange(len(term)) - start[term]) // BLOCK
        first = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1])
        last = doc[np.concatenate([first[1:], [len(doc)]]) - 1].astype("<u4")
        kept, per_block = _outlines(block, tf, lengths[doc], first)
        pairs = np.column_stack([tf[kept], lengths[doc[kept]]]).astype("<u4")
        pair_of_block = _offsets(per_block)
        words = list(self.terms)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        wide = np.maximum(np.maximum.reduceat(gap, start[:-1]), np.maximum.reduceat(tf, start[:-1]) - 1)
        width = np.where(wide < 1 << 8, 1, np.where(wide < 1 << 16, 2, 4))
        for w in np.unique(width):
            lists = np.flatnonzero(width == w)
            for part in np.array_split(lists, -(-len(lists) // (1 << 16))):
                at = _ranges(start[part], df[part])
                own = _ranges(block_of_list[part], blocks[part])
                pair_sizes = pair_of_block[block_of_list[part + 1]] - pair_of_block[block_of_list[part]]
                own_pairs = _ranges(pair_of_block[block_of_list[part]], pair_sizes)
                postings = _offsets(df[part] * w)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(part), number)),
                    _binary(pa.string(), b"".join([words[k] for k in part.tolist()]), _offsets(sizes[part])),
                    pa.array(df[part]),
                    _binary(pa.binary(), last[own].tobytes(), _offsets(4 * blocks[part])),
                    _binary(pa.binary(), per_block[own].astype(np.uint8).tobytes(), _offsets(blocks[part])),
                    _binary(pa.binary(), pairs[own_pairs].tobytes(), _offsets(8 * pair_sizes)),
                    _binary(pa.binary(), gap[at].astype(f"<u{w}").tobytes(), postings),
                    _binary(pa.binary(), (tf[at] - 1).astype(f"<u{w}").tobytes(), postings),
                    pa.nulls(len(part), pa.int64())], schema=INDEX_ARROW)


def _outlines(block: np.ndarray, tf: np.ndarray, n: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The postings that no other of their block beats in both frequency and shortness, and their number per block."""
    order = np.lexsort((-tf, n, block))
    high = block[order] * (int(tf.max()) + 1) + tf[order]  # the greatest frequency so far, block by block
    keep = np.concatenate([[True], high[1:] > np.maximum.accumulate(high)[:-1]])
    kept = order[keep]
    return kept, np.bincount(block[kept], minlength=len(first))


def build_index(docs: DataFrame, shard_chars: int = SHARD_CHARS, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """Index rows of `docs` (doc_id, text); `term` null: the documents of the shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard = TaskContext.get().partitionId() << 32, Shard()
        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                text = text.as_py()
                terms = terms_of(text)
                if terms:
                    if shard.ids and (shard.chars + len(text) > shard_chars or len(shard.ids) >= shard_docs):
                        yield from shard.batches(number)
                        number, shard = number + 1, Shard()
                    shard.add(doc_id, terms, len(text))
        yield from shard.batches(number)
        release_memory()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
                       ).mapInArrow(run, INDEX_SCHEMA)


# ---------------------------------------------------------------- search in a shard


class PostingList:
    """A term's blocks in one shard; blocks are decompressed when they are first asked for."""

    def __init__(self, row: dict, docs: int, tokens: int):
        self.df, self.gaps, self.tfs = row["df"], row["gaps"], row["tfs"]
        self.width = len(self.gaps) // self.df
        self.last = np.frombuffer(row["last"], "<u4").astype(np.int64)
        sizes = np.frombuffer(row["outline_sizes"], np.uint8).astype(np.int64)
        tf, n = np.frombuffer(row["outline"], "<u4").astype(np.int64).reshape(-1, 2).T
        self.maxima = np.maximum.reduceat(worth(tf, length_weight(n, docs, tokens)), np.cumsum(sizes) - sizes)
        self.bound = int(self.maxima.max())
        self.blocks: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and frequencies."""
        found = self.blocks.get(k)
        if found is None:
            first, count, kind = k * BLOCK, min(BLOCK, self.df - k * BLOCK), f"<u{self.width}"
            gaps = np.frombuffer(self.gaps, kind, count, first * self.width).astype(np.int64)
            docs = np.cumsum(gaps + 1) + (int(self.last[k - 1]) if k else -1)
            found = self.blocks[k] = (docs, np.frombuffer(self.tfs, kind, count, first * self.width).astype(np.int64) + 1)
        return found

    def between(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Postings with low <= document < high, from the blocks that reach into the range."""
        first = int(np.searchsorted(self.last, low))
        upto = min(int(np.searchsorted(self.last, high - 1)) + 1, len(self.last))
        if first >= upto:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        docs, tf = ((self.block(first)) if upto - first == 1 else
                    tuple(np.concatenate(x) for x in zip(*[self.block(k) for k in range(first, upto)], strict=True)))
        a, b = np.searchsorted(docs, low), np.searchsorted(docs, high)
        return docs[a:b], tf[a:b]

    def maxima_at(self, docs: np.ndarray) -> np.ndarray:
        """The greatest worth that the block which would hold a document allows it (none after the last block)."""
        k = np.searchsorted(self.last, docs)
        return np.where(k < len(self.last), self.maxima[np.minimum(k, len(self.last) - 1)], 0)

    def worth_of(self, docs: np.ndarray, m: np.ndarray) -> np.ndarray:
        """The worth of ascending documents; only blocks that would hold one of them are decompressed."""
        out = np.zeros(len(docs), np.int64)
        k = np.searchsorted(self.last, docs)
        for b in np.unique(k[k < len(self.last)]):
            held, tf = self.block(int(b))
            mine = np.flatnonzero(k == b)
            at = np.minimum(np.searchsorted(held, docs[mine]), len(held) - 1)
            hit = held[at] == docs[mine]
            out[mine[hit]] = worth(tf[at[hit]], m[docs[mine[hit]]])
        return out


def best_documents(lists: list[tuple[int, PostingList]], m: np.ndarray, top: int, window: int = 1024
                   ) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of the `top` best with a score above 0 in one shard; lists are (weight, list)."""
    lists = sorted(((w, x) for w, x in lists if w > 0 and x.bound > 0), key=lambda p: p[0] * p[1].bound)
    bounds = np.array([w * x.bound for w, x in lists], np.int64)
    prefix = np.concatenate([[0], np.cumsum(bounds)])  # bounds of the lists before each
    docs, scores, least = np.empty(0, np.int64), np.empty(0, np.int64), 0  # a document must beat `least`
    for low in range(0, len(m), window):
        essential = int(np.searchsorted(prefix[1:], least, "right"))  # lists before it cannot beat it together
        if essential == len(lists):
            break
        high = min(low + window, len(m))
        score, seen = np.zeros(high - low, np.int64), np.zeros(high - low, bool)
        for w, x in lists[essential:]:
            at, tf = x.between(low, high)
            if len(at):
                score[at - low] += w * worth(tf, m[at])
                seen[at - low] = True
        found = np.flatnonzero(seen)
        have, found = score[found], found + low
        if essential and len(found):
            block = [w * x.maxima_at(found) for w, x in lists[:essential]]
            rest = np.sum(block, axis=0)
            for k in range(essential - 1, -1, -1):
                open_ = have + rest > least
                if not open_.all():
                    found, have, rest = found[open_], have[open_], rest[open_]
                    block = [b[open_] for b in block[:k + 1]]
                if not len(found):
                    break
                w, x = lists[k]
                rest = rest - block[k]
                may = block[k] > 0
                have[may] += w * x.worth_of(found[may], m)
        beat = have > least
        if beat.any():
            docs, scores = np.concatenate([docs, found[beat]]), np.concatenate([scores, have[beat]])
            order = np.lexsort((docs, -scores))[:top]
            docs, scores = docs[order], scores[order]
            if len(docs) == top:
                least = int(scores[-1])
    return docs, scores


# ---------------------------------------------------------------- search

LIST_COLUMNS = ("shard", "term", "df", "last", "outline_sizes", "outline", "gaps", "tfs")


def _asked(queries: DataFrame) -> DataFrame:
    """Each row of `queries` with a number of its own and its terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 32
        for b in batches:
            terms = [[t.decode() for t in terms_of(x.as_py())] for x in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(at, at + len(terms)), pa.int64()), b.column("item_id"), pa.array(terms, pa.list_(pa.string()))],
                ["query", "item_id", "terms"])
            at += len(terms)

    return queries.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
                          ).mapInArrow(run, "query long, item_id long, terms array<string>")


def search(queries: DataFrame, index: DataFrame, top: int = TOP, query_block: int = QUERY_BLOCK) -> DataFrame:
    """item_id, rank, doc_id, score of the best documents of each row of `queries` (item_id, text).

    `index` is a written table of `build_index` rows.  A (shard, query block) pair is one group: the shard's
    lists of the block's terms, each with the block's queries that hold the term.
    """
    totals = index.where("head").agg(F.coalesce(F.sum("df"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    docs, tokens = int(totals[0]), int(totals[1])
    asked = materialize(_asked(queries), "queries")
    blocks = max(1, -(-asked.count() // query_block))
    terms = materialize(
        asked.select(F.pmod(F.xxhash64("query"), F.lit(blocks)).alias("block"), "query", "item_id",
                     F.explode("terms").alias("term"))
        .groupBy("block", "term", "query", "item_id").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("block", "term").agg(F.collect_list(F.struct("query", "item_id", "n")).alias("uses")), "query-terms")
    distinct = terms.select("term").distinct()
    if distinct.count() <= BROADCAST_TERMS:  # counted: at most so many strings; else the planner chooses
        distinct = F.broadcast(distinct)
    found = index.where("not head").join(distinct, "term", "left_semi").select(
        *LIST_COLUMNS)
    all_df = found.groupBy("term").agg(F.sum("df").alias("all_df"))
    lists = found.join(terms.join(all_df, "term"), "term").select(
        *LIST_COLUMNS, "block", "all_df",
        F.col("uses.query").alias("query"), F.col("uses.item_id").alias("item_id"), F.col("uses.n").alias("n"))
    none = F.lit(None)
    heads = index.where("head").select(
        *LIST_COLUMNS, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), none.cast("long").alias("all_df"), none.cast("array<long>").alias("query"),
        none.cast("array<long>").alias("item_id"), none.cast("array<long>").alias("n"))

    def run(key, pdf):
        heaps = []
        head, rows = pdf[pdf["term"].isna()].iloc[0], pdf[pdf["term"].notna()].to_dict("records")
        ids, lengths = np.frombuffer(head["last"], np.int64), np.frombuffer(head["outline"], np.int64)
        known, m = np.frombuffer(head["gaps"], bool), length_weight(lengths, docs, tokens)
        asked_: dict[tuple, list] = {}
        for r in rows:
            w, x = weight(int(r["all_df"]), docs), PostingList(r, docs, tokens)
            for query, item, n in zip(r["query"], r["item_id"], r["n"], strict=True):
                asked_.setdefault((query, None if pd.isna(item) else int(item)), []).append((int(n) * w, x))
        for (query, item), mine in asked_.items():
            for d, s in zip(*best_documents(mine, m, top), strict=True):
                heaps.append((query, item, int(ids[d]) if known[d] else None, int(s)))
        made = pd.DataFrame(heaps, columns=["query", "item_id", "doc_id", "score"])
        return made.astype({"query": "int64", "item_id": "Int64", "doc_id": "Int64", "score": "int64"})

    heaps = lists.unionByName(heads).groupBy("shard", "block").applyInPandas(
        run, "query long, item_id long, doc_id long, score long")
    best = W.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return heaps.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def write_index(docs: DataFrame, **sizes: int) -> DataFrame:
    """`build_index` written to the scratch folder, documents apart from lists (`head`), and its reader."""
    path = scratch_path(docs.sparkSession, f"index-{uuid.uuid4().hex}")
    rows = build_index(docs, **sizes).withColumn("head", F.col("term").isNull())
    rows.write.partitionBy("head").parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path)


def op12_search(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return search(benchmark, write_index(docs))


#: The same by scoring every document that shares a term.
OP12_SQL = """
WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
q AS (SELECT row_number() OVER () AS q, item_id, unnest(regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
s AS (SELECT count(*)::BIGINT AS docs, sum(len(terms))::BIGINT AS tokens FROM d WHERE len(terms) > 0),
p AS (SELECT k, doc_id, n, term, count(*)::BIGINT AS tf
      FROM (SELECT k, doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM d)
      WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY term, docs),
r AS (SELECT q, item_id, k, doc_id,
             sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // tokens))))::BIGINT AS score
      FROM q JOIN p USING (term) JOIN w USING (term), s GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id)::INTEGER AS rank FROM r WHERE score > 0)
WHERE rank <= 20
"""
