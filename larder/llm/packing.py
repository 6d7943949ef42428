"""Best-fit packing of documents into fixed-length token sequences by exact-complement hashing.

Documents are encoded to token ids, longer ones cut into pieces of the
capacity, and only the lengths take part in the packing.  There are at most
`capacity` different lengths, so the histogram of lengths (whatever the number
of documents) is planned on the driver: for each length, from the longest, an
index of single, pair and triple length sums gives combinations that fill its
gap exactly, and as many of them are consumed as all their lengths are still
available; what is left goes by best fit, longest first.  The plan is a short
list of runs (a range of ranks of one length goes to a range of sequences at
one offset), and every piece finds its place by its rank among the pieces of
its length.

Ranks come from salted windows with prefix counts, so a length that a third of
all documents share is spread over many tasks.

Edge cases: a null or empty text is a document of the end id alone; rows
without doc_id and repeated rows are pieces like any other; an empty table
gives no pieces.
"""

from __future__ import annotations

import re
import struct
import unicodedata
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from larder.llm.common import materialize, release_memory

CAPACITY, END_ID, SALTS = 4096, 1, 256
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# Byte-level vocabularies write a byte as a letter: printable Latin-1 as itself, the others from U+0100 on.
_PRINTED = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTE_LETTERS = {b: 0x100 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTED)}


class WordEncoder:
    """Ids of texts by a word-level BPE vocabulary file, each distinct word encoded once.

    The vocabulary lower-cases, drops white space and encodes words one by one,
    so a text's ids are its words' ids.  This holds for texts of the characters
    below; any other text, and one that names a special token, goes to the
    tokenizer as a whole.
    """

    MEMO_WORDS = 1 << 18  # two generations of so many words are remembered

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        plain = [chr(c) for c in (*range(0x09, 0x0E), *range(0x20, 0x7F), *range(0xA1, 0x180), *range(0x2010, 0x2028),
                                  0x20AC) if c not in (0xAD, 0x130)]
        kinds = {k: "".join(map(re.escape, (c for c in plain if unicodedata.category(c)[0] == k))) for k in "LN"}
        other = "".join(re.escape(c) for c in plain if unicodedata.category(c)[0] not in "LN" and not c.isspace())
        self.odd = re.compile("[^" + "".join(map(re.escape, plain)) + "]")
        self.words = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{kinds['L']}]+|[{kinds['N']}]|[{other}]+")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if self.odd.search(text) or ("<|" in text and any(s in text for s in self.special)):
            return self._whole(text)
        words = self.words.findall(text.lower())
        try:
            return b"".join(map(self.memo.__getitem__, words))
        except KeyError:
            distinct = set(words)
            if len(self.memo) > self.MEMO_WORDS:
                self.memo, self.older = {}, self.memo
            self._learn(distinct.difference(self.memo))
            return b"".join(map(self.memo.__getitem__, words))

    def _learn(self, words: set[str]) -> None:
        memo, older = self.memo, self.older
        tokenize = self.tokenizer.model.tokenize
        for w in words:
            ids = older.get(w)
            if ids is None:
                found = tokenize(w if w.isascii() else w.encode().decode("latin-1").translate(BYTE_LETTERS))
                ids = struct.pack(f"<{len(found)}I", *[t.id for t in found])
            memo[w] = ids

    def forget(self) -> None:
        """Give the memory of words back; a worker process goes on to other stages."""
        self.memo, self.older = {}, {}


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process: the vocabulary is loaded once."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def encode_pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
                  keep_ids: bool = False) -> DataFrame:
    """One row per piece of at most `capacity` ids; `ids` (little-endian unsigned 32-bit) only if asked for."""
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = encoder(path), np.array([end_id], "<u4").tobytes()
        step = 4 * capacity
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                ids = coder.encode(text.as_py() or "") + end
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at:at + step]
                    rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part), part if keep_ids else None))
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32", "ids"])
        coder.forget()
        release_memory()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
                       ).mapInArrow(run, PIECE_SCHEMA)


class _Plan:
    """Runs of places: ranks from `first` on of one length, `per` to a sequence, from sequence `base` at `offset`."""

    def __init__(self, counts: np.ndarray, capacity: int):
        self.left, self.capacity = counts.copy(), capacity
        self.rank = np.zeros(capacity + 1, np.int64)
        self.runs: list[tuple[int, int, int, int, int]] = []  # length, first rank, per, base, offset
        self.next = 0

    def place(self, length: int, sequences: int, per: int, base: int, offset: int, count: int | None = None) -> None:
        n = sequences * per if count is None else count
        self.runs.append((length, int(self.rank[length]), per, base, offset))
        self.rank[length] += n
        self.left[length] -= n

    def take(self, combination: list[int]) -> int:
        """Consume a combination of lengths as often as all of them are available."""
        used = {x: combination.count(x) for x in combination}
        times = min(int(self.left[x]) // n for x, n in used.items())
        if times:
            offset = 0
            for x in combination:
                self.place(x, times, 1, self.next, offset)
                offset += x
            self.next += times
        return times


def _pair(left: np.ndarray, total: int, most: int) -> list[int] | None:
    """The pair of available lengths with this sum whose larger length is largest."""
    low, high = (total + 1) // 2, min(most, total - 1)
    if high < low:
        return None
    b = np.arange(high, low - 1, -1)
    ok = np.flatnonzero((left[b] > 0) & (left[total - b] > (b == total - b)))
    return [int(b[ok[0]]), int(total - b[ok[0]])] if len(ok) else None


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Runs and the number of sequences for a histogram of lengths from 1 to `capacity`."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    plan, left = _Plan(counts, capacity), None
    left = plan.left
    plan.take([capacity])

    def pair_sums() -> np.ndarray:
        bits, total = sum(1 << int(x) for x in np.flatnonzero(left[:capacity])), 0
        for x in np.flatnonzero(left[:capacity]):
            total |= bits << int(x)
        raw = np.frombuffer((total & ((1 << (capacity + 1)) - 1)).to_bytes(capacity // 8 + 1, "little"), np.uint8)
        return np.unpackbits(raw, bitorder="little")[:capacity + 1].astype(bool)

    sums, stale = pair_sums(), 0  # a stale index only offers sums whose lengths have run out
    for a in range(capacity - 1, 0, -1):
        gap = capacity - a
        while left[a]:
            if plan.take([a, gap]):
                continue
            left[a] -= 1  # the piece whose gap is filled is not available to fill it
            found = _pair(left, gap, gap - 1)
            if not found:
                b = np.arange(gap - 2, 0, -1)
                for x in b[(left[b] > 0) & sums[gap - b]] if len(b) else ():
                    left[x] -= 1
                    rest = _pair(left, gap - int(x), int(x))
                    left[x] += 1
                    if rest:
                        found = [int(x), *rest]
                        break
            left[a] += 1
            if not found or not plan.take([a, *found]):
                break
            stale += sum(not left[x] for x in found)
            if stale >= 32:
                sums, stale = pair_sums(), 0

    gaps: list[int] = []  # of open sequences, ascending
    open_: dict[int, list[tuple[int, int]]] = {}  # gap: (first sequence, number of sequences)

    def leave(gap: int, base: int, n: int) -> None:
        if n and gap:
            if gap not in open_:
                insort(gaps, gap)
                open_[gap] = []
            open_[gap].append((base, n))

    for a in range(capacity - 1, 0, -1):
        while left[a]:
            k = bisect_left(gaps, a)
            if k < len(gaps):
                gap = gaps[k]
                base, n = open_[gap].pop()
                if not open_[gap]:
                    del open_[gap]
                    gaps.pop(k)
            else:
                gap, base, n = capacity, plan.next, -(-int(left[a]) // (capacity // a))
                plan.next += n
            per, have = gap // a, int(left[a])
            full = min(n, have // per)
            if full:
                plan.place(a, full, per, base, capacity - gap)
                leave(gap - per * a, base, full)
                base, n = base + full, n - full
            if n and left[a]:  # fewer than `per` are left: they go into one sequence
                some = int(left[a])
                plan.place(a, 1, per, base, capacity - gap, some)
                leave(gap - some * a, base, 1)
                base, n = base + 1, n - 1
            leave(gap, base, n)
    return plan.runs, plan.next


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, salts: int = SALTS) -> DataFrame:
    """`pieces` (materialised; with doc_id, piece, length, ids_crc32) with sequence_id and offset."""
    counts = pieces.groupBy("length").count().collect()  # at most `capacity` rows
    runs, _ = plan_packing({r["length"]: r["count"] for r in counts}, capacity)
    runs = sorted(runs)
    key = np.array([(r[0] << 44) + r[1] for r in runs], np.int64)
    first, per, base, offset = (np.array([r[k] for r in runs], np.int64) for k in (1, 2, 3, 4))

    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    before = salted.groupBy("length", "salt").count().withColumn(
        "before", F.coalesce(F.sum("count").over(
            W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("count")
    ranked = salted.withColumn("rank", F.row_number().over(
        W.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")) - 1)
    ranked = ranked.join(before, ["length", "salt"]).withColumn("rank", F.col("rank") + F.col("before"))
    keep = [c for c in pieces.columns if c not in ("sequence_id", "offset")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            k = np.searchsorted(key, (length << 44) + rank, "right") - 1
            nth = rank - first[k]
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in keep] + [pa.array(base[k] + nth // per[k]),
                                               pa.array(offset[k] + nth % per[k] * length)],
                keep + ["sequence_id", "offset"])

    schema = pieces.select(*keep).withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    return ranked.select(*keep, "rank").mapInArrow(run, schema.schema)


def pack_documents(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
                   keep_ids: bool = False) -> DataFrame:
    """Pieces of `docs` (doc_id, text) with their places in sequences of at most `capacity` ids."""
    pieces = encode_pieces(docs, vocabulary, capacity, end_id, keep_ids)
    return pack_pieces(materialize(pieces if keep_ids else pieces.drop("ids"), "pieces"), capacity)


def op2_packing(docs: DataFrame) -> DataFrame:
    return pack_documents(docs).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
