"""Bounded-space online packing of documents into token sequences.

Documents are encoded and cut into full sequences of `capacity` ids and a rest.
Each partition of the input packs its rests as they come, with a fixed number
of open windows: a rest goes whole into the window that it fills best; when it
fits in none and no more windows may be opened, the fullest window takes as
much of the head of it as its gap holds and is emitted full, and what is left of the
rest is placed again.  At the end of a partition its open windows are left over, with
their ids.  Leftovers of `fan_in` partitions at a time are merged by the same
method, a window now being what is placed, in rounds until one group is left;
its last windows are laid end to end, and what does not fill a sequence is cut
into sequences whose lengths are powers of two, which need no padding.

So the state of a task is `windows` x `capacity` ids, nothing is shuffled but
leftover windows (at most `windows` a partition), and no sequence has padding.
A partition's sequences are numbered by the round, the task's group and a
running number, so equal runs give equal numbers; every pass is written as a
table once, so a lost executor neither loses nor repeats a piece.

Edge cases: a null or empty text is a document of the end id alone; rows
without doc_id and repeated rows are documents like any other; a very long text
gives full sequences at once; an empty table gives no pieces.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import materialize, release_memory

CAPACITY, END_ID, WINDOWS, FAN_IN = 1024, 0, 64, 32
PIECE_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
                "offset long, window int, ids binary")
COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class ByteEncoder:
    """Ids of texts by a byte-level BPE vocabulary file.

    Beside a file `x.json` its ranks `x.tiktoken` give the same ids faster; a text that names a special token,
    or that the faster library cannot split (a very long run of spaces), goes to the tokenizer as it is.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path.removesuffix(".json") + ".tiktoken", "rb") as f:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("larder", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if not any(s in text for s in self.special):
            try:
                return self.fast.encode_to_numpy(text)
            except ValueError:
                pass
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")


_encoders: dict[str, ByteEncoder] = {}


def encoder(path: str) -> ByteEncoder:
    """One encoder per worker process: the vocabulary is loaded once."""
    if path not in _encoders:
        _encoders[path] = ByteEncoder(path)
    return _encoders[path]


class Windows:
    """At most `most` open windows of `capacity` ids; `emit(sequence, pieces)` gets each that is full.

    A piece is (doc_id, start, doc_tokens, ids); what is placed is a list of pieces that stay together.
    """

    def __init__(self, capacity: int, most: int, first: int, emit):
        self.capacity, self.most, self.next, self.emit = capacity, most, first, emit
        self.gaps: list[tuple[int, int]] = []  # (gap, sequence) of the open windows, ascending
        self.open: dict[int, list] = {}

    def new(self) -> int:
        self.next += 1
        return self.next - 1

    def place(self, pieces: list, length: int) -> None:
        while length:
            if length >= self.capacity:
                head, pieces = cut(pieces, self.capacity)
                length -= self.capacity
                self.emit(self.new(), head)
                continue
            k = bisect_left(self.gaps, (length, -1))
            if k < len(self.gaps):  # the smallest gap that holds it
                gap, sequence = self.gaps.pop(k)
                self.open[sequence] += pieces
                if gap > length:
                    insort(self.gaps, (gap - length, sequence))
                else:
                    self.emit(sequence, self.open.pop(sequence))
                return
            if len(self.gaps) < self.most:
                sequence = self.new()
                self.open[sequence] = list(pieces)
                insort(self.gaps, (self.capacity - length, sequence))
                return
            gap, sequence = self.gaps.pop(0)  # the fullest: its gap takes the head
            head, pieces = cut(pieces, gap)
            length -= gap
            self.emit(sequence, self.open.pop(sequence) + head)

    def finish(self) -> None:
        """No window stays open: what they hold is laid end to end; the end is cut at powers of two."""
        rest = [piece for sequence in sorted(self.open) for piece in self.open[sequence]]
        self.open, self.gaps = {}, []
        left = sum(len(p[3]) for p in rest)
        while left:
            size = self.capacity if left >= self.capacity else 1 << (left.bit_length() - 1)
            head, rest = cut(rest, size)
            left -= size
            self.emit(self.new(), head)


def cut(pieces: list, at: int) -> tuple[list, list]:
    """Pieces before and after so many ids; the piece at the cut is parted."""
    for k, (doc_id, start, total, ids) in enumerate(pieces):
        if len(ids) > at:
            head = [*pieces[:k], (doc_id, start, total, ids[:at])] if at else pieces[:k]
            return head, [(doc_id, start + at, total, ids[at:]), *pieces[k + 1:]]
        at -= len(ids)
    return pieces, []


class _Rows:
    """Rows of PIECE_SCHEMA from emitted and left windows."""

    def __init__(self, keep_ids: bool):
        self.keep_ids, self.rows = keep_ids, []

    def add(self, sequence: int, pieces: list, window: int | None = None) -> None:
        offset = 0
        for doc_id, start, total, ids in pieces:
            raw = np.ascontiguousarray(ids, "<u4").tobytes()
            self.rows.append((doc_id, start, len(ids), zlib.crc32(raw), total, sequence, offset, window,
                              raw if self.keep_ids or window is not None else None))
            offset += len(ids)

    def take(self) -> pa.RecordBatch:
        cols = list(zip(*self.rows, strict=True)) or [[]] * 9
        self.rows = []
        types = [pa.int64()] * 7 + [pa.int32(), pa.binary()]
        names = [c.split()[0] for c in PIECE_SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)


def pack_partitions(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
                    windows: int = WINDOWS, keep_ids: bool = False) -> DataFrame:
    """Each partition of `docs` packed by itself; rows of windows left open have `window`, their partition."""
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows = TaskContext.get().partitionId(), _Rows(keep_ids)
        packer, end = Windows(capacity, windows, part << 32, rows.add), np.array([end_id], "<u4")
        coder = encoder(path)
        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                ids = np.concatenate([coder.encode(text.as_py() or ""), end])
                packer.place([(doc_id, 0, len(ids), ids)], len(ids))
                if len(rows.rows) > 20_000:
                    yield rows.take()
            yield rows.take()
        for sequence, pieces in packer.open.items():
            rows.add(sequence, pieces, part)
        yield rows.take()
        release_memory()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
                       ).mapInArrow(run, PIECE_SCHEMA)


def _merge(left: DataFrame, capacity: int, windows: int, fan_in: int, level: int, keep_ids: bool, last: bool) -> DataFrame:
    """Windows left by `fan_in` partitions (or groups) at a time, packed into those of one."""
    names = [c.split()[0] for c in PIECE_SCHEMA.split(", ")]

    def run(key, pdf):
        group, rows = int(key[0]), _Rows(keep_ids)
        packer = Windows(capacity, windows, (level << 56) + (group << 32), rows.add)
        pdf = pdf.sort_values(["sequence_id", "offset"])
        docs = [None if pd.isna(x) else int(x) for x in pdf["doc_id"]]
        units: dict[int, list] = {}
        for doc_id, sequence, start, total, ids in zip(docs, pdf["sequence_id"], pdf["start"], pdf["doc_tokens"],
                                                       pdf["ids"], strict=True):
            units.setdefault(int(sequence), []).append((doc_id, int(start), int(total), np.frombuffer(ids, "<u4")))
        for pieces in units.values():
            packer.place(pieces, sum(len(p[3]) for p in pieces))
        if last:
            packer.finish()
        for sequence, pieces in packer.open.items():
            rows.add(sequence, pieces, group)
        out = pd.DataFrame(rows.rows, columns=names)
        return out.astype({"doc_id": "Int64", "window": "Int32"})

    grouped = left.withColumn("__group", F.expr(f"window div {fan_in}").cast("int"))
    return grouped.groupBy("__group").applyInPandas(run, PIECE_SCHEMA)


def pack_online(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
                windows: int = WINDOWS, fan_in: int = FAN_IN, keep_ids: bool = False) -> DataFrame:
    """Pieces of `docs` (doc_id, text) with their places; `ids` (little-endian unsigned 32-bit) only if asked for."""
    if fan_in < 2 or windows < 1 or capacity < 1:
        raise ValueError("capacity and windows must be positive and fan_in at least 2")
    packed = materialize(pack_partitions(docs, vocabulary, capacity, end_id, windows, keep_ids), "windows")
    out, level = packed.where("window is null"), 0
    left = packed.where("window is not null")
    most = left.agg(F.max("window")).first()[0]
    while most is not None:
        level += 1
        last = most < fan_in
        merged = materialize(_merge(left, capacity, windows, fan_in, level, keep_ids, last), "windows")
        out, left = out.unionByName(merged.where("window is null")), merged.where("window is not null")
        most = None if last else most // fan_in
    return out.drop("window") if keep_ids else out.select(*COLUMNS)


def op13_windows(docs: DataFrame) -> DataFrame:
    return pack_online(docs).select(*COLUMNS)
