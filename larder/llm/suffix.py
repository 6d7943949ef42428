"""Exact substring de-duplication by suffix arrays over content-defined shards.

Removed is each byte covered by a `WINDOW`-byte string that also starts earlier:
in a document of smaller doc_id, or at an earlier place of the same document.

1. Every text is cut into runs of windows that share a minimizer (minimizers.py).
   Equal windows have equal minimizers, so they always meet under the same gram.
   Each task first keeps, of equal segments (a run's bytes), only the earliest;
   the others are certain repeats.  What is left meets by the gram's hash, so a
   gram that a third of all documents hold brings a row per task, not per document.
2. Of equal segments all but the earliest are repeats.  Grams with several
   different segments are undecided, and their segments' bytes are fetched.
3. Segments are sharded by gram into blocks of bounded bytes.  Each shard has a
   suffix array (Larsson-Sadakane refinement: sort by eight bytes, then double,
   touching only groups that are still undecided) and the common prefixes of
   neighbouring suffixes (Kasai's recurrence over text positions).  Windows whose
   neighbours share `WINDOW` bytes are equal, and all but the earliest are repeats.
   A gram that goes on over several shards is merged by binary search of a
   shard's windows in the sorted windows of the shards before it.
   A gram of more than `HOT_SEGMENTS` undecided segments is not sharded: its
   windows meet one by one by a 128-bit hash, the earliest of each found by
   partial minima, so its work goes to many tasks and none holds its windows.
4. The repeats of each document are joined back to its text.

Texts travel compressed.  Edge cases: a null text is empty; texts shorter than a
window lose nothing; rows that repeat a doc_id with the same text are one document
(they lose the same bytes, none because of each other), with another text they are
ordered by the text's hash; rows without doc_id are returned whole and make nobody
else lose bytes; an empty table gives an empty table; other columns are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import materialize, release_memory
from larder.llm.minimizers import WINDOW, blocks_of, runs_of

BATCH_BYTES, SHARD_BYTES = 2 << 20, 1 << 20
HOT_SEGMENTS = 1000
CHAIN = 128  # positions after which Kasai's chain is begun anew, so that capped values stay exact


# ---------------------------------------------------------------- suffix arrays in numpy

def suffix_array(buf: np.ndarray, depth: int = 128) -> np.ndarray:
    """Suffixes of `buf` sorted by their first `depth` bytes (a power of two, at least 8)."""
    n = len(buf)
    padded = np.concatenate((buf, np.zeros(8, np.uint8)))
    word = np.zeros(n, np.uint64)
    for k in range(8):
        word = (word << np.uint64(8)) | padded[k:k + n]
    sa = np.argsort(word, kind="stable").astype(np.int32)
    ordered = word[sa]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    del word, ordered
    rank = np.zeros(n + depth, np.int64)  # 0: past the end; else 1 + the start of the suffix's group
    h, todo = 8, np.arange(n)
    while True:
        starts = np.flatnonzero(new)
        sizes = np.diff(np.concatenate((starts, [len(todo)])))
        rank[sa[todo]] = np.repeat(todo[starts] + 1, sizes)
        keep = np.repeat(sizes > 1, sizes)  # groups of one are settled
        todo = todo[keep]
        if h >= depth or not len(todo):
            return sa
        at = sa[todo]
        group, after = rank[at], rank[at + h]
        order = np.argsort(group * np.int64(n + 1) + after, kind="stable")
        sa[todo] = at[order]
        group, after = group[order], after[order]
        new = np.concatenate(([True], (group[1:] != group[:-1]) | (after[1:] != after[:-1])))
        h *= 2


def common_prefixes(buf: np.ndarray, sa: np.ndarray, cap: int = WINDOW) -> np.ndarray:
    """Common prefix of each suffix in `sa` with the one before it; exact up to `cap` bytes, else at least that.

    Kasai's recurrence over text positions: where a suffix and its neighbour are
    both one byte on from the suffix before, the prefix is one shorter; only
    positions where that chain begins anew compare bytes, eight at a time.
    """
    n, cap = len(sa), cap + CHAIN
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    fresh = np.ones(n, bool)
    fresh[1:] = (phi[1:] != phi[:-1] + 1) | (phi[:-1] < 0)
    fresh[::CHAIN] = True
    heads = np.flatnonzero(fresh)
    padded = np.concatenate((buf, np.zeros(8, np.uint8)))
    plcp = np.zeros(n, np.int64)
    live = heads[phi[heads] >= 0]
    run = np.zeros(len(live), np.int64)
    while len(live):
        a, b = live + run, phi[live] + run
        inside = np.minimum(n - a, n - b)
        same = np.zeros(len(live), np.int64)
        going = np.ones(len(live), bool)
        for k in range(8):
            ok = going & (inside > k)
            ok[ok] = padded[a[ok] + k] == padded[b[ok] + k]
            same += ok
            going = ok
        run += same
        done = ~going | (run >= cap)
        plcp[live[done]] = run[done]
        live, run = live[~done], run[~done]
    last = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    plcp = np.maximum(plcp[last] - (np.arange(n) - last), 0)
    return plcp[sa]


def repeated_windows(buf: np.ndarray, starts: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(sorted first windows, repeats): positions of `starts` whose window is the first of its kind, in the
    windows' byte order, and the positions whose window equals one at an earlier position."""
    sa = suffix_array(buf)
    kind = np.cumsum(common_prefixes(buf, sa) < window)
    is_start = np.zeros(len(buf), bool)
    is_start[starts] = True
    chosen = is_start[sa]
    at, kind = sa[chosen].astype(np.int64), kind[chosen]
    first = np.full(int(kind[-1]) + 1 if len(kind) else 0, len(buf), np.int64)
    np.minimum.at(first, kind, at)
    leads = at == first[kind]
    return at[leads], np.sort(at[~leads])


# ---------------------------------------------------------------- Spark

def _packed(docs: DataFrame) -> DataFrame:
    """`__row` (all columns but the text), `__doc`, `__th`, `__z`: text compressed for the shuffles."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    src = docs.select(F.struct(*others, F.col("text").isNull().alias("__text_was_null")).alias("__row"),
                      F.col("doc_id").cast("long").alias("__doc"), F.xxhash64(text).alias("__th"),
                      text.cast("binary").alias("__z"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for b in batches:
            z = pa.array([press.compress(t.as_py()) for t in b.column("__z")], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("__row"), b.column("__doc"), b.column("__th"), z], b.schema.names)

    return src.mapInArrow(run, src.schema)


def _runs(docs: DataFrame, buckets: int) -> DataFrame:
    """Runs of windows as arrays, a row per task batch and bucket of gram hashes."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    src = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc"), F.xxhash64(text).alias("th"), text.cast("binary").alias("raw")
    ).where(F.length("raw") >= WINDOW)
    names = ["bucket", "gram", "seg", "doc", "th", "start", "span", "dup"]

    def batch(ids: list[int], hashes: list[int], texts: list[bytes]) -> pa.RecordBatch:
        ids, hashes = np.array(ids, np.int64), np.array(hashes, np.int64)
        found = []
        for number, low, high in blocks_of(np.array([len(t) for t in texts])):
            raw = b"".join(texts[k][a:b] for k, a, b in zip(number.tolist(), low.tolist(), high.tolist(), strict=True))
            ends = np.cumsum(high - low)
            gram, _, s, e = runs_of(np.frombuffer(raw, np.uint8), ends)
            seg = np.array([xxhash.xxh64_intdigest(raw[a:b]) for a, b in zip(s.tolist(), (e + WINDOW).tolist(),
                                                                            strict=True)], np.uint64)
            k = np.searchsorted(ends, s, "right")
            found.append((gram, seg, ids[number[k]], hashes[number[k]],
                          (s - (ends - (high - low))[k] + low[k]).astype(np.int32), (e - s).astype(np.int16)))
        gram, seg, doc, th, start, span = (np.concatenate(c) for c in zip(*found, strict=True))
        order = np.lexsort((start, th, doc, seg, gram))
        gram, seg, doc, th, start, span = (c[order] for c in (gram, seg, doc, th, start, span))
        dup = np.zeros(len(gram), bool)
        dup[1:] = (gram[1:] == gram[:-1]) & (seg[1:] == seg[:-1])
        # a repeat inside the batch is decided; it goes by its document, so that no gram's bucket grows by it
        # (a repeated row's own copy of the same place is no repeat)
        same = np.zeros(len(gram), bool)
        same[1:] = dup[1:] & (doc[1:] == doc[:-1]) & (th[1:] == th[:-1]) & (start[1:] == start[:-1])
        lead = np.maximum.accumulate(np.where(~dup, np.arange(len(gram)), 0))
        own = dup & (doc == doc[lead]) & (th == th[lead]) & (start == start[lead])
        drop = same | own
        bucket = np.where(dup, (doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20),
                          gram >> np.uint64(8)) % np.uint64(buckets)
        keep = np.flatnonzero(~drop)
        keep = keep[np.argsort(bucket[keep], kind="stable")]
        cols = [c[keep] for c in (gram, seg, doc, th, start, span, dup)]
        bucket = bucket[keep].astype(np.int64)
        cut = np.flatnonzero(np.diff(bucket)) + 1
        edges = np.concatenate(([0], cut, [len(bucket)])).tolist()
        pairs = [(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True) if b > a]
        blobs = [pa.array([c[a:b].tobytes() for a, b in pairs], pa.binary()) for c in cols]
        return pa.RecordBatch.from_arrays([pa.array([int(bucket[a]) for a, _ in pairs], pa.int32()), *blobs], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, hashes, texts, used = [], [], [], 0
        for b in batches:
            for doc, th, raw in zip(b.column("doc").to_pylist(), b.column("th").to_pylist(), b.column("raw"), strict=True):
                raw = raw.as_py()
                ids.append(doc)
                hashes.append(th)
                texts.append(raw)
                used += len(raw)
                if used >= BATCH_BYTES:
                    yield batch(ids, hashes, texts)
                    ids, hashes, texts, used = [], [], [], 0
        if texts:
            yield batch(ids, hashes, texts)
        release_memory()

    return src.mapInArrow(run, "bucket int, " + ", ".join(f"{c} binary" for c in names[1:]))


_TYPES = {"gram": np.uint64, "seg": np.uint64, "doc": np.int64, "th": np.int64, "start": np.int32, "span": np.int16,
          "dup": bool}
MARKS = "doc long, th long, start int, span int, gram long"


def _marks(runs: DataFrame) -> DataFrame:
    """(doc, th, start, span, gram): windows start..start+span repeat if gram is null, else they are undecided."""

    def decide(rows: list[list[bytes]]) -> pa.RecordBatch:
        gram, seg, doc, th, start, span, dup = (np.frombuffer(b"".join(r[k] for r in rows), t)
                                                for k, t in enumerate(_TYPES.values()))
        sure = np.flatnonzero(dup)
        rest = np.flatnonzero(~dup)
        rest = rest[np.argsort(gram[rest], kind="stable")]
        g = gram[rest]
        same = g[1:] == g[:-1]
        rest = rest[np.concatenate(([False], same)) | np.concatenate((same, [False]))] if len(rest) else rest
        rest = rest[np.lexsort((start[rest], th[rest], doc[rest], seg[rest], gram[rest]))]
        g, s, d, t, a = (c[rest] for c in (gram, seg, doc, th, start))
        lead = np.ones(len(rest), bool)
        lead[1:] = (g[1:] != g[:-1]) | (s[1:] != s[:-1])
        first = np.maximum.accumulate(np.where(lead, np.arange(len(rest)), 0))
        own = (d == d[first]) & (t == t[first]) & (a == a[first])  # the place itself, or its repeated row
        repeats = rest[~own]
        leads, lg = rest[lead], g[lead]
        same = lg[1:] == lg[:-1]
        open_ = leads[np.concatenate(([False], same)) | np.concatenate((same, [False]))] if len(leads) else leads
        take = np.concatenate((sure, repeats, open_))
        undecided = np.arange(len(take)) >= len(sure) + len(repeats)
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[take]), pa.array(th[take]), pa.array(start[take]), pa.array(span[take].astype(np.int32)),
             pa.array(gram[take].astype(np.int64), mask=~undecided)], ["doc", "th", "start", "span", "gram"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for b in batches:
            columns = [b.column(c) for c in _TYPES]
            for k, bucket in enumerate(b.column("bucket").to_pylist()):
                if rows and bucket != now:
                    yield decide(rows)
                    rows = []
                now = bucket
                rows.append([c[k].as_py() for c in columns])
        if rows:
            yield decide(rows)
        release_memory()

    return runs.mapInArrow(run, MARKS)


def _segments(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """(gram, doc, th, start, bytes, window) of the undecided runs; those of a `hot` gram as a hash per window."""
    wanted = marks.where("gram is not null").groupBy("doc", "th").agg(
        F.collect_list(F.struct("gram", "start", "span", "hot")).alias("wanted"))
    packed = _packed(docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text")).drop("__row")
    joined = wanted.join(packed,
                         (F.col("doc") == F.col("__doc")) & (F.col("th") == F.col("__th")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for b in batches:
            out: list[tuple] = []
            for doc, th, z, wanted in zip(b.column("doc").to_pylist(), b.column("th").to_pylist(), b.column("__z"),
                                          b.column("wanted"), strict=True):
                raw = press.decompress(z.as_py())
                for w in wanted.as_py():
                    at, end = w["start"], w["start"] + w["span"]
                    if w["hot"]:
                        out += [(w["gram"], doc, th, k, None, xxhash.xxh3_128_digest(raw[k:k + WINDOW]))
                                for k in range(at, end + 1)]
                    else:
                        out.append((w["gram"], doc, th, at, raw[at:end + WINDOW], None))
            cols = list(zip(*out, strict=True)) or [[]] * 6
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                             ["gram", "doc", "th", "start", "bytes", "window"])

    return joined.select("doc", "th", "__z", "wanted").mapInArrow(
        run, "gram long, doc long, th long, start int, bytes binary, window binary")


def _shard_repeats(segments: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc, th, start, span) of the repeats among undecided runs: a suffix array per shard, merged over shards."""
    names = ["gram", "doc", "th", "start"]

    def shard(rows: list[tuple], before: np.ndarray | None) -> tuple[pa.RecordBatch, np.ndarray]:
        """The shard's repeats, and the sorted windows of its last gram (with `before`, if that is its first too)."""
        sizes = np.array([len(r[4]) for r in rows])
        ends = np.cumsum(sizes)
        buf = np.frombuffer(b"".join(r[4] for r in rows), np.uint8)
        windows = sizes - WINDOW + 1
        owner = np.repeat(np.arange(len(rows)), windows)
        inside = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
        leads, repeats = repeated_windows(buf, (ends - sizes)[owner] + inside)
        cells = np.lib.stride_tricks.sliding_window_view(buf, WINDOW)
        strings = lambda at: np.ascontiguousarray(cells[at]).view(f"S{WINDOW}").ravel()
        gram = np.array([r[0] for r in rows], np.int64)
        last_from = (ends - sizes)[np.flatnonzero(gram == gram[-1])[0]]
        if before is None:
            merged = strings(leads[leads >= last_from])  # in byte order, as the suffix array has them
        else:  # the first gram goes on from the shards before: binary search in their windows
            own = leads[leads < ends[np.flatnonzero(gram == gram[0])[-1]]]
            mine = strings(own)
            at = np.searchsorted(before, mine)
            known = before[np.minimum(at, len(before) - 1)] == mine
            repeats = np.sort(np.concatenate((repeats, own[known])))
            if gram[0] == gram[-1]:
                merged = np.insert(before, at[~known], mine[~known])
            else:
                merged = strings(leads[leads >= last_from])
        k = np.searchsorted(ends, repeats, "right")
        offset = repeats - (ends - sizes)[k]
        new = np.ones(len(repeats), bool)
        new[1:] = (k[1:] != k[:-1]) | (offset[1:] != offset[:-1] + 1)
        heads = np.flatnonzero(new)
        tails = np.concatenate((heads[1:], [len(repeats)])) - 1 if len(heads) else heads
        row = [rows[x] for x in k[heads].tolist()]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[1] for r in row], pa.int64()), pa.array([r[2] for r in row], pa.int64()),
             pa.array((np.array([r[3] for r in row], np.int64) + offset[heads]).astype(np.int32)),
             pa.array((offset[tails] - offset[heads]).astype(np.int32))], ["doc", "th", "start", "span"]), merged

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        used, before, previous = 0, None, None
        for b in batches:
            for r in zip(*(b.column(c).to_pylist() for c in names), b.column("bytes").to_pylist(), strict=True):
                if previous == r[:4]:
                    continue  # a repeated row's copy of the same place
                if used >= shard_bytes:
                    found, merged = shard(rows, before)
                    before = merged if r[0] == rows[-1][0] else None
                    yield found
                    rows, used = [], 0
                rows.append(r)
                used += len(r[4])
                previous = r[:4]
        if rows:
            yield shard(rows, before)[0]
        release_memory()

    return segments.repartition("gram").sortWithinPartitions(*names).mapInArrow(
        run, "doc long, th long, start int, span int")


def _window_repeats(windows: DataFrame) -> DataFrame:
    """(doc, th, start, span) of the windows that equal an earlier one, for (doc, th, start, window)."""
    place = F.struct("doc", "th", "start")
    firsts = materialize(windows.groupBy("window").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                         .where("first < last").drop("last"), "first-windows")
    return windows.join(firsts, "window").where(place > F.col("first")).select("doc", "th", "start", F.lit(0).alias("span"))


def repeats(docs: DataFrame) -> DataFrame:
    """(doc, th, runs): per document (doc_id, hash of its text) the runs (start, span) of repeated windows."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = _runs(docs, 4 * parts).repartition(parts, "bucket").sortWithinPartitions("bucket")
    marks = materialize(_marks(runs), "marks")
    hot = materialize(marks.where("gram is not null").groupBy("gram").count().where(F.col("count") > HOT_SEGMENTS)
                      .select("gram", F.lit(True).alias("hot")), "hot-grams")
    segments = _segments(docs, marks.join(hot, "gram", "left"))
    if hot.isEmpty():
        found = _shard_repeats(segments)
    else:
        segments = materialize(segments, "segments")
        found = _shard_repeats(segments.where("window is null")).unionByName(
            _window_repeats(segments.where("window is not null").select("doc", "th", "start", "window")))
    both = marks.where("gram is null").select("doc", "th", "start", "span").unionByName(found)
    return both.groupBy("doc", "th").agg(F.collect_list(F.struct("start", "span")).alias("runs"))


def covered(size: int, runs: list[dict]) -> np.ndarray:
    """Which of `size` bytes the runs of windows cover."""
    edge = np.zeros(size + 1, np.int32)
    for r in runs:
        edge[r["start"]] += 1
        edge[r["start"] + r["span"] + WINDOW] -= 1
    return np.cumsum(edge[:-1]) > 0


def _with_runs(docs: DataFrame) -> DataFrame:
    found = repeats(docs.select("doc_id", "text"))
    return _packed(docs).join(found, (F.col("__doc") == F.col("doc")) & (F.col("__th") == F.col("th")), "left")


def removed_bytes(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per row of `docs` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for b in batches:
            rows = []
            for z, runs in zip(b.column("__z"), b.column("runs"), strict=True):
                raw, runs = press.decompress(z.as_py()), runs.as_py()
                if not runs:
                    rows.append((len(raw), 0, 0, hashlib.sha256(raw).hexdigest()))
                    continue
                gone = covered(len(raw), runs)
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                rows.append((len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
            cols = list(zip(*rows, strict=True)) or [[]] * 4
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [b.column("__doc")] + [pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return _with_runs(docs.select("doc_id", "text")).select("__doc", "__z", "runs").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """`docs` with its texts less the repeated bytes (whole characters only); all rows and columns are kept."""
    joined = _with_runs(docs).select("__row", "__z", "runs")
    schema = joined.select("__row", F.lit("").alias("__text")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for b in batches:
            texts = []
            for z, runs in zip(b.column("__z"), b.column("runs"), strict=True):
                raw, runs = press.decompress(z.as_py()), runs.as_py()
                if runs:
                    bytes_ = np.frombuffer(raw, np.uint8)
                    head = (bytes_ & 0xC0) != 0x80  # a character goes if all its bytes go
                    number = np.cumsum(head) - 1
                    stays = np.bincount(number, weights=~covered(len(raw), runs)) > 0
                    raw = bytes_[stays[number]].tobytes()
                texts.append(raw.decode("utf-8"))
            yield pa.RecordBatch.from_arrays([b.column("__row"), pa.array(texts, pa.string())], ["__row", "__text"])

    cleaned = joined.mapInArrow(run, schema)
    text = F.when(F.col("__row.__text_was_null"), F.lit(None)).otherwise(F.col("__text"))
    return cleaned.select(*[text.alias("text") if c == "text"
                            else F.coalesce(F.char_length(text), F.lit(0)).cast(t).alias(c) if c == "n_chars"
                            else F.col(f"__row.`{c}`").alias(c) for c, t in docs.dtypes])


def op6_suffix(docs: DataFrame) -> DataFrame:
    return removed_bytes(docs)
