"""WARC records in ZIP packages: writer, and a reader by ranges.

A package is a ZIP file with two *stored* members: `archive/data.warc.gz` (one
gzip member per WARC record, each an HTTP message) and `indexes/index.cdxj` (lines of a key, a time and JSON with the
file name, offset and length of each record, sorted by key).  The reader takes any package with stored
members below `archive/` (.warc or .warc.gz, several if need be) and index lines of that form below
`indexes/`; records are gzip members or plain, responses, resources or revisits, their payload
digests in base 16 or 32.  It parses the end record, the ZIP64
end record where there is one, and the central directory, finds the members'
data through their local headers, reads the index, and then reads each record
by its byte range; nothing is extracted.

Pages have no capture time, so their records carry the date given to the writer.
Only ranges are read, so a member's CRC is not checked; each payload is, against its digest.

Records of equal payloads of at least `min_bytes`: the one with the largest
page_id is the response, the others are revisits that refer to it.  Repeated
rows with that same page_id are responses alike.  A null html is an empty
payload, a null url is left out of the record, and a row without page_id is
always a response and nobody's original.
"""

from __future__ import annotations

import base64
import gzip
import io
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import materialize
from larder.session import scratch_path

WARC, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PACKAGE_BYTES = 16 << 20  # a package is closed when its records reach this; one longer record makes its own
MIN_BYTES = 1000
DATE = "1970-01-01T00:00:00Z"


# ---------------------------------------------------------------- ZIP, written and read by ranges

def zip_stored(members: list[tuple[str, bytes]], zip64: bool = False) -> bytes:
    """A ZIP file of stored members; ZIP64 records where sizes need them or `zip64` asks for them."""
    out, directory = io.BytesIO(), b""
    for name, data in members:
        at, raw, crc, n = out.tell(), name.encode(), zlib.crc32(data), len(data)
        wide = zip64 or max(n, at) >= 0xFFFFFFFF
        size, where = (0xFFFFFFFF, 0xFFFFFFFF) if wide else (n, at)
        version = 45 if wide else 20
        extra = struct.pack("<HHQQ", 1, 16, n, n) if wide else b""
        out.write(struct.pack("<IHHHHHIIIHH", 0x04034B50, version, 0x800, 0, 0, 0x21, crc, size, size, len(raw),
                              len(extra)) + raw + extra)
        out.write(data)
        extra = struct.pack("<HHQQQ", 1, 24, n, n, at) if wide else b""
        directory += struct.pack("<IHHHHHHIIIHHHHHII", 0x02014B50, version, version, 0x800, 0, 0, 0x21, crc, size,
                                 size, len(raw), len(extra), 0, 0, 0, 0, where) + raw + extra
    start, count = out.tell(), len(members)
    out.write(directory)
    wide = zip64 or start >= 0xFFFFFFFF
    if wide:
        end = out.tell()
        out.write(struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, count, count, len(directory), start))
        out.write(struct.pack("<IIQI", 0x07064B50, 0, end, 1))
    out.write(struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, count, count, len(directory),
                          0xFFFFFFFF if wide else start, 0))
    return out.getvalue()


def zip_directory(read_at, size: int) -> dict[str, tuple[int, int]]:
    """{member: (offset of its data, length)} by ranges; `read_at(offset, length)` gives bytes.

    Members must be stored: a compressed or encrypted one raises ValueError.
    """
    tail = read_at(max(0, size - 65557), min(size, 65557))  # the end record and its longest comment
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("no ZIP end record")
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    if 0xFFFF == count or 0xFFFFFFFF in (length, start):
        here = size - len(tail) + at - 20
        mark, _, end, _ = struct.unpack("<IIQI", read_at(here, 20))
        if mark != 0x07064B50:
            raise ValueError("no ZIP64 locator")
        mark, *_, count, length, start = struct.unpack("<IQHHIIQQQQ", read_at(end, 56))
        if mark != 0x06064B50:
            raise ValueError("no ZIP64 end record")
    raw, found, pos = read_at(start, length), {}, 0
    for _ in range(count):
        mark, _, _, flags, method, _, _, _, packed, full, n, e, c, _, _, _, where = struct.unpack_from(
            "<IHHHHHHIIIHHHHHII", raw, pos)
        if mark != 0x02014B50:
            raise ValueError("broken central directory")
        name, extra = raw[pos + 46:pos + 46 + n].decode(), raw[pos + 46 + n:pos + 46 + n + e]
        k = 0
        while k + 4 <= len(extra):
            kind, width = struct.unpack_from("<HH", extra, k)
            if kind == 1:
                values = list(struct.unpack_from(f"<{width // 8}Q", extra, k + 4))
                full = values.pop(0) if full == 0xFFFFFFFF else full
                packed = values.pop(0) if packed == 0xFFFFFFFF else packed
                where = values.pop(0) if where == 0xFFFFFFFF else where
            k += 4 + width
        if method or flags & 1 or packed != full:
            raise ValueError(f"{name}: only stored members can be read by ranges")
        local = read_at(where, 30)
        n_local, e_local = struct.unpack_from("<HH", local, 26)
        found[name] = (where + 30 + n_local + e_local, full)
        pos += 46 + n + e + c
    return found


# ---------------------------------------------------------------- WARC records

def warc_record(kind: str, record_id: str, page_id: int | None, url: str | None, payload: bytes, digest: str,
                refers_to: int | None = None, refers_url: str | None = None, date: str = DATE) -> bytes:
    """A response, or a revisit of one: an HTTP message, with the payload or without it."""
    line = lambda text: text.replace("\r", " ").replace("\n", " ")
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if kind != "revisit":
        body += payload
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date),
            ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(len(payload)))]
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    if url is not None:
        head.append(("WARC-Target-URI", line(url)))
    if kind == "revisit":
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To-Date", date), ("X-Refers-To-Page", str(refers_to))]
        if refers_url is not None:
            head.append(("WARC-Refers-To-Target-URI", line(refers_url)))
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(body)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return text.encode("utf-8", "surrogatepass") + body + b"\r\n\r\n"


def _fields(lines: list[str]) -> dict[str, str]:
    """Header fields by lower-case name."""
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def parse_warc(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and the block."""
    head, _, rest = record.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = _fields(lines)
    return fields, rest[:int(fields["content-length"])]


def payload_of(fields: dict[str, str], block: bytes) -> tuple[bytes, bool]:
    """The payload of a block, and whether it stands there as its digest counts it (no transfer or content coding)."""
    if not fields.get("content-type", "").lower().startswith("application/http"):
        return block, True
    head, _, body = block.partition(b"\r\n\r\n")
    http = _fields(head.decode("latin-1").split("\r\n")[1:])
    return body, not (http.get("transfer-encoding") or http.get("content-encoding"))


def hex_digest(labelled: str) -> str | None:
    """Lower-case hex of a labelled SHA-1 in base 16 or 32; None for other algorithms."""
    name, _, value = labelled.partition(":")
    if name.lower() != "sha1":
        return None
    return value.lower() if len(value) == 40 else base64.b32decode(value.upper()).hex()


def index_key(url: str | None) -> str:
    """Host labels from the top domain down, then the path, as index lines are sorted by."""
    m = re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)(.*)", url or "", re.S)
    key = ",".join(reversed(m[1].lower().split("."))) + ")" + (m[2] or "/") if m else url or "-"
    return quote(key, safe="/:?&=%,)(;@!$*+~._-") or "-"


# ---------------------------------------------------------------- Spark: write, list, read

def _file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def plan_records(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """page_id, url, payload, digest, refers_to and refers_url (null for a response)."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    same = (rows.where(F.length("payload") >= min_bytes).groupBy("digest")
            .agg(F.max("page_id").alias("last"), F.max_by("url", "page_id").alias("last_url"), F.count("*").alias("n"))
            .where("n > 1").select("digest", "last", "last_url"))
    revisit = F.col("last").isNotNull() & F.col("page_id").isNotNull() & (F.col("page_id") != F.col("last"))
    return rows.join(same, "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(revisit, F.col("last")).alias("refers_to"),
        F.when(revisit, F.col("last_url")).alias("refers_url"))


def write_packages(records: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES, date: str = DATE) -> DataFrame:
    """Write packages below `folder` (any store that Arrow's file systems reach); returns (path, n_records).

    Every task writes files of its own name, and only the files of the attempt
    that succeeded are listed, so a task that is run again does no harm.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = _file_system(folder)
        store.create_dir(base, recursive=True)
        task = TaskContext.get()
        stamp = "".join(re.findall(r"\d", date))[:14]
        own = f"{task.partitionId()}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        parts, lines, at, made = [], [], 0, 0

        def close() -> pd.DataFrame:
            nonlocal parts, lines, at, made
            path = f"{folder}/{own}-{made}.wacz"
            data = zip_stored([(WARC, b"".join(parts)), (INDEX, "".join(sorted(lines)).encode())])
            with store.open_output_stream(f"{base}/{own}-{made}.wacz") as f:
                f.write(data)
            found = pd.DataFrame({"path": [path], "n_records": [len(lines)]})
            parts, lines, at, made = [], [], 0, made + 1
            return found

        for b in batches:
            for page_id, url, payload, digest, refers, refers_url in zip(
                    b["page_id"].astype(object), b["url"], b["payload"], b["digest"],
                    b["refers_to"].astype(object), b["refers_url"], strict=True):
                page_id, refers = (None if pd.isna(x) else int(x) for x in (page_id, refers))
                kind = "response" if refers is None else "revisit"
                unique = uuid.uuid5(uuid.NAMESPACE_URL, f"{own}-{made}/{len(lines)}").urn
                packed = gzip.compress(warc_record(kind, unique, page_id, url, bytes(payload), digest, refers, refers_url, date),
                                       1, mtime=0)
                lines.append(f"{index_key(url)} {stamp} " + json.dumps(
                    {"url": url or "", "digest": f"sha1:{digest}", "mime": "text/html" if refers is None else "warc/revisit",
                     "status": "200", "filename": WARC.partition("/")[2], "offset": str(at), "length": str(len(packed))}) + "\n")
                parts.append(packed)
                at += len(packed)
                if at >= package_bytes:
                    yield close()
        if lines:
            yield close()

    # page_id through a nullable integer type: pandas must not turn long ids into doubles
    ids = records.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
    return materialize(ids.mapInPandas(run, "path string, n_records long"), "packages")


def indexed_records(read_at, members: dict[str, tuple[int, int]]) -> list[tuple[int, int]]:
    """(offset, length) in the package of each record that its index lines name."""
    archives = {name.removeprefix("archive/"): place for name, place in members.items()
                if name.startswith("archive/") and name.endswith((".warc", ".warc.gz"))}
    indexes = [name for name in members if name.startswith("indexes/") and re.search(r"\.cdxj?(\.gz)?$", name)]
    if archives and not indexes:
        raise ValueError("the package has no index")
    found = []
    for name in sorted(indexes):
        raw = read_at(*members[name])
        text = (gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw).decode()
        for line in text.split("\n"):
            at = line.find("{")
            if at < 0 or line.startswith("!"):  # a header line
                continue
            entry = json.loads(line[at:])
            file = entry.get("filename") or (next(iter(archives)) if len(archives) == 1 else None)
            file = file.removeprefix("archive/") if file else file
            if file not in archives:
                raise ValueError(f"the index names {file}, which the package does not hold")
            base, size = archives[file]
            offset, length = int(entry["offset"]), int(entry["length"])
            if offset < 0 or length < 0 or offset + length > size:
                raise ValueError(f"a record of {file} reaches over its end")
            found.append((base + offset, length))
    return found


def list_records(packages: DataFrame) -> DataFrame:
    """(path, offset, length) of each record: central directory, member, index, all read by ranges."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path in b["path"]:
                store, at = _file_system(path)
                with store.open_input_file(at) as f:
                    read_at = lambda where, n, f=f: f.read_at(n, where)
                    found = indexed_records(read_at, zip_directory(read_at, f.size()))
                yield pd.DataFrame({"path": path, "offset": [o for o, _ in found], "length": [n for _, n in found]},
                                   ).astype({"offset": "int64", "length": "int64"})

    return packages.select("path").mapInPandas(run, "path string, offset long, length long")


READ_SCHEMA = ("page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
               "record_type string, refers_to long")


def read_records(index: DataFrame, payload: bool = True) -> DataFrame:
    """Read each listed record by its range.  A revisit has no payload of its own; its length and digest
    are those of the payload it refers to.  A payload that does not match its digest raises ValueError."""
    names = [f.split()[0] for f in READ_SCHEMA.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        number = lambda text: int(text) if text else None
        for b in batches:
            rows = []
            for path, part in b.groupby("path"):
                store, at = _file_system(path)
                with store.open_input_file(at) as f:
                    for offset, length in zip(part["offset"].tolist(), part["length"].tolist(), strict=True):
                        raw = f.read_at(length, offset)
                        head, block = parse_warc(gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw)
                        kind = head["warc-type"].lower()
                        if kind not in ("response", "resource", "revisit"):
                            continue  # requests, metadata and the like have no page
                        body, plain = payload_of(head, block)
                        stated = hex_digest(head.get("warc-payload-digest", ""))
                        own = kind != "revisit"
                        if own and plain and stated not in (None, hashlib.sha1(body).hexdigest()):
                            raise ValueError(f"{path} at {offset}: the payload does not match its digest")
                        digest = stated or (hashlib.sha1(body).hexdigest() if own else None)
                        size = len(body) if own else number(head.get("x-payload-length"))
                        rows.append((number(head.get("x-page-id")), head.get("warc-target-uri"),
                                     body if payload and own else None, size, digest, kind,
                                     number(head.get("x-refers-to-page"))))
            found = pd.DataFrame(rows, columns=names, dtype=object)
            for c in ("page_id", "payload_bytes", "refers_to"):
                found[c] = pd.array(found[c].tolist(), dtype="Int64")
            yield found

    return index.mapInPandas(run, READ_SCHEMA)


def round_trip(spark: SparkSession, pages: DataFrame, folder: str | None = None, payload: bool = False) -> DataFrame:
    """Write `pages` as packages below `folder` (default: the shared scratch folder) and read them back."""
    folder = folder or scratch_path(spark, f"warc-{uuid.uuid4().hex}")
    return read_records(list_records(write_packages(plan_records(pages), folder)), payload)


def op10_warc(pages: DataFrame) -> DataFrame:
    return round_trip(pages.sparkSession, pages).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP10_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     d AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest
           FROM p),
     r AS (SELECT *, CASE WHEN payload_bytes >= 1000
                          THEN max(page_id) OVER (PARTITION BY payload_digest) END AS last FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN last IS NULL OR page_id IS NULL OR page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM r
"""
