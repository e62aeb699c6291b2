"""WARC archives: a writer and a reader that salvages damaged files.

The reader checks every record (gzip CRC, version line, content length, the
record's end, payload digest). After a failed check it searches on for the next
place where a whole record passes: the next version line, in a plain file or
within a gzip member that holds several records, and the next gzip member in a
compressed file. A file gzipped as a whole is one such member. The bytes in between are reported as
``gap`` rows with their offset, length and reason, and later records are kept.

Archives live in a folder all executors share and are opened by URI through
pyarrow's file systems. A writing task names its files by a random id and
reports them in its output rows, so what a failed attempt left is never read.
Memory: two records and one read buffer for each task.

Rows: null html counts as an empty payload, a null or odd url becomes a valid
header value; null ids are kept (an id of null is written as ``none``);
repeated ids are separate records; an empty table gives no archive and no row.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, scratch_path, written

CRLF = b"\r\n"
VERSION = b"WARC/1.1"
# Fixed values of the format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP_MAGIC = b"\x1f\x8b\x08"
VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
ID = "urn:x-page:"


@dataclass(frozen=True)
class Params:
    min_revisit_bytes: int = 0
    archive_bytes: int = 64 << 20
    level: int = 6
    compress: bool = True
    date: str = "2024-01-01T00:00:00Z"


def b32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, p: Params) -> bytes:
    """One record (uncompressed). A revisit keeps its headers, not its payload."""
    name = "none" if page_id is None else str(page_id)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{ID}{name}>"),
        ("WARC-Date", p.date),
        ("WARC-Target-URI", quote(url or "urn:x-none:", safe=":/?#[]@!$&'()*+,;=%~-._")),
        ("WARC-Payload-Digest", "sha1:" + b32_sha1(payload)),
        ("Content-Type", "application/http; msgtype=response"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if revisit:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{ID}{refers_to}>")]
    head.append(("Content-Length", str(len(block))))
    lines = CRLF.join([VERSION, *(f"{k}: {v}".encode() for k, v in head)])
    return lines + CRLF + CRLF + block + CRLF + CRLF


class Damaged(ValueError):
    """A record that fails a check."""


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes, int]:
    """(headers with lower-case names, block, bytes used) of the record at the
    start of ``raw``; raises :class:`Damaged`."""
    if not VERSION_LINE.match(raw):
        raise Damaged("no version line")
    end = raw.find(CRLF + CRLF)
    if end < 0:
        raise Damaged("unfinished header")
    head: dict[str, str] = {}
    for line in raw[:end].split(CRLF)[1:]:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if not colon:
            raise Damaged("bad header line")
        head[name.strip().lower()] = value.strip()
    if not head.get("content-length", "").isdigit():
        raise Damaged("no content length")
    size, start = int(head["content-length"]), end + 4
    if len(raw) < start + size + 4:
        raise Damaged("truncated block")
    if raw[start + size : start + size + 4] != CRLF + CRLF:
        raise Damaged("record end not found")
    return head, raw[start : start + size], start + size + 4


def describe(head: dict[str, str], block: bytes) -> dict:
    """The columns of a record; checks a response's payload digest."""
    body = block.find(CRLF + CRLF)
    payload = block[body + 4 :] if body >= 0 else block
    kind = head.get("warc-type", "")
    stated = head.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if kind == "response":
        own = b32_sha1(payload)
        if stated and own != stated:
            raise Damaged("payload digest differs")
        size, stated = len(payload), own
    else:
        size = int(head["x-payload-length"]) if head.get("x-payload-length", "").isdigit() else len(payload)
    return {
        "record_type": kind,
        "record_id": head.get("warc-record-id"),
        "target_uri": head.get("warc-target-uri"),
        "refers_to_id": head.get("warc-refers-to"),
        "payload_bytes": size,
        "payload_digest": stated,
        "payload": payload,
    }


class Archive:
    """Buffered reads at offsets of one archive."""

    STEP = 4 << 20

    def __init__(self, uri: str):
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(uri)
        self.file = store.open_input_file(path)
        self.size = self.file.size()
        self.at, self.buf = 0, b""

    def read(self, pos: int, n: int) -> bytes:
        n = min(n, self.size - pos)
        if n <= 0:
            return b""
        if not (self.at <= pos and pos + n <= self.at + len(self.buf)):
            self.at, self.buf = pos, self.file.read_at(max(n, min(self.STEP, self.size - pos)), pos)
        return self.buf[pos - self.at : pos - self.at + n]

    def find(self, pos: int, pattern: re.Pattern, longest: int) -> int:
        """The first match at or after ``pos``; the size if there is none."""
        while pos < self.size:
            piece = self.read(pos, self.STEP // 2)
            m = pattern.search(piece)
            if m:
                return pos + m.start()
            pos += max(1, len(piece) - longest + 1) if pos + len(piece) < self.size else len(piece)
        return self.size

    def close(self) -> None:
        self.file.close()


class Member:
    """The content of the gzip member at ``pos``, decompressed as far as asked
    for. ``at``: how much of it has been dropped; ``failed``: why it broke off."""

    def __init__(self, a: Archive, pos: int):
        self.a, self.pos, self.next = a, pos, pos
        self.z = zlib.decompressobj(31)
        self.buf, self.at, self.failed = b"", 0, ""

    def fill(self, n: int) -> bytes:
        """The content from ``at`` on: ``n`` bytes, or what there is."""
        parts, have = [self.buf], len(self.buf)
        while have < n and not self.z.eof and not self.failed:
            chunk = self.a.read(self.next, 1 << 16)
            if not chunk:
                self.failed = "truncated member"
                break
            self.next += len(chunk)
            before = self.z.copy()
            try:
                parts.append(self.z.decompress(chunk))
            except zlib.error as e:
                self.failed = f"gzip: {e}"
                parts.append(_before_error(before, chunk))
                break
            have += len(parts[-1])
        self.buf = b"".join(parts)
        return self.buf

    def drop(self, n: int) -> None:
        self.buf, self.at = self.buf[n:], self.at + n

    @property
    def used(self) -> int:
        """Compressed length of a member read to its end."""
        return self.next - len(self.z.unused_data) - self.pos


def _before_error(z, chunk: bytes) -> bytes:
    """What ``z`` gives of a chunk that fails: step by step, finer at the end."""
    out = []
    for step in (1024, 1):
        while chunk:
            before = z.copy()
            try:
                out.append(z.decompress(chunk[:step]))
            except zlib.error:
                z = before
                break
            chunk = chunk[step:]
    return b"".join(out)


def _first_record(m: Member) -> tuple[dict, int]:
    """(row, length) of the record that begins where ``m`` stands."""
    n = 1 << 13
    while True:
        raw = m.fill(n)
        if not VERSION_LINE.match(raw):
            raise Damaged("no version line")
        end = raw.find(CRLF + CRLF)
        if end >= 0:
            break
        if len(raw) < n:
            raise Damaged("unfinished header")
        n *= 4
    stated = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", raw[: end + 2])
    want = end + 8 + int(stated[1]) if stated else n
    head, block, taken = parse_record(m.fill(want)[:want])
    return describe(head, block), taken


def _of_member(a: Archive, pos: int) -> Iterator[dict | Member]:
    """Records and inner gaps of the member at ``pos``, then the member itself.

    A record is held back until what follows it has been read, or the member
    has ended with the right checksum: the last one before a failure is not
    trusted. Two records are in memory at most."""
    m, held, gap, why = Member(a, pos), None, None, ""
    while m.fill(1):
        try:
            row, taken = _first_record(m)
        except Damaged as e:
            if gap is None:
                gap, why = m.at, str(e)
            m.drop(1)
            while not (found := VERSION_LINE.search(m.fill(1 << 16))) and len(m.buf) > 10:
                m.drop(len(m.buf) - 10)
            m.drop(found.start() if found else len(m.buf))
            continue
        if held:
            yield held
            held = None
        if gap is not None:
            yield {"kind": "gap", "offset": pos, "inner_offset": gap, "length": m.at - gap, "reason": why}
            gap = None
        held = {"kind": "record", "offset": pos, "inner_offset": m.at, "length": taken, **row}
        m.drop(taken)
    if not m.failed:
        if held:
            yield held
        if gap is not None:
            yield {"kind": "gap", "offset": pos, "inner_offset": gap, "length": m.at - gap, "reason": why}
    yield m


def _plain(a: Archive, pos: int) -> tuple[bytes, int]:
    """The bytes of a plain record at ``pos``, as far as its length says."""
    n = 1 << 13
    while True:
        raw = a.read(pos, n)
        if not VERSION_LINE.match(raw):
            raise Damaged("no version line")
        end = raw.find(CRLF + CRLF)
        if end >= 0:
            m = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", raw[: end + 2])
            want = end + 8 + int(m[1]) if m else n
            raw = a.read(pos, max(want, 1))
            return raw, len(raw)
        if len(raw) < n:
            raise Damaged("unfinished header")
        n *= 4


def salvage(a: Archive) -> Iterator[dict]:
    """Records and gaps of an archive, in order, covering every byte.

    Offsets and lengths are those in the file. What stands in a gzip member
    beside other records has the member's offset, and ``inner_offset`` and
    ``length`` within its content. A gap that begins in a member which breaks
    off has as ``inner_offset`` where the records kept of it end."""
    zipped = a.read(0, 3) == GZIP_MAGIC or a.find(0, re.compile(re.escape(GZIP_MAGIC)), 3) < a.find(0, VERSION_LINE, 10)
    return _salvaged(a, re.compile(re.escape(GZIP_MAGIC)), _zipped) if zipped else _salvaged(a, VERSION_LINE, _one)


def _one(a: Archive, pos: int) -> Iterator[dict | int]:
    """The plain record at ``pos``, then the bytes it takes."""
    raw, used = _plain(a, pos)
    head, block, _ = parse_record(raw)
    yield {"kind": "record", "offset": pos, "length": used, **describe(head, block)}
    yield used


def _zipped(a: Archive, pos: int) -> Iterator[dict | int]:
    """Rows of the member at ``pos``, then the bytes it takes."""
    alone, kept = None, None  # the only row so far; where kept records end
    for row in _of_member(a, pos):
        if isinstance(row, Member):
            break
        if alone is None and kept is None:
            alone, kept = row, row["inner_offset"] + row["length"]
            continue
        if alone is not None:
            yield alone
            alone = None
        yield row
        kept = row["inner_offset"] + row["length"]
    member = row
    whole = not member.failed
    if kept is None or alone is not None and alone["kind"] == "gap":
        raise Damaged(member.failed or (alone["reason"] if alone else "empty member"))
    if alone is not None:
        yield {**alone, "inner_offset": None, "length": member.used} if whole else alone
    if not whole:
        broken = Damaged(member.failed)
        broken.inner = kept
        raise broken
    yield member.used


def _salvaged(a: Archive, mark: re.Pattern, rows) -> Iterator[dict]:
    pos, gap = 0, None

    def closed(to: int) -> dict:
        at, inner, reason = gap
        return {"kind": "gap", "offset": at, "inner_offset": inner, "length": to - at, "reason": reason}

    while pos < a.size:
        used = 0
        try:
            for row in rows(a, pos):
                if isinstance(row, int):
                    used = row
                    break
                if gap:
                    yield closed(pos)
                    gap = None
                yield row
        except Damaged as e:
            gap = gap or (pos, getattr(e, "inner", None), str(e))
            pos = a.find(pos + 1, mark, 10)
            continue
        pos += used
    if gap:
        yield closed(a.size)


COLUMNS = {
    "path": pa.string(), "kind": pa.string(), "offset": pa.int64(), "inner_offset": pa.int64(), "length": pa.int64(), "reason": pa.string(),
    "record_type": pa.string(), "record_id": pa.string(), "target_uri": pa.string(), "refers_to_id": pa.string(),
    "payload_bytes": pa.int64(), "payload_digest": pa.string(), "payload": pa.binary(),
}
SCHEMA = (
    "path string, kind string, offset long, inner_offset long, length long, reason string, record_type string, record_id string, "
    "target_uri string, refers_to_id string, payload_bytes long, payload_digest string, payload binary"
)


def read(paths: DataFrame, payloads: bool = True, batch_bytes: int = 16 << 20) -> DataFrame:
    """Records and gaps of the archives in column ``path`` (URIs). Without
    ``payloads`` the payload column is null (it is still checked)."""

    def rows(batch: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r.get(c) for r in batch], t) for c, t in COLUMNS.items()], names=list(COLUMNS)
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column("path").to_pylist():
                archive, held, weight = Archive(path), [], 0
                for r in salvage(archive):
                    weight += 200 + len(r.get("payload") or b"") * payloads
                    held.append({"path": path, **r, "payload": r.get("payload") if payloads else None})
                    if weight >= batch_bytes or len(held) >= 10_000:
                        yield rows(held)
                        held, weight = [], 0
                archive.close()
                if held:
                    yield rows(held)

    return paths.select("path").mapInArrow(run, SCHEMA)


def write(pages: DataFrame, folder: str, p: Params = Params()) -> DataFrame:
    """Write ``pages`` (page_id, url, html, refers_to) as archives below
    ``folder``; lazily gives the manifest (path, records, bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        out, uri, records, size = None, "", 0, 0

        def manifest() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([records]), pa.array([size])], names=["path", "records", "bytes"])

        for b in batches:
            for page_id, url, html, refers in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to"))):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc" + ".gz" * p.compress
                    store.create_dir(base, recursive=True)
                    out, uri, records, size = store.open_output_stream(f"{base}/{name}", compression=None), f"{folder}/{name}", 0, 0
                raw = make_record(page_id, url, (html or "").encode("utf-8", "surrogatepass"), refers, p)
                if p.compress:
                    z = zlib.compressobj(p.level, zlib.DEFLATED, 31)
                    raw = z.compress(raw) + z.flush()
                out.write(raw)
                records, size = records + 1, size + len(raw)
                if size >= p.archive_bytes:
                    out.close()
                    yield manifest()
                    out = None
        if out is not None:
            out.close()
            yield manifest()

    return pages.select("page_id", "url", "html", "refers_to").mapInArrow(run, "path string, records long, bytes long")


def with_refers_to(pages: DataFrame, p: Params = Params()) -> DataFrame:
    """Adds ``refers_to``: of records with equal payloads of at least
    ``min_revisit_bytes``, the largest id; null for that record itself.

    Only digests are grouped (pre-aggregated, so a payload of very many copies
    costs one row a task); payloads meet the few repeated digests in a join
    that AQE splits where one digest is hot."""
    html = F.coalesce("html", F.lit(""))
    digest = F.when(F.octet_length(html) >= p.min_revisit_bytes, F.sha1(F.encode(html, "UTF-8")))
    marked = pages.withColumn("_sha1", digest)
    shared = written(
        marked.filter("_sha1 IS NOT NULL").groupBy("_sha1")
        .agg(F.max("page_id").alias("_first"), F.count("*").alias("_n")).filter("_n > 1").select("_sha1", "_first"),
        "digests",
    )
    refers = F.when(F.col("page_id").eqNullSafe(F.col("_first")), F.lit(None)).otherwise(F.col("_first"))
    return marked.join(shared, "_sha1", "left").withColumn("refers_to", refers).drop("_sha1", "_first")


def round_trip(df: DataFrame, p: Params = Params()) -> DataFrame:
    """Write a record for each page, read the archives back, one row each."""
    spark = df.sparkSession
    pages = pick(df, page_id="page_id", url="url", html="html")
    folder = scratch_path(spark, "warc")
    archives = written(write(with_refers_to(pages, p), folder, p), "manifest")
    n = max(1, min(archives.count(), 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    back = read(archives.select("path").repartition(n), payloads=False).filter("kind = 'record'")
    number = lambda c: F.regexp_extract(c, r"^<urn:x-page:(-?\d+)>$", 1).try_cast("long")
    return back.select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        number("refers_to_id").alias("refers_to"),
    )
