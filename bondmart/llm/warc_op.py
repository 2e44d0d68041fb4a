"""WARC archives: a writer with revisit records and a salvage reader.

The writer makes one gzip member per record. Archives are files of the
session's file system, written by Spark's text sink: a member ends in the
high byte of its length, which is zero below 16 MB, and exactly this byte is
left to the sink's line separator, so a file is the plain concatenation of
its members (a larger record is followed by an empty member). A file holds at
most ``records`` records, and is bounded in bytes too.

The reader takes each archive as a row and walks its members, or its bare
records from version line to version line. A record counts only if the
member's checksum, the record's length and its payload digest are right. After
a failed check the reader looks for the next place where a valid member or
version line begins, also inside a member, goes on there, and logs the bytes
between as a gap with the reason. Digests are of the block or an HTTP body, in
hex or base32.

Defined cases: a null or empty html gives an empty payload; repeated rows
(same page_id and payload) get a record each and are of one type; rows with a
null page_id are written without an id and are always responses; a null url
becomes an empty target; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bondmart.llm.common import column, shared_path, ship, table

REVISIT_BYTES = 1000
RECORDS_PER_FILE = 4096
ROW_BYTES, FILE_BYTES = 4 << 20, 64 << 20  # members written together, and a file's size
HEADER_BYTES = 1 << 16
VERSION = b"WARC/1."
_MAGIC = b"\x1f\x8b\x08"
_END = b"\r\n\r\n"


def record_types(pages: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """pages(page_id, url, html) with payload, payload_digest, refers_to
    (the largest page_id with the same payload, where that isn't the row's)."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha1("payload"))
    thin = rows.where((F.octet_length("payload") >= least_bytes) & F.col("page_id").isNotNull()).select(
        "page_id", F.col("payload_digest").alias("digest"))
    last = thin.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least"))
    last = last.where("least < refers_to").drop("least")
    revisits = thin.join(last, "digest").where("page_id < refers_to").distinct().withColumnRenamed("page_id", "id")
    same = (F.col("page_id") == F.col("id")) & (F.col("payload_digest") == F.col("digest"))
    return rows.join(revisits, same, "left").drop("id", "digest")


def record(headers: list[tuple[str, str]], payload: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in headers)
    return f"WARC/1.1\r\n{head}Content-Length: {len(payload)}\r\n\r\n".encode() + payload + _END


def member(data: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    out = z.compress(data) + z.flush()
    if out[-1]:  # its length ends in another byte than zero
        z = zlib.compressobj(1, zlib.DEFLATED, 31)
        out += z.flush()
    return out


def page_record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    ident = "" if page_id is None else str(page_id)
    headers = [("WARC-Type", "response" if refers_to is None else "revisit"),
               ("WARC-Record-ID", f"<urn:page:{ident}>"),
               ("WARC-Target-URI", " ".join(url.split())),
               ("WARC-Payload-Digest", f"sha1:{digest}"),
               ("WARC-Payload-Length", str(len(payload)))]
    if refers_to is not None:
        headers += [("WARC-Refers-To", f"<urn:page:{refers_to}>"),
                    ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
        payload = b""
    return record(headers, payload)


def _members(records: int):
    """Members of up to ``records`` rows (or ROW_BYTES) as one row of the sink."""
    names = ("page_id", "url", "payload", "payload_digest", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for i in range(batch.num_rows):
                held.append(member(page_record(*(column(batch, n)[i].as_py() for n in names))))
                size += len(held[-1])
                if len(held) >= records or size >= ROW_BYTES or i == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)[:-1]], pa.binary())], ["members"])
                    held, size = [], 0

    return run


def write_archives(pages: DataFrame, path: str, records: int = RECORDS_PER_FILE) -> None:
    """One record per row of pages, as gzip members in files under ``path``: at
    most ``records`` records a file, and about FILE_BYTES and one record more."""
    ship(pages.sparkSession)
    rows = max(1, FILE_BYTES // ROW_BYTES)
    members = record_types(pages).mapInArrow(_members(max(1, records // rows)), "members binary")
    # the bytes pass through the text sink as they are; its separator is each row's last byte
    members.select(F.col("members").cast("string")).write.option("lineSep", "\0").option(
        "maxRecordsPerFile", min(rows, records)).text(path)


class Finder:
    """Next places of a signature, searched once over the data as it is read forward."""

    def __init__(self, data: bytes, signature: bytes):
        self.data, self.signature, self.begin, self.found = data, signature, 0, -1

    def next(self, at: int) -> int:
        """The first place from ``at`` on; the data's length if there is none."""
        if not self.begin <= at <= self.found:
            self.begin, self.found = at, self.data.find(self.signature, at)
            if self.found < 0:
                self.found = len(self.data)
        return self.found


def _gzip_header(data: bytes, at: int) -> bool:
    """Is there a gzip header of sound flags and bounded size?"""
    flags, pos = data[at + 3:at + 4], at + 10
    if not flags or flags[0] & 0xE0 or pos > len(data):
        return False
    if flags[0] & 4:
        pos += 2 + int.from_bytes(data[pos:pos + 2], "little")
    for flag in (8, 16):  # a name and a comment, both ended by a zero
        if flags[0] & flag:
            pos = data.find(b"\0", pos, pos + HEADER_BYTES) + 1
            if not pos:
                return False
    return pos <= len(data)


def _inflate(data: bytes, at: int) -> tuple[bytes, int, str]:
    """One gzip member at ``at``: its content (what there is of it), where it
    ends, and what is wrong with it."""
    if not _gzip_header(data, at):
        return b"", at, "not a member"
    z = zlib.decompressobj(31)
    out, pos, reason = [], at, ""
    try:
        while not z.eof and not reason:
            if pos >= len(data):
                reason = "truncated member"
            out.append(z.decompress(data[pos:pos + 65536]))
            pos += 65536
    except zlib.error as e:
        reason = "checksum" if "check" in str(e) else "damaged member" if out else "not a member"
    return b"".join(out), min(pos, len(data)) - len(z.unused_data), reason


def _digest_state(fields: dict, payload: bytes) -> bool | None:
    """Is the payload digest right (None: no digest that can be checked)? It
    is of the block or, for HTTP messages, of their body; in hex or base32."""
    name, _, want = fields.get("warc-payload-digest", "").partition(":")
    name = name.lower().replace("-", "")
    if fields.get("warc-type") == "revisit" or not want or name not in ("sha1", "sha256", "md5"):
        return None
    bodies = [payload]
    if fields.get("content-type", "").lower().startswith("application/http"):
        bodies.append(payload.partition(_END)[2])
    for body in bodies:
        digest = hashlib.new(name, body).digest()
        if want.lower() == digest.hex() or want.upper().rstrip("=") == base64.b32encode(digest).decode().rstrip("="):
            return True
    return False


class Records:
    """WARC records of some bytes, read forward."""

    def __init__(self, data: bytes):
        self.data = data
        self.versions, self.lines, self.ends = (Finder(data, s) for s in (VERSION, b"\r\n", _END))

    def parse(self, at: int) -> tuple[dict | None, int, str]:
        """The record that begins at ``at``: its fields, where it ends, or why it is none."""
        data = self.data
        if not data.startswith(VERSION, at) or not data[at + len(VERSION):min(self.lines.next(at), at + 16)].isdigit():
            return None, at, "no version line"
        head = self.ends.next(at)
        if head - at > HEADER_BYTES or head >= len(data):
            return None, at, "truncated header"
        fields = {}
        for line in data[at:head].split(b"\r\n")[1:]:
            name, colon, value = line.partition(b":")
            if not colon:
                return None, at, "bad header"
            fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
        length = fields.get("content-length", "")
        if not (length.isascii() and length.isdigit()) or len(length) > 18:
            return None, at, "bad length"
        end = head + 4 + int(length)
        if data[end:end + 4] != _END:
            return None, at, "length"
        payload = data[head + 4:end]
        state = _digest_state(fields, payload)
        if state is False:
            return None, at, "digest"
        return fields | {"payload": payload, "checked": state is True}, end + 4, ""

    def salvage(self) -> Iterator[tuple[int, int, dict | None, str]]:
        """(begin, length, record, '') and (begin, length, None, reason) of all bytes, in order."""
        at, bad, why = 0, None, ""
        while at < len(self.data):
            fields, end, reason = self.parse(at)
            if fields is None:
                if bad is None:
                    bad, why = at, reason
                at = self.versions.next(at + 1)
                continue
            if bad is not None:
                yield bad, at - bad, None, why
                bad = None
            yield at, end - at, fields, ""
            at = end
        if bad is not None:
            yield bad, len(self.data) - bad, None, why


def salvage(data: bytes) -> Iterator[tuple[int, int, dict | None, str]]:
    """(offset, length, record, '') for each valid record and (offset, length,
    None, reason) for each gap, in order of the file.

    Records and gaps inside a member have the member's offset and length. A
    damaged member is a gap; of what it inflates to, records whose digest is right
    are kept, with its offset and no length of their own. Signatures are searched
    once over the file, so time grows with its size whatever it holds."""
    magics, bare = Finder(data, _MAGIC), Records(data)
    at, bad, why = 0, None, ""
    while at < len(data):
        kept: list[tuple[int, int, dict | None, str]] = []
        saved: list[dict] = []
        if data.startswith(_MAGIC, at):
            content, end, reason = _inflate(data, at)
            parts = list(Records(content).salvage()) if content else []
            found = [f for *_, f, _ in parts if f]
            if reason:
                saved = [f for f in found if f["checked"]]
            elif found or not content:
                for begin, size, f, inner in parts:
                    kept.append((at, end - at, f, f"{inner} in bytes {begin} to {begin + size} of a member" if f is None else ""))
            else:
                reason = parts[0][3]
        else:
            fields, end, reason = bare.parse(at)
            if fields is not None:
                kept.append((at, end - at, fields, ""))
        if not reason:
            if bad is not None:
                yield bad, at - bad, None, why
                bad = None
            yield from kept
            at = end
            continue
        if bad is None:
            bad, why = at, reason
        if saved and bad < at:  # its records stand at the member's offset, so the gap before it ends there
            yield bad, at - bad, None, why
            bad, why = at, reason
        for fields in saved:
            yield at, 0, fields, ""
        at = min(magics.next(at + 1), bare.versions.next(at + 1))
    if bad is not None:
        yield bad, len(data) - bad, None, why


_READ = ("archive string, offset long, length long, gap string, page_id long, url string, record_type string, "
         "payload_bytes long, payload_digest string, refers_to long, payload binary")


def _number(urn: str) -> int | None:
    n = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(n) if n.lstrip("-").isdigit() else None


def _salvaged(with_payload: bool):
    names = [c.split()[0] for c in _READ.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(),
             pa.string(), pa.int64(), pa.binary()]

    def block(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                path, data = column(batch, "path")[i].as_py(), column(batch, "content")[i].as_py()
                rows: list[tuple] = []
                for at, size, f, reason in salvage(data):
                    if f is None:
                        rows.append((path, at, size, reason, *[None] * 7))
                    else:
                        length = f.get("warc-payload-length", "")
                        rows.append((
                            path, at, size, None, _number(f.get("warc-record-id", "")), f.get("warc-target-uri"),
                            f.get("warc-type"), int(length) if length.isdigit() else len(f["payload"]),
                            f.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                            _number(f.get("warc-refers-to", "")), f["payload"] if with_payload else None))
                    if len(rows) >= 512:
                        yield block(rows)
                        rows = []
                if rows:
                    yield block(rows)

    return run


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """A row per record and per gap (gap: the reason, null for records) of
    all archives under ``path``. An archive is one row, so a file must fit
    in a task's memory; the writer's files do."""
    ship(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_salvaged(with_payload), _READ)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "archives")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path).where("gap is null").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP1_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), w AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to
FROM w
"""
