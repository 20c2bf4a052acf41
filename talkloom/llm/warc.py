"""WARC archives: writing with revisits of equal payloads, and a splittable reader.

Archives are files of gzip members, one WARC record each.  They are written by
Spark's own text writer, so that they reach any file system under its commit
protocol: a gzip member of less than 16 MiB ends with a zero byte, which serves
as the line separator; after a larger one the separator is zero padding, which
gzip readers skip.

The reader deals byte ranges of the files to tasks.  A task scans its range for
the gzip magic, takes a place for a record only if it inflates to a WARC
header, and owns the records that start inside its range, reading past the end
to finish the last one.

Defined cases: null html is an empty payload; null urls have no target header;
of equal payloads of at least ``min_bytes`` the largest page id is the
response, also on every row that repeats it, and null ids come last; an empty
table writes no records and reads none; payloads of any length are written and
read whole.  A member that doesn't inflate, is cut short, fails its checksum or
holds no WARC record fails the read, or, if it isn't strict, gives a row with
an error; the records after it are read all the same.

A range that starts inside a record takes the first place that inflates to a
WARC record for one.  So a payload may be misread only if it holds whole gzip
members of WARC records and the compressor left them as they are.  UTF-8 text
can't, as the magic is no UTF-8; archives with such binary payloads are read
exactly with one range a file (``split_bytes`` beyond its length).
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_folder, stored

MAGIC = b"\x1f\x8b\x08"
#: Bytes of a file that a task owns, and bytes read at a time.
SPLIT_BYTES = 16 << 20
READ_BYTES = 1 << 20
#: Most bytes of a WARC header.
HEADER_BYTES = 1 << 16
#: Fixed value of the WARC standard: revisits of the same payload.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2020-01-01T00:00:00Z"


def record_id(page_id) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def page_of(value: str | None) -> int | None:
    digits = value[len("<urn:x-page:") : -1] if value else ""
    return int(digits) if digits else None


def build_record(page_id, url: str | None, payload: bytes, refers_to) -> bytes:
    """One WARC record; with ``refers_to`` a revisit that leaves the payload out."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {url.replace(chr(13), '%0D').replace(chr(10), '%0A')}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def parse_record(raw: bytes) -> dict | None:
    """The fields of an inflated record, None if it is malformed."""
    head, gap, block = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not gap or not lines[0].startswith("WARC/"):
        return None
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    if not fields.get("content-length", "").isdigit() or len(block) < int(fields["content-length"]):
        return None
    block = block[: int(fields["content-length"])]
    http, gap, payload = block.partition(b"\r\n\r\n")
    lengths = [x.split(b":", 1)[1] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    said = base64.b32decode(fields.get("warc-payload-digest", "sha1:").partition(":")[2]).hex()
    kind = fields.get("warc-type")
    own = kind == "response"
    return {
        "page_id": page_of(fields.get("warc-record-id")),
        "url": fields.get("warc-target-uri"),
        "payload_bytes": len(payload) if own or not lengths else int(lengths[0]),
        "payload_digest": hashlib.sha1(payload).hexdigest() if own else said,
        "record_type": kind,
        "refers_to": page_of(fields.get("warc-refers-to")),
        "intact": not own or said == hashlib.sha1(payload).hexdigest(),
        "payload": payload,
    }


class RangeReader:
    """The records of one file that start in the byte range [start, end)."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size
        self.base, self.data = 0, b""

    def read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(min(n, self.size - at)) if at < self.size else b""

    def window(self, at: int, least: int = HEADER_BYTES) -> bytes:
        """Bytes from ``at`` on, at least so many or up to the end of the file."""
        if not self.base <= at <= self.base + len(self.data) or (
            self.base + len(self.data) - at < least and self.base + len(self.data) < self.size
        ):
            self.base, self.data = at, self.read(at, READ_BYTES)
        return self.data[at - self.base :]

    def inflate(self, at: int) -> tuple[bytes, int] | None:
        """The record that starts at ``at`` and the place after it, else None."""
        data = self.window(at)
        if not data.startswith(MAGIC):
            return None
        unpack = zlib.decompressobj(31)
        try:
            head = unpack.decompress(data, HEADER_BYTES)
            if not head.startswith(b"WARC/"):
                return None
            parts, place = [head], at + len(data)
            while not unpack.eof:
                more = unpack.unconsumed_tail
                if not more:
                    more = self.read(place, READ_BYTES)
                    place += len(more)
                    if not more:
                        return None
                parts.append(unpack.decompress(more, 1 << 24))
            return b"".join(parts), place - len(unpack.unused_data)
        except zlib.error:
            return None

    def padded(self, at: int) -> int:
        """The first place from ``at`` on that holds no zero."""
        while at < self.size:
            data = self.window(at, 1)
            rest = data.lstrip(b"\0")
            at += len(data) - len(rest)
            if rest:
                break
        return at

    def candidate(self, at: int, end: int) -> tuple[int, tuple[bytes, int]] | None:
        """The first place in [at, end) where a record starts, and the record."""
        while at < end:
            data = self.window(at, len(MAGIC))
            found = data.find(MAGIC)
            if found < 0:
                if len(data) < len(MAGIC):
                    return None
                at += len(data) - len(MAGIC) + 1
                continue
            at += found
            if at >= end:
                return None
            member = self.inflate(at)
            if member is not None:
                return at, member
            at += 1
        return None

    def records(self, start: int, end: int) -> Iterator[tuple[int, bytes | None]]:
        """(place, record); without a record where one should start but none does.

        Such a place is reported by the range that owns the record before it,
        or the file's start; whatever follows is found by its magic.
        """
        at: int = start
        due = start == 0
        while True:
            if due:
                at = self.padded(at)
                if at >= self.size:
                    return
                member = self.inflate(at)
                if member is None:
                    yield at, None
                    at, due = at + 1, False
                    continue
                if at >= end:
                    return
            else:
                found = self.candidate(at, end)
                if found is None:
                    return
                at, member = found
                due = True
            yield at, member[0]
            at = member[1]


def mark_revisits(pages: DataFrame, min_bytes: int, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(id, url, payload, refers_to): refers_to is the largest id among equal
    payloads, null for the rows that are to be responses.

    Payload groups are counted with a map-side combine; only narrow rows are
    joined by digest, and payloads move once, by their unique page ids.
    """
    folder = shared_folder(pages.sparkSession)
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.when(F.length("payload") >= min_bytes, F.sha1("payload")))
    large = rows.select("id", "digest").where("digest is not null")
    groups = large.groupBy("digest").agg(F.max("id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    groups = stored(groups.select("digest", "refers_to"), f"{folder}/groups")
    revisits = large.join(groups, "digest").where("refers_to is not null and (id is null or id <> refers_to)")
    revisits = stored(revisits.select("id", "digest", "refers_to").distinct(), f"{folder}/revisits")
    found = rows["id"].eqNullSafe(revisits["id"]) & (rows["digest"] == revisits["digest"])
    return rows.join(revisits, found, "left").select(rows["id"], "url", "payload", "refers_to")


def write_warc(
    pages: DataFrame,
    folder: str,
    min_bytes: int = 1000,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> None:
    """Write one record per page as gzip members into new files of ``folder``."""
    marked = mark_revisits(pages, min_bytes, id_col, url_col, html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                columns = [batch.column(i).slice(lo, 256).to_pylist() for i in range(4)]
                lines = []
                for page_id, url, payload, refers_to in zip(*columns, strict=True):
                    member = gzip_member(build_record(page_id, url, payload, refers_to))
                    lines.append(member[:-1] if member[-1] == 0 else member)
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary())], names=["member"])

    members = marked.mapInArrow(run, "member binary")
    members.select(F.col("member").cast("string")).write.option("lineSep", "\0").option("compression", "none").text(folder)


class DamagedArchive(ValueError):
    """A place of an archive where a record should start but none can be read."""


def arrow_uri(path: str) -> str:
    """A path as Arrow's file systems name it; Hadoop's names of S3 are s3 to them."""
    scheme, found, rest = path.partition("://")
    return f"s3://{rest}" if found and scheme in ("s3a", "s3n") else path


def read_warc(
    spark: SparkSession, folder: str, split_bytes: int = SPLIT_BYTES, with_payload: bool = False, strict: bool = True
) -> DataFrame:
    """Read all records of the archives in a folder, by byte ranges.

    Gives (path, place, page_id, url, payload_bytes, payload_digest,
    record_type, refers_to, intact, error), and the payload if asked for.  The
    length of a revisit's payload stands in its HTTP header, its digest in its
    WARC header; those of a response are taken from the payload itself.  A
    damaged place fails the read, or unless ``strict`` is a row with an error
    and nothing else.
    """
    files = spark.read.format("binaryFile").load(folder).where("length > 0").select("path", "length")
    ranges = files.select(
        "path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long"))).alias("start")
    )
    ranges = ranges.repartition(max(1, ranges.count()))
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact", "error"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.string()]
    if with_payload:
        names.append("payload")
        kinds.append(pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(path: str, rows: list[tuple[int, dict]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([path] * len(rows), pa.string()), pa.array([at for at, _ in rows], pa.int64()),
                 *(pa.array([r.get(n) for _, r in rows], k) for n, k in zip(names, kinds, strict=True))],
                names=["path", "place", *names],
            )

        for batch in batches:
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                files, name = pafs.FileSystem.from_uri(arrow_uri(path))
                with files.open_input_file(name) as f:
                    rows = []
                    for at, raw in RangeReader(f, size).records(start, min(size, start + split_bytes)):
                        record = None if raw is None else parse_record(raw)
                        if record is None:
                            error = "no readable gzip member" if raw is None else "no WARC record in the member"
                            if strict:
                                raise DamagedArchive(f"{path} at byte {at}: {error}")
                            record = {"error": error}
                        rows.append((at, record))
                        if len(rows) == 256:
                            yield batch_of(path, rows)
                            rows = []
                    yield batch_of(path, rows)

    schema = (
        "path string, place long, page_id long, url string, payload_bytes long, payload_digest string, "
        "record_type string, refers_to long, intact boolean, error string" + (", payload binary" if with_payload else "")
    )
    return ranges.mapInArrow(run, schema)


def round_trip(pages: DataFrame, min_bytes: int = 1000, split_bytes: int = SPLIT_BYTES, **columns: Column | str) -> DataFrame:
    """Write pages to new archives in the shared folder and read them back."""
    folder = shared_folder(pages.sparkSession) + "/warc"
    write_warc(pages, folder, min_bytes, **columns)
    return read_warc(pages.sparkSession, folder, split_bytes)
