"""Legacy ARC archives and their conversion to WARC.

``write_arc`` lays pages down as ARC files, version 1 or 2. ``convert_arc``
parses the version block, the header lines of that version and the declared
lengths, and writes equivalent WARC records: identifiers and dates are
synthesised from the ARC header, digests from the payload, and the type is
``response``, or ``revisit`` if an earlier page has the same payload.
``read_warc`` reads WARC files back, one row per record.

Archives are gzip files, a member per record, rolled at ``ROLL_BYTES``. Tasks
write them below ``spark.checkpoint.dir`` under names of their own, and a table
lists those of the tasks that succeeded, so a task that is repeated leaves no
record twice.

Defined cases: a null html is an empty payload; a null url becomes
``urn:page:<page_id>``; white space in a url is percent-encoded; of repeated rows
with one page_id and payload one is the response and the others revisit it; a
null page_id is kept and comes after all others; empty tables give empty ones.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from railpulse.llm.common import small_batches, stored
from railpulse.session import scratch_path

ROLL_BYTES = 8 << 20
LEVEL = 2
ARCHIVE_DATE = "20240101000000"
HOST = "0.0.0.0"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed: the URL namespace

# The header fields of the two versions of the ARC format.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}


class BadArchive(ValueError):
    """An archive does not follow its format."""


# -- files ------------------------------------------------------------------


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path:
        return fs.LocalFileSystem(), path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


class Roller:
    """Writes records into gzip files of bounded size below one folder."""

    def __init__(self, folder: str, ending: str):
        self.folder, self.ending, self.out, self.files = folder, ending, None, []
        self.system, self.path = _file_system(folder)
        self.system.create_dir(self.path, recursive=True)

    def write(self, record: bytes, opening=None) -> None:
        if self.out is None:
            name = f"{uuid.uuid4().hex}.{self.ending}"
            self.out = self.system.open_output_stream(f"{self.path}/{name}", compression=None)
            self.files.append([f"{self.folder}/{name}", 0])
            if opening is not None:
                self.out.write(_member(opening(name)))
        self.out.write(_member(record))
        self.files[-1][1] += 1
        if self.out.tell() >= ROLL_BYTES:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def _member(record: bytes) -> bytes:
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return pack.compress(record) + pack.flush()


def _open(path: str):
    system, name = _file_system(path)
    return io.BufferedReader(gzip.GzipFile(fileobj=system.open_input_file(name)), 1 << 20)


# -- the ARC format -----------------------------------------------------------


def http_response(page_id, html: str | None) -> tuple[bytes, bytes]:
    payload = (html or "").encode("utf-8", "surrogatepass")
    name = "" if page_id is None else page_id
    head = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\nX-Page-Id: {name}\r\n\r\n"
    )
    return head.encode(), payload


def arc_opening(version: int, name: str) -> bytes:
    block = f"{version} 0 pages\n{FIELDS[version]}\n".encode()
    extra = " 200 - - 0 " + name if version == 2 else ""
    return f"filedesc://{name} {HOST} {ARCHIVE_DATE} text/plain{extra} {len(block)}\n".encode() + block + b"\n"


def arc_record(version: int, url: str, content: bytes, checksum: str, name: str = "-") -> bytes:
    extra = f" 200 {checksum} - 0 {name}" if version == 2 else ""
    head = f"{url} {HOST} {ARCHIVE_DATE} text/html{extra} {len(content)}\n"
    return head.encode() + content + b"\n"


def arc_url(page_id, url: str | None) -> str:
    if not url:
        return f"urn:page:{'' if page_id is None else page_id}"
    return re.sub(r"[\s\x00-\x1f\x7f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)


def parse_arc(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and content of every record after the version block."""
    opening = stream.readline().decode().rstrip("\r\n").split(" ")
    if not opening[0].startswith("filedesc://"):
        raise BadArchive("an ARC file begins with a filedesc line")
    block = _exactly(stream, int(opening[-1])).decode().splitlines()
    version = int(block[0].split(" ")[0])
    if version not in FIELDS:
        raise BadArchive(f"ARC version {version} is not known")
    names = FIELDS[version].split(" ")
    if block[1].split(" ") != names:
        raise BadArchive("the field line does not fit the version")
    while line := stream.readline():
        text = line.decode().rstrip("\r\n")
        if not text:
            continue  # the newline after a record
        values = text.split(" ")
        if len(values) != len(names):
            raise BadArchive(f"{len(values)} header fields where version {version} has {len(names)}")
        header = dict(zip(names, values))
        yield header, _exactly(stream, int(header["Archive-length"]))


def _exactly(stream, length: int) -> bytes:
    found = stream.read(length)
    if len(found) != length:
        raise BadArchive("a record is shorter than it declares")
    return found


# -- the WARC format ----------------------------------------------------------


@dataclass
class Warc:
    kind: str
    headers: dict[str, str] = field(default_factory=dict)
    block: bytes = b""

    def to_bytes(self) -> bytes:
        lines = ["WARC/1.1", f"WARC-Type: {self.kind}"]
        lines += [f"{k}: {v}" for k, v in self.headers.items()]
        lines.append(f"Content-Length: {len(self.block)}")
        return "\r\n".join(lines).encode() + b"\r\n\r\n" + self.block + b"\r\n\r\n"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def split_http(content: bytes) -> tuple[bytes, bytes]:
    """HTTP head and payload of a record; content without a head is all payload."""
    if not content.startswith(b"HTTP/"):
        return b"", content
    end = content.find(b"\r\n\r\n")
    return (content, b"") if end < 0 else (content[:end + 4], content[end + 4:])


def record_id(url: str, date: str, page: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{date} {page} {url}')}>"


def iso_date(date: str) -> str:
    d = date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def to_warc(header: dict[str, str], content: bytes, original: dict | None = None) -> Warc:
    """The equivalent of an ARC record; ``original`` describes the response it revisits."""
    head, payload = split_http(content)
    url, date = header["URL"], header["Archive-date"]
    fields = {
        "WARC-Record-ID": record_id(url, date, http_field(head, "X-Page-Id")),
        "WARC-Date": iso_date(date),
        "WARC-Target-URI": url,
        "WARC-IP-Address": header["IP-address"],
        "Content-Type": "application/http;msgtype=response" if head else header["Content-type"],
        "WARC-Payload-Digest": f"sha1:{base32_sha1(payload)}",
    }
    if original is None:
        fields["WARC-Block-Digest"] = f"sha1:{base32_sha1(content)}"
        return Warc("response", fields, content)
    fields |= {
        # Fixed value: the profile of revisits by equal payload.
        "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        "WARC-Refers-To": original["record_id"],
        "WARC-Refers-To-Target-URI": original["url"],
        "WARC-Refers-To-Date": iso_date(original["date"]),
        "WARC-Block-Digest": f"sha1:{base32_sha1(head)}",
        "X-Refers-To-Page-Id": "" if original["page_id"] is None else str(original["page_id"]),
    }
    return Warc("revisit", fields, head)


def parse_warc(stream) -> Iterator[Warc]:
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise BadArchive("a WARC record begins with its version")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(":")
            headers[name] = value.strip()
        block = _exactly(stream, int(headers.pop("Content-Length")))
        yield Warc(headers.pop("WARC-Type"), headers, block)


def http_field(head: bytes, name: str) -> str:
    found = re.search(rb"(?im)^" + name.encode() + rb":[ \t]*([^\r\n]*)", head)
    return found[1].decode().strip() if found else ""


# -- Spark --------------------------------------------------------------------


def write_arc(pages: DataFrame, version: int = 1) -> DataFrame:
    """Pages (page_id, url, html) as ARC files; a table of (path, records)."""
    spark = pages.sparkSession
    small_batches(spark)
    folder = scratch_path(spark, "arc")

    def run(batches):
        roller = Roller(folder, "arc.gz")
        for batch in batches:
            for page, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                head, payload = http_response(page, html)
                record = arc_record(version, arc_url(page, url), head + payload, base32_sha1(payload))
                roller.write(record, lambda name: arc_opening(version, name))
        roller.close()
        yield _listing(roller.files)

    listed = pages.select("page_id", "url", "html").mapInArrow(run, "path string, records long")
    return stored(listed, "arc-files")


def _listing(files: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([f[0] for f in files], pa.string()), pa.array([f[1] for f in files], pa.int64())],
        ["path", "records"],
    )


def _page_number(head: bytes) -> int | None:
    found = http_field(head, "X-Page-Id")
    return int(found) if found else None


def arc_records(arcs: DataFrame) -> DataFrame:
    """A row per ARC record: where it is, its page, its synthesised identity and its payload's digest."""
    schema = "path string, ordinal long, page_id long, record_id string, url string, date string, bytes long, digest string"

    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows = []
                with _open(path) as stream:
                    for ordinal, (header, content) in enumerate(parse_arc(stream)):
                        head, payload = split_http(content)
                        url, date = header["URL"], header["Archive-date"]
                        rows.append((
                            path, ordinal, _page_number(head),
                            record_id(url, date, http_field(head, "X-Page-Id")), url, date,
                            len(payload), base32_sha1(payload),
                        ))
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                    ["path", "ordinal", "page_id", "record_id", "url", "date", "bytes", "digest"],
                )

    return _spread(arcs).mapInArrow(run, schema)


def _spread(files: DataFrame) -> DataFrame:
    """File names over as many tasks as a stage has by default."""
    spark = files.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return files.repartition(parts)


def convert_arc(arcs: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """ARC files (path, ...) as WARC files; a table of (path, records).

    Of records with equal payloads of at least ``min_revisit_bytes`` the one
    with the smallest page is the response and the others revisit it. The first
    of every payload is found by an aggregation that combines before it
    shuffles; payloads themselves are not moved between tasks.
    """
    spark = arcs.sparkSession
    small_batches(spark)
    records = stored(arc_records(arcs), "arc-records")
    order = F.struct(
        F.col("page_id").isNull().alias("unnamed"), "page_id", "path", "ordinal", "record_id", "url", "date"
    )
    firsts = records.groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("copies")).where(
        "copies > 1"
    )
    revisits = (
        records.where(F.col("bytes") >= min_revisit_bytes).join(firsts, "digest")
        .where((F.col("path") != F.col("first.path")) | (F.col("ordinal") != F.col("first.ordinal")))
        .groupBy("path").agg(F.collect_list(F.struct(
            "ordinal", F.col("first.page_id"), F.col("first.record_id"), F.col("first.url"), F.col("first.date"),
        )).alias("revisits"))
    )
    work = arcs.select("path").join(revisits, "path", "left")
    folder = scratch_path(spark, "warc")

    def run(batches):
        roller = Roller(folder, "warc.gz")
        for batch in batches:
            for path, revisits in zip(batch.column("path").to_pylist(), batch.column("revisits")):
                originals = {r["ordinal"]: r for r in revisits.as_py() or []}
                with _open(path) as stream:
                    for ordinal, (header, content) in enumerate(parse_arc(stream)):
                        roller.write(to_warc(header, content, originals.get(ordinal)).to_bytes())
        roller.close()
        yield _listing(roller.files)

    return stored(_spread(work).mapInArrow(run, "path string, records long"), "warc-files")


def read_warc(warcs: DataFrame) -> DataFrame:
    """A row per WARC record, its payload checked against its digest."""
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"

    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows = []
                with _open(path) as stream:
                    for record in parse_warc(stream):
                        head, payload = split_http(record.block)
                        digest = record.headers["WARC-Payload-Digest"].removeprefix("sha1:")
                        if record.kind == "response" and base32_sha1(payload) != digest:
                            raise BadArchive("a payload does not fit its digest")
                        refers = record.headers.get("X-Refers-To-Page-Id")
                        rows.append((
                            _page_number(head), int(http_field(head, "Content-Length")), digest,
                            record.kind, int(refers) if refers else None,
                        ))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                    ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
                )

    return _spread(warcs).mapInArrow(run, schema)


def archived(pages: DataFrame, version: int = 1, min_revisit_bytes: int = 0) -> DataFrame:
    """Pages written as ARC, converted to WARC, and read back."""
    return read_warc(convert_arc(write_arc(pages, version), min_revisit_bytes))
