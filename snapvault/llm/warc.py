"""ARC archives, their conversion to WARC, and reading WARC back.

ARC files start with a version block that names the fields of the header
lines (version 1 has five, version 2 ten); a record is a header line, as many
bytes as the line declares and a line feed.  The converter reads each file by
its own version block and makes equivalent WARC records: identifiers that
carry the page id, ISO timestamps, record types and SHA-1 digests of block and
payload.  Of records with equal payloads the one with the largest page id is
the response, the others become revisits that refer to it and keep their HTTP
header only.

Spark's text writer writes the archives, with the format's record separator as
line separator (the bytes pass unchanged), gzip-compressed, a bounded number
of records a file; its binaryFile reader reads them.  Payloads are shuffled
once and compressed; who owns a payload is decided on digests.

Cases: null html is an empty payload, a null url is ``-``, a null page id is
carried as null and owns a payload only if no other does (its group's records
are then all responses); rows that repeat the owner's id are responses too;
other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapvault.llm.common import arrow_limits, stored, utf8

FILE_BYTES = 16 << 20
#: Fixed values of the formats.
V1 = ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length")
V2 = ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset",
      "Filename", "Archive-length")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PARSED = "path string, ordinal int, page_id long, payload_bytes long, payload_digest string"
RESULT = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
          "record_id string, warc_date string, target_uri string, digest_ok boolean")


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def version_block(version: int, date: str) -> bytes:
    """The first record of an ARC file."""
    names = V1 if version == 1 else V2
    body = f"{version} 0 snapvault\n{' '.join(names)}\n".encode()
    middle = ["0.0.0.0", date, "text/plain"] + ([] if version == 1 else ["200", "-", "-", "0", "-"])
    return f"filedesc://pages.arc {' '.join(middle)} {len(body)}\n".encode() + body


def arc_record(version: int, page_id, url, date: str, html: bytes) -> bytes:
    """Header line and block; the block is an HTTP response."""
    head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    head += f"Content-Length: {len(html)}\r\n" + ("" if page_id is None else f"X-Page-Id: {page_id}\r\n") + "\r\n"
    block = head.encode() + html
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "-"
    middle = ["0.0.0.0", date, "text/html"] + ([] if version == 1 else ["200", "-", "-", "0", "-"])
    return f"{uri} {' '.join(middle)} {len(block)}\n".encode() + block


def parse_arc(data: bytes):
    """(header fields by name, block) of every record; the version block first."""
    at, names = 0, None
    while at < len(data):
        end = data.index(b"\n", at)
        values = data[at:end].decode("utf-8", "replace").split(" ")
        if names is None:
            length = int(values[-1])
            block = data[end + 1:end + 1 + length]
            lines = block.decode("utf-8", "replace").split("\n")
            if lines[0].split(" ")[0] not in ("1", "2"):
                raise ValueError(f"ARC version {lines[0]!r}")
            names = lines[1].split(" ")
            yield {"URL": values[0], "Archive-date": values[2], "Content-type": "text/plain", "Version": lines[0]}, block
        else:
            # the url comes first and the other fields hold no space: count from the right
            tail = values[len(values) - len(names) + 1:]
            fields = dict(zip(names, [" ".join(values[:len(values) - len(names) + 1]), *tail]))
            length = int(fields["Archive-length"])
            block = data[end + 1:end + 1 + length]
            if len(block) != length:
                raise ValueError("an ARC record ends before its declared length")
            yield fields, block
        at = end + 1 + length + 1


def http_parts(block: bytes) -> tuple[bytes, dict, bytes]:
    """(header bytes with the empty line, header fields in lower case, payload) of an HTTP response block."""
    if not block.startswith(b"HTTP/"):
        return b"", {}, block
    end = block.find(b"\r\n\r\n")
    if end < 0:
        return block, {}, b""
    lines = block[:end].decode("utf-8", "replace").split("\r\n")[1:]
    return block[:end + 4], {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, block[end + 4:]


def record_id(page_id, digest: str, uri: str) -> str:
    """A version 8 UUID of the 64-bit page id and 58 bits of the digest; a name-based one without a page id."""
    if page_id is None:
        return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{uri} {digest}')}"
    i = page_id & (2**64 - 1)
    some = int.from_bytes(base64.b32decode(digest)[:8], "big") >> 6
    n = (i >> 16) << 80 | 8 << 76 | ((i >> 4) & 0xFFF) << 64 | 2 << 62 | (i & 15) << 58 | some
    return f"urn:uuid:{uuid.UUID(int=n)}"


def page_of(identifier: str):
    """The page id in a record identifier, or none."""
    u = uuid.UUID(identifier.strip("<>").removeprefix("urn:uuid:"))
    if u.version != 8:
        return None
    n = u.int
    i = (n >> 80) << 16 | ((n >> 64) & 0xFFF) << 4 | (n >> 58) & 15
    return i - 2**64 if i >= 2**63 else i


def iso_date(arc_date: str) -> str:
    """YYYYMMDD[hhmmss] as an ISO timestamp; what is missing counts as the earliest."""
    d = (re.sub(r"\D", "", arc_date) + "00000101000000"[len(re.sub(r"\D", "", arc_date)):])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(fields: dict, block: bytes, owner) -> bytes:
    """The WARC record of an ARC record, without the separator behind it. ``owner``: page id that a revisit refers to."""
    date = iso_date(fields["Archive-date"])
    if fields.get("Version"):
        name = fields["URL"].removeprefix("filedesc://")
        info = f"software: snapvault ARC converter\r\nformat: WARC File Format 1.1\r\nisPartOf: {name}\r\n".encode()
        head = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<{record_id(None, sha1_base32(block), name)}>"),
                ("WARC-Date", date), ("Content-Type", "application/warc-fields")]
        block = info
    else:
        http, names, payload = http_parts(block)
        page = names.get("x-page-id")
        page = int(page) if page is not None else None
        digest, uri = sha1_base32(payload), fields["URL"]
        kind = "revisit" if owner is not None else "response" if http else "resource"
        head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id(page, digest, uri)}>"), ("WARC-Date", date),
                ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{digest}")]
        if fields.get("IP-address", "0.0.0.0") != "0.0.0.0":
            head.append(("WARC-IP-Address", fields["IP-address"]))
        if owner is not None:
            head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{record_id(owner, digest, uri)}>")]
            block = http
        head.append(("Content-Type", "application/http; msgtype=response" if http else fields["Content-type"]))
    head += [("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"), ("Content-Length", str(len(block)))]
    return "\r\n".join(["WARC/1.1", *(f"{k}: {v}" for k, v in head), "", ""]).encode() + block


def parse_warc(data: bytes):
    """(header fields in lower case, block) of every record."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        n = int(fields["content-length"])
        yield fields, data[end + 4:end + 4 + n]
        at = end + 4 + n + 4


def _plain(content: bytes) -> bytes:
    return gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content


def write_arc(pages: DataFrame, path: str, date: str = "20240101000000", file_bytes: int = FILE_BYTES) -> int:
    """ARC files of ``pages`` (page_id, url, html); tasks write version 1 and 2 in turn. Gives the records a file."""
    arrow_limits(pages.sparkSession)
    size = pages.agg(F.count("*"), F.sum(F.octet_length("html"))).first()
    most = max(2, min(100_000, int(file_bytes / max(1.0, (size[1] or 0) / max(1, size[0])))))

    def run(batches):
        version, n = 1 + TaskContext.get().partitionId() % 2, 0
        for b in batches:
            out = []
            for page, url, html in zip(*(b.column(k).to_pylist() for k in ("page_id", "url", "html"))):
                if n % most == 0:  # a file's first record; the writer begins a file every ``most`` rows
                    out.append(version_block(version, date))
                    n += 1
                out.append(arc_record(version, page, url, date, html))
                n += 1
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), utf8("html").alias("html"))
    (rows.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
     .write.option("lineSep", "\n").option("compression", "gzip").option("maxRecordsPerFile", most).text(path))
    return most


def _archives(spark: SparkSession, path: str) -> DataFrame:
    arrow_limits(spark)
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def _parse(batches):
    for b in batches:
        for path, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
            rows = []
            for k, (fields, block) in enumerate(parse_arc(_plain(content))):
                if not fields.get("Version"):
                    _, names, payload = http_parts(block)
                    page = names.get("x-page-id")
                    rows.append((path, k, None if page is None else int(page), len(payload), sha1_base32(payload)))
            cols = list(zip(*rows)) if rows else [[]] * 5
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=[x.split()[0] for x in PARSED.split(", ")])


def _convert(batches):
    for b in batches:
        cols = (b.column(k).to_pylist() for k in ("content", "ordinals", "owners"))
        for content, ordinals, owners in zip(*cols):
            owner = dict(zip(ordinals or [], owners or []))
            out, size = [], 0
            for k, (fields, block) in enumerate(parse_arc(_plain(content))):
                out.append(warc_record(fields, block, owner.get(k)))
                size += len(out[-1])
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])


def arc_to_warc(spark: SparkSession, arc_path: str, warc_path: str, records_per_file: int, min_bytes: int = 0) -> None:
    """Convert every ARC file below ``arc_path``; payloads of at least ``min_bytes`` get revisits."""
    records = stored(_archives(spark, arc_path).mapInArrow(_parse, PARSED), "arc-records")
    owners = (records.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest", "payload_bytes")
              .agg(F.max("page_id").alias("owner")))
    revisits = (records.join(owners, ["payload_digest", "payload_bytes"])
                .where("owner is not null and not (page_id <=> owner)")
                # a file's revisits: no more than its records
                .groupBy("path").agg(F.collect_list("ordinal").alias("ordinals"), F.collect_list("owner").alias("owners")))
    (_archives(spark, arc_path).join(revisits.withColumnRenamed("path", "r_path"), F.col("path") == F.col("r_path"), "left")
     .select("content", "ordinals", "owners").mapInArrow(_convert, "value binary").select(F.col("value").cast("string"))
     .write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", records_per_file)
     .text(warc_path))


def _read(batches):
    for b in batches:
        for content in b.column("content").to_pylist():
            rows = []
            for fields, block in parse_warc(_plain(content)):
                kind = fields["warc-type"]
                if kind == "warcinfo":
                    continue
                _, names, payload = http_parts(block)
                digest = fields["warc-payload-digest"].removeprefix("sha1:")
                ok = fields["warc-block-digest"] == f"sha1:{sha1_base32(block)}" and (
                    kind == "revisit" or digest == sha1_base32(payload))
                refers = page_of(fields["warc-refers-to"]) if kind == "revisit" else None
                n = int(names.get("content-length", 0)) if kind == "revisit" else len(payload)
                rows.append((page_of(fields["warc-record-id"]), n, digest, kind, refers, fields["warc-record-id"],
                             fields["warc-date"], fields["warc-target-uri"], ok))
            cols = list(zip(*rows)) if rows else [[]] * 9
            kinds = [pa.int64(), pa.int64(), *[pa.string()] * 2, pa.int64(), *[pa.string()] * 3, pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=[x.split()[0] for x in RESULT.split(", ")])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record that is no warcinfo: what its headers and block say."""
    return _archives(spark, path).mapInArrow(_read, RESULT)
