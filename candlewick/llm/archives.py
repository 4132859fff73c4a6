"""ARC to WARC conversion, and WARC reading.

An ARC file starts with a version block whose first line is
``filedesc://name IP date text/plain length``; the line after it gives the version
(``1 0 origin`` or ``2 0 origin``) and the next one names the header fields. A
record is one header line with as many blank-separated fields, the declared number
of bytes, and a line feed. Version 1 has URL, IP, date, type, length; version 2 has
URL, IP, date, type, result code, checksum, location, offset, file name, length.
The parser goes by the declared lengths only, never by what content looks like.

Conversion keeps target, IP, media type and bytes, and synthesises what ARC lacks:
record id (``urn:uuid`` from a hash of file name and offset, so a rerun gives the
same id), ISO timestamp, record type and SHA-1 base32 digests. Of the responses with
equal payloads of at least ``revisit_bytes`` bytes the one with the smallest source
id stays a response, the others become revisits without a payload that name it.

Files are written (gzipped, unless asked otherwise) and read by Spark alone, in the
folder it is given. Records are raw bytes in a string column (Spark neither checks nor changes them), written by the
text source with the record end as line separator; reading takes whole files of
about ``file_bytes`` and splits them by declared length. Payloads are shuffled once,
by digest; a group of copies that is too large for one task is split by the join.

Defined results: a null or empty page has an empty payload; null URLs become ``-``
and blanks or control characters in a URL become ``%20``, as header lines are split at
blanks; repeated rows become records each (ties go to the smaller archive offset);
a null page id sorts after all others, and an empty text id counts as null; an empty table writes archives without
records, and reads back as none.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from urllib.parse import unquote_plus

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm.arrowtext import tune
from candlewick.session import checkpoint_root

FILE_BYTES = 8 << 20
LARGEST_FILE = 512 << 20         # a file is read whole, as one row
REVISIT_BYTES = 0
ARC_FIELDS = {1: 5, 2: 10}
_V1 = b"URL IP-address Archive-date Content-type Archive-length"
_V2 = (b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset "
       b"Filename Archive-length")
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH_DATE = "19700101000000"


# ------------------------------------------------------------ ARC

def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def arc_file(name: str, version: int, records) -> bytes:
    """An ARC file of (url, date, media type, payload) records."""
    body = b"%d 0 candlewick\n%s\n\n" % (version, _V1 if version == 1 else _V2)
    out = [b"filedesc://%s 0.0.0.0 %s text/plain " % (name.encode(), EPOCH_DATE.encode())]
    if version == 2:
        out.append(b"200 - - 0 %s " % name.encode())
    out.append(b"%d\n%s\n" % (len(body), body))
    at = sum(map(len, out))
    for url, date, kind, payload in records:
        head = b"%s 0.0.0.0 %s %s " % (url.encode(), date.encode(), kind.encode())
        if version == 2:
            head += b"200 %s - %d %s " % (digest(payload).encode(), at, name.encode())
        head += b"%d\n" % len(payload)
        out += [head, payload, b"\n"]
        at += len(head) + len(payload) + 1
    return b"".join(out)


def parse_arc(data: bytes):
    """(offset, version, url, ip, date, media type, result code, payload) of every
    record after the version block. Raises ValueError where lengths do not add up."""
    view, at, version = memoryview(data), 0, None
    while at < len(data):
        line_end = data.find(b"\n", at)
        if line_end < 0:
            raise ValueError(f"ARC header line without an end at {at}")
        fields = data[at:line_end].split(b" ")
        if version is None:
            start, length = line_end + 1, int(fields[-1])
            version = int(data[start:start + 1])
            if not fields[0].startswith(b"filedesc:") or version not in ARC_FIELDS:
                raise ValueError("not an ARC version block")
        else:
            if len(fields) != ARC_FIELDS[version]:
                raise ValueError(f"ARC v{version} header with {len(fields)} fields at {at}")
            start, length = line_end + 1, int(fields[-1])
            if start + length > len(data):
                raise ValueError(f"ARC record cut short at {at}")
            yield (at, version, fields[0].decode(), fields[1].decode(), fields[2].decode(),
                   fields[3].decode(), int(fields[4]) if version == 2 else None,
                   bytes(view[start:start + length]))
        at = start + length
        if data[at:at + 1] != b"\n":
            raise ValueError(f"ARC record without its line end at {at}")
        at += 1


def iso_date(arc: str) -> str:
    """ARC's YYYYMMDDhhmmss (or a prefix of it) as an ISO 8601 UTC timestamp."""
    full = arc + "00000101000000"[len(arc):]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def record_id(name: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{offset}')}>"


# ------------------------------------------------------------ WARC

def parse_warc(data: bytes):
    """(headers, payload) of every record, by Content-Length."""
    at = 0
    while at < len(data):
        stop = data.find(b"\r\n\r\n", at)
        if stop < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at {at}")
        headers = dict(h.split(": ", 1) for h in data[at:stop].decode().split("\r\n")[1:])
        start, length = stop + 4, int(headers["Content-Length"])
        if start + length + 4 > len(data):
            raise ValueError(f"WARC record cut short at {at}")
        yield headers, data[start:start + length]
        at = start + length
        if data[at:at + 4] != b"\r\n\r\n":
            raise ValueError(f"WARC record without its end at {at}")
        at += 4


def _quoted(value):
    """A value as one word without blanks, line ends or ``#``."""
    return F.url_encode(value.cast("string"))


def arc_archives(pages: DataFrame, file_bytes: int = FILE_BYTES) -> DataFrame:
    """(name, data): ARC files of a page table, of both versions, one file a row.
    The page id is appended to the URL after a ``#``, as ARC has no field for it; like
    a form field, so that an id of any text stays one word (a whole number is as it is)."""
    rows = pages.select(
        F.coalesce(_quoted(F.col("page_id")), F.lit("")).alias("id"),
        F.regexp_replace(F.coalesce("url", F.lit("-")), r"[\x00-\x20]", "%20").alias("url"),
        F.coalesce("html", F.lit("")).cast("binary").alias("html"))

    def as_row(part, k, held):
        name = f"pages-{part:06d}-{k:04d}.arc"
        return pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([arc_file(name, 1 + (part + k) % 2, held)], pa.binary())],
            ["name", "data"])

    def run(batches):
        part = TaskContext.get().partitionId()
        held, size, k = [], 0, 0
        for b in batches:
            for i, u, h in zip(*(c.to_pylist() for c in b.columns)):
                held.append((f"{u}#{i}", EPOCH_DATE, "text/html", h))
                size += len(h)
                if size >= file_bytes:
                    yield as_row(part, k, held)
                    held, size, k = [], 0, k + 1
        yield as_row(part, k, held)

    return rows.mapInArrow(run, "name string, data binary")


_RECORD = ("name string, offset long, url string, ip string, date string, kind string, "
           "payload binary, digest string, id string")


def convert(archives: DataFrame) -> DataFrame:
    """WARC records of ARC files (name, data): target, IP, ISO date, media type,
    payload, digest and a synthesised id."""
    names = [x.split()[0] for x in _RECORD.split(", ")]

    def run(batches):
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                rows = [(name, at, url, ip, iso_date(date), kind, payload, digest(payload),
                         record_id(name, at))
                        for at, _, url, ip, date, kind, _, payload in parse_arc(data)]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.binary() if n == "payload" else
                                  pa.int64() if n == "offset" else pa.string())
                         for c, n in zip(zip(*rows), names)], names)

    return archives.select("name", "data").mapInArrow(run, _RECORD)


def with_revisits(records: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Adds size, refers_to (id of the response with the same payload, null for a
    response) and refers_source. ``source`` is the order column of the records."""
    rows = records.withColumn("size", F.length("payload").cast("long"))
    rank = F.struct(F.col("source").isNull().alias("last"), "source", "name", "offset", "id")
    first = rows.where(F.col("size") >= revisit_bytes).groupBy("digest", "size") \
        .agg(F.min(rank).alias("first"))
    return rows.join(first, ["digest", "size"], "left") \
        .withColumn("refers_to", F.when(F.col("first.id") != F.col("id"), F.col("first.id"))) \
        .withColumn("refers_source", F.when(F.col("refers_to").isNotNull(), F.col("first.source"))) \
        .drop("first")


def warc_text(records: DataFrame) -> DataFrame:
    """One string column: each record's bytes up to, not including, its end."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    revisit = F.col("refers_to").isNotNull()
    body = F.when(revisit, F.lit("").cast("binary")).otherwise(F.col("payload"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", F.col("id")), line("WARC-Date", F.col("date")),
        line("WARC-Target-URI", F.col("url")), line("WARC-IP-Address", F.col("ip")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("WARC-Source-Payload-Length", F.col("size").cast("string")),
        line("WARC-Source-Id", F.coalesce(_quoted(F.col("source")), F.lit(""))),
        F.when(revisit, F.concat(line("WARC-Refers-To", F.col("refers_to")),
                                 line("WARC-Refers-To-Source", F.coalesce(_quoted(F.col("refers_source")), F.lit(""))),
                                 F.lit(f"WARC-Profile: {_REVISIT}\r\n"))).otherwise(F.lit("")),
        line("Content-Type", F.col("kind")), line("Content-Length", F.length(body).cast("string")),
        F.lit("\r\n"))
    return records.select(F.concat(head.cast("binary"), body).cast("string").alias("record"))


def write_warc(records: DataFrame, path: str, records_per_file: int, codec: str = "gzip") -> None:
    """Write records (see ``with_revisits``) as WARC files below ``path``."""
    warc_text(records).write.mode("overwrite").option("lineSep", "\r\n\r\n") \
        .option("maxRecordsPerFile", records_per_file).option("compression", codec).text(path)


def plain(data: bytes) -> bytes:
    """The bytes of a file that may be gzipped, in one member or in several."""
    return gzip.decompress(data) if data.startswith(b"\x1f\x8b") else data


_READ = ("type string, id string, url string, date string, digest string, source string, "
         "refers_to string, refers_source string, size long, payload binary")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of the WARC files below ``path``; a response's digest is checked."""
    names = [x.split()[0] for x in _READ.split(", ")]
    types = {"size": pa.int64(), "payload": pa.binary()}

    def run(batches):
        for b in batches:
            for data in b.column(0).to_pylist():
                rows = []
                for h, payload in parse_warc(plain(data)):
                    own = h["WARC-Payload-Digest"].removeprefix("sha1:")
                    if h["WARC-Type"] == "response" and digest(payload) != own:
                        raise ValueError(f"digest of {h['WARC-Record-ID']} does not fit its payload")
                    rows.append((h["WARC-Type"], h["WARC-Record-ID"], h["WARC-Target-URI"], h["WARC-Date"],
                                 own, unquote_plus(h.get("WARC-Source-Id", "")) or None, h.get("WARC-Refers-To"),
                                 unquote_plus(h.get("WARC-Refers-To-Source", "")) or None,
                                 int(h["WARC-Source-Payload-Length"]), payload))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, types.get(n, pa.string())) for c, n in zip(zip(*rows), names)], names)

    files = spark.read.format("binaryFile").load(path).where("length > 0").select("content")
    return files.mapInArrow(run, _READ)


def archive_pages(pages: DataFrame, path: str, file_bytes: int = FILE_BYTES,
                  revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Pages as legacy archives, converted, written to a new folder below ``path``
    and read back."""
    spark = pages.sparkSession
    tune(spark)
    root = f"{path.rstrip('/')}/{uuid.uuid4().hex}"
    size = pages.agg(F.count("*").alias("n"), F.sum(F.octet_length("html")).alias("b"),
                     F.max(F.octet_length("html")).alias("top")).first()
    # file_bytes on average, and no run of the largest pages beyond LARGEST_FILE
    per_file = max(1, min(int(size["n"] * file_bytes / max(1, (size["b"] or 0) + 500 * size["n"])),
                          LARGEST_FILE // ((size["top"] or 0) + 1000)))
    arc_archives(pages, file_bytes).write.option("compression", "zstd").parquet(f"{root}/arc")
    own = F.regexp_extract("url", r"#([^#]*)$", 1)
    records = convert(spark.read.parquet(f"{root}/arc")) \
        .withColumn("source", F.when(own != "", F.url_decode(own)).cast(pages.schema["page_id"].dataType)) \
        .withColumn("url", F.regexp_replace("url", r"#[^#]*$", ""))
    write_warc(with_revisits(records, revisit_bytes), f"{root}/warc", per_file)
    return read_warc(spark, f"{root}/warc")


def shared_folder(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/archives"
