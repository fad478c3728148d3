r"""Legacy archive converter: ARC files of versions 1 and 2 to WARC, and back to rows.

An ARC file starts with a version block that names the fields of its header lines; every record
is one header line in those fields, then as many bytes as its last field declares. Parsing goes
by the declared lengths alone, whatever the content looks like. Each record gets a WARC id (a
name-based UUID of its URI, date and digest), a date in W3C form, the digest of its payload and a
type: of records with equal payloads of at least REVISIT_BYTES bytes the one with the largest key
is the response and the rest are revisits that refer to it by URI and date.

Files are written by Spark's text writer, one row for each file of about CHUNK_BYTES, since that
writes the bytes as they are, and read by its binary reader; only paths that Spark can open are used.
Equal payloads are found by digest and length; the payload is never grouped.

Null html is an empty payload. A null page_id is read back as null and can't be referred to; rows
with the same id and payload as a response are responses too. White space in urls is escaped, a
null url is empty. Empty tables give no files and no rows. Only the named columns are used.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterable, Iterator
from datetime import datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetflow.llm.tables import map_arrow, query, table
from streetflow.session import scratch

CHUNK_BYTES = 8 << 20
REVISIT_BYTES = 1000
#: Header fields of the two versions, as the format defines them.
FIELDS = {1: b"URL IP-address Archive-date Content-type Archive-length",
          2: b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

FILE = pa.schema([("content", pa.binary())])
RECORD = pa.schema([("uri", pa.string()), ("ip", pa.string()), ("date", pa.string()), ("kind", pa.string()),
                    ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("digest", pa.string())])
DESCRIBED = pa.schema([f for f in RECORD if f.name != "payload"])
WARC = pa.schema([("warc_type", pa.string()), ("record_id", pa.string()), ("uri", pa.string()), ("date", pa.string()),
                  ("payload_bytes", pa.int64()), ("digest", pa.string()), ("refers_to_uri", pa.string()), ("block", pa.binary())])


def arc_block(version: int, name: str) -> bytes:
    body = b"%d 0 converted\n%s\n\n" % (version, FIELDS[version])
    fields = [f"filedesc://{name}", "0.0.0.0", "20200101000000", "text/plain"]
    return _arc_line(version, fields, body) + body


def _arc_line(version: int, fields: list[str], payload: bytes) -> bytes:
    more = [] if version == 1 else ["200", "-", "-", "0", "-"]
    return " ".join([*fields, *more, str(len(payload))]).encode() + b"\n"


def arc_record(version: int, uri: str, ip: str, date: str, kind: str, payload: bytes) -> bytes:
    return _arc_line(version, [uri, ip, date, kind], payload) + payload + b"\n"


def parse_arc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, payload) of every record behind the version block of an ARC file."""
    at, names = 0, None
    while at < len(data):
        if data[at: at + 1] in b"\r\n":  # records are set apart by line ends
            at += 1
            continue
        stop = data.index(b"\n", at)
        parts = data[at:stop].decode("utf-8", "replace").rstrip("\r").split(" ")
        length = int(parts[-1])
        payload = data[stop + 1: stop + 1 + length]
        if len(payload) < length:
            raise ValueError("a record ends before its declared length")
        at = stop + 1 + length
        if names is None:
            version, named = payload.split(b"\n")[:2]
            if not parts[0].startswith("filedesc:") or named != FIELDS.get(int(version.split()[0])):
                raise ValueError("not an ARC version block")
            names = named.decode().split(" ")
        elif len(parts) != len(names):
            raise ValueError("a header line does not fit the version block")
        else:
            yield dict(zip(names, parts)), payload


def warc_record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return b"WARC/1.1\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:stop].decode().split("\r\n")
        if version != "WARC/1.1":
            raise ValueError("not a WARC record")
        headers = dict(line.split(": ", 1) for line in lines)
        end = stop + 4 + int(headers["Content-Length"])
        if data[end: end + 4] != b"\r\n\r\n":
            raise ValueError("a record does not end at its declared length")
        yield headers, data[stop + 4: end]
        at = end + 4


def _files(pieces: Iterable, head, build, ending: bytes) -> Iterator[pa.RecordBatch]:
    """One row for each file: head(number), then build(number, piece) of pieces up to about CHUNK_BYTES.

    The last ending is left out, since the writer adds it.
    """
    held, size, number = [], 0, 0

    def row():
        return pa.RecordBatch.from_arrays([pa.array([b"".join(held).removesuffix(ending)], pa.binary())], schema=FILE)

    for piece in pieces:
        if not held:
            held, size = [head(number)], 0
        held.append(build(number, piece))
        size += len(held[-1])
        if size >= CHUNK_BYTES:
            yield row()
            held, number = [], number + 1
    if held:
        yield row()


def _rows(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    for b in batches:
        for values in zip(*(b.column(n) for n in names)):
            yield tuple(v.as_py() for v in values)


def _write(files: DataFrame, path: str, ending: str) -> None:
    (files.select(F.col("content").cast("string").alias("value")).write.option("maxRecordsPerFile", 1)
     .option("lineSep", ending).option("compression", "gzip").text(path))


def _read(spark: SparkSession, path: str, work, schema: pa.Schema) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return map_arrow(files.select("content"), work, schema)


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
    for (content,) in _rows(batches, ["content"]):
        yield gzip.decompress(content)


def _batched(rows: Iterable[tuple], schema: pa.Schema, payload: int | None = None) -> Iterator[pa.RecordBatch]:
    """Rows in batches of a few million bytes of payload."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[payload]) if payload is not None else 100
        if size >= 1 << 22:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def write_arc(records: DataFrame, path: str) -> None:
    """Write records(uri, ip, date, kind, payload) as ARC files, in turn of version 1 and 2."""
    names = ["uri", "ip", "date", "kind", "payload"]

    def work(batches):
        yield from _files(_rows(batches, names), lambda k: arc_block(1 + k % 2, f"part-{k}.arc"),
                          lambda k, r: arc_record(1 + k % 2, *r[:4], r[4] or b""), b"\n")

    _write(map_arrow(records.select(*names), work, FILE), path, "\n")


def read_arc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of all ARC files of a folder, with length and SHA-1 digest of each payload."""
    schema = RECORD if payloads else DESCRIBED

    def rows(batches):
        for data in _opened(batches):
            for fields, payload in parse_arc(data):
                said = (fields["URL"], fields["IP-address"], fields["Archive-date"], fields["Content-type"])
                own = (payload,) if payloads else ()
                yield (*said, *own, len(payload), hashlib.sha1(payload).hexdigest())

    return _read(spark, path, lambda batches: _batched(rows(batches), schema, 4 if payloads else None), schema)


def warc_date(date: str) -> str:
    return datetime.strptime(date[:14].ljust(14, "0"), "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")


def record_id(uri: str, date: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{uri} {date} {digest}')}>"


def _warc_of(row: tuple) -> bytes:
    uri, ip, date, kind, payload, size, digest, first_uri, first_date = row
    headers = [("WARC-Record-ID", record_id(uri, date, digest)), ("WARC-Target-URI", uri), ("WARC-Date", warc_date(date)),
               ("WARC-IP-Address", ip), ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
               ("X-Payload-Length", str(size))]
    if first_uri is None or (first_uri, first_date) == (uri, date):
        return warc_record("response", [*headers, ("Content-Type", kind)], payload)
    more = [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", record_id(first_uri, first_date, digest)), ("WARC-Refers-To-Target-URI", first_uri),
            ("WARC-Refers-To-Date", warc_date(first_date))]
    return warc_record("revisit", [*headers, *more], b"")


def convert(spark: SparkSession, arc_path: str, warc_path: str, key, least: int = REVISIT_BYTES) -> None:
    """Convert a folder of ARC files to WARC files. key: column of uri whose largest value marks the response among copies."""
    long = read_arc(spark, arc_path, payloads=False).where(F.col("payload_bytes") >= least).withColumn("_key", key)
    copies = (long.groupBy("digest", "payload_bytes").agg(F.count("*").alias("_n"), F.max(F.when(
        F.col("_key").isNotNull(), F.struct("_key", "uri", "date"))).alias("_first")).where("_n > 1 and _first is not null")
        .select("digest", "payload_bytes", F.col("_first._key").alias("_first_key"), F.col("_first.uri").alias("first_uri"),
                F.col("_first.date").alias("first_date")))
    # rows that share the response's key are responses too
    other = ~F.col("_first_key").eqNullSafe(key)
    rows = (read_arc(spark, arc_path).join(copies, ["digest", "payload_bytes"], "left")
            .withColumn("first_uri", F.when(other, F.col("first_uri"))).withColumn("first_date", F.when(other, F.col("first_date")))
            .select("uri", "ip", "date", "kind", "payload", "payload_bytes", "digest", "first_uri", "first_date"))

    names = rows.columns

    def work(batches):
        yield from _files(_rows(batches, names), _warcinfo, lambda k, r: _warc_of(r), b"\r\n\r\n")

    _write(map_arrow(rows, work, FILE), warc_path, "\r\n\r\n")


def _warcinfo(number: int) -> bytes:
    headers = [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", "2020-01-01T00:00:00Z"), ("Content-Type", "application/warc-fields")]
    return warc_record("warcinfo", headers, f"software: streetflow\r\nisPartOf: part-{number}\r\n".encode())


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Response and revisit records of all WARC files of a folder."""

    def rows(batches):
        for data in _opened(batches):
            for h, block in parse_warc(data):
                if h["WARC-Type"] != "warcinfo":
                    digest = base64.b32decode(h["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    yield (h["WARC-Type"], h["WARC-Record-ID"], h["WARC-Target-URI"], h["WARC-Date"], int(h["X-Payload-Length"]),
                           digest, h.get("WARC-Refers-To-Target-URI"), block)

    return _read(spark, path, lambda batches: _batched(rows(batches), WARC, 7), WARC)


def _page_of(uri: str):
    """The page id that the query puts in front of each url."""
    return F.expr(f"try_cast(regexp_extract({uri}, '^page:([^/]*)/', 1) as bigint)")


SQL = f"""
with p as (select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages),
q as (select *, max(page_id) over (partition by payload_digest) as first from p)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= {REVISIT_BYTES} and first <> page_id then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= {REVISIT_BYTES} and first <> page_id then first end as refers_to
from q
"""


@query("op8_convert_archives", SQL)
def op8_convert_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    clean = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\s\p{Cntrl}]", "%20")
    date = F.date_format(F.timestamp_seconds(F.lit(1577836800) + F.coalesce("page_id", F.lit(0)) % 31536000), "yyyyMMddHHmmss")
    records = pages.select(F.concat(F.lit("page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("-")), F.lit("/"), clean).alias("uri"),
                           F.lit("0.0.0.0").alias("ip"), date.alias("date"), F.lit("text/html").alias("kind"),
                           F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    arc, warc = scratch(spark, "arc"), scratch(spark, "warc")
    write_arc(records, arc)
    convert(spark, arc, warc, _page_of("uri"))
    return read_warc(spark, warc).select(_page_of("uri").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"),
                                         F.col("warc_type").alias("record_type"), _page_of("refers_to_uri").alias("refers_to"))
