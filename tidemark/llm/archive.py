"""Legacy ARC archives: writing them, converting them to WARC, and reading WARC back.

``write_arc`` lays captures out as ARC files of version 1 or 2 (five or ten header fields), ``arc_records`` parses them by
their version block and declared lengths, ``to_warc`` gives each record the equivalent WARC identifier, date, type and
digests and turns repeated payloads into revisits, ``write_warc`` and ``warc_records`` are the WARC side.

Files are written by Spark's text writer, whose line separator is the archives' record separator, and read as binary
files, so any store Spark knows will do. A record never shares bytes with another: places come from declared lengths,
so payloads may hold anything, header look-alikes included.

Defined results: a null payload is empty; a null URL becomes ``urn:page:<id>``; white space in URLs is percent-encoded; of equal payloads
of at least ``least`` bytes the smallest id is the response and the others revisit it; records without an id
never serve as one; repeated rows of the smallest id are all responses; a truncated or malformed archive fails.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Fixed values of the two ARC versions: the field lines of their version blocks.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
#: Fast compression: archives are written once and read once here.
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
#: Arrow batches that leave a parser hold about this many payload bytes.
BATCH_BYTES = 8 << 20


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _binary(text: Column | str) -> Column:
    return (F.lit(text) if isinstance(text, str) else text).cast("binary")


def http_captures(pages: DataFrame, fetched: Column, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """(id, url, at, mime, block): pages as HTTP responses; the head carries the page's id and the payload's length."""
    payload = F.coalesce(F.col(body).cast("binary"), F.lit(b""))
    name = F.concat(F.lit("X-Page-Id: "), F.col(key).cast("string"), F.lit("\r\n"))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), F.coalesce(name, F.lit("")),
                    F.lit("Content-Length: "), F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"))
    address = F.coalesce(F.regexp_replace(F.when(F.trim(url) != "", F.col(url)), r"\s", "%20"),
                         F.concat(F.lit("urn:page:"), F.coalesce(F.col(key).cast("string"), F.lit("none"))))
    return pages.select(F.col(key).cast("long").alias("id"), address.alias("url"), F.coalesce(fetched, F.lit("1996-01-01").cast("timestamp")).alias("at"),
                        F.lit("text/html").alias("mime"), F.concat(head.cast("binary"), payload).alias("block"))


def write_arc(captures: DataFrame, folder: str, name: str = "tidemark") -> None:
    """One gzipped ARC file per partition, version 1 in even and 2 in odd partitions; its first record describes it."""
    version = F.spark_partition_id() % 2 + 1
    date = F.date_format("at", "yyyyMMddHHmmss")
    size = F.octet_length("block").cast("string")
    header = F.when(version == 1, F.concat_ws(" ", "url", F.lit("0.0.0.0"), date, "mime", size)).otherwise(
        F.concat_ws(" ", "url", F.lit("0.0.0.0"), date, "mime", F.lit("200"), F.lit("-"), F.lit("-"), F.lit("0"), F.lit(f"{name}.arc.gz"), size))
    opening = {v: f"{v} 0 {name}\n{fields}\n" for v, fields in ARC_FIELDS.items()}
    first = {v: f"filedesc://{name}.arc 0.0.0.0 19960101000000 text/plain " + ("" if v == 1 else f"200 - - 0 {name}.arc.gz ") + f"{len(block)}\n{block}\n"
             for v, block in opening.items()}
    # The lower 33 bits of this id count the rows of a partition.
    start = F.when(F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0, F.when(version == 1, F.lit(first[1])).otherwise(F.lit(first[2]))).otherwise("")
    record = F.concat(_binary(F.concat(start, header, F.lit("\n"))), F.col("block"))
    captures.select(record.cast("string").alias("value")).write.options(**GZIP, lineSep="\n").text(folder)


def inflate(content: bytes) -> bytes:
    """All members of a gzip file; other content as it is."""
    if content[:2] != b"\x1f\x8b":
        return content
    out = []
    while content:
        member = zlib.decompressobj(31)
        out.append(member.decompress(content))
        if not member.eof:
            raise ValueError("gzip member is truncated")
        content = member.unused_data
    return b"".join(out)


def parse_arc(data: bytes) -> Iterator[tuple[int, list[str], bytes]]:
    """(offset, header fields, block) of each record. The version block says how many fields a header line has."""
    at, fields = 0, None
    while at < len(data):
        if data[at:at + 1] == b"\n":  # separator
            at += 1
            continue
        stop = data.find(b"\n", at)
        line = data[at:stop if stop >= 0 else len(data)].decode("utf-8", "replace").split(" ")
        if stop < 0 or not line[-1].isdigit():
            raise ValueError(f"no ARC header at byte {at}")
        size = int(line[-1])
        block = data[stop + 1:stop + 1 + size]
        if len(block) < size:
            raise ValueError(f"ARC record at byte {at} is truncated")
        if line[0].startswith("filedesc:"):
            version = int(block.split(b" ", 1)[0])
            fields = len(ARC_FIELDS[version].split(" "))
        if fields is None or len(line) != fields:
            raise ValueError(f"ARC header at byte {at} has {len(line)} fields, not {fields}")
        yield at, line, block
        at = stop + 1 + size


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """Head (with its blank line) and payload of an HTTP response; any other block is all payload."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    stop = block.find(b"\r\n\r\n")
    return (block, b"") if stop < 0 else (block[:stop + 4], block[stop + 4:])


def header_value(head: bytes, name: bytes) -> str | None:
    for line in head.split(b"\r\n")[1:]:
        field, _, value = line.partition(b":")
        if field.strip().lower() == name:
            return value.strip().decode("utf-8", "replace")
    return None


def _number(text: str | None) -> int | None:
    return int(text) if text is not None and text.lstrip("-").isdigit() else None


def _batches(rows: Iterator[tuple[int, dict]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as batches; each row comes with its weight in bytes."""
    held, weight = [], 0
    for size, row in rows:
        held.append(row)
        weight += size
        if weight >= BATCH_BYTES or len(held) >= 10_000:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _archives(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("path", "content")


def arc_records(spark: SparkSession, folder: str, blocks: bool = True) -> DataFrame:
    """(file, offset, url, ip, date, mime, id, payload_bytes, payload_sha256, head, payload) of every ARC record.

    Without ``blocks`` head and payload are null, which spares their way through Spark.
    """
    schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("url", pa.string()), ("ip", pa.string()), ("date", pa.string()), ("mime", pa.string()),
                        ("id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("head", pa.binary()), ("payload", pa.binary())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict]]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                for offset, line, block in parse_arc(inflate(content.as_py())):
                    head, payload = split_http(block)
                    yield len(block) if blocks else 0, {
                        "file": path.rsplit("/", 1)[-1].split("-")[1], "offset": offset, "url": line[0], "ip": line[1], "date": line[2], "mime": line[3],
                        "id": _number(header_value(head, b"x-page-id")), "payload_bytes": len(payload), "payload_sha256": hashlib.sha256(payload).hexdigest(),
                        "head": head if blocks else None, "payload": payload if blocks else None}

    return _archives(spark, folder).mapInArrow(
        lambda batches: _batches(rows(batches), schema),
        "file string, offset long, url string, ip string, date string, mime string, id long, payload_bytes long, payload_sha256 string, head binary, payload binary")


def _record_id() -> Column:
    """A name-based identifier from what the ARC header says and where it stands, in UUID form."""
    h = F.md5(_binary(F.concat_ws("|", "url", "date", "file", "offset", "payload_sha256")))
    piece = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("urn:uuid:"), piece(1, 8), F.lit("-"), piece(9, 4), F.lit("-3"), piece(14, 3), F.lit("-a"), piece(18, 3), F.lit("-"), piece(21, 12))


def to_warc(spark: SparkSession, folder: str, least: int = 100) -> DataFrame:
    """(record_type, record_id, header, block): the WARC equivalent of every record of the ARC files in ``folder``.

    ``filedesc`` records become ``warcinfo``, HTTP responses ``response`` or ``revisit``, anything else ``resource``.
    """
    # The smallest id of each payload comes from a pass that moves no payloads.
    known = arc_records(spark, folder, blocks=False).where((F.col("payload_bytes") >= least) & F.col("id").isNotNull())
    first = (known.groupBy("payload_sha256", "payload_bytes").agg(F.min(F.struct("id", _record_id().alias("record_id"), "url", "date")).alias("first")))
    rows = arc_records(spark, folder).withColumn("record_id", _record_id()).join(first, ["payload_sha256", "payload_bytes"], "left")
    http = F.octet_length("head") > 0
    repeat = http & F.col("first").isNotNull() & (F.col("id").isNull() | (F.col("id") != F.col("first.id")))
    kind = (F.when(F.col("url").startswith("filedesc:"), "warcinfo").when(repeat, "revisit").when(http, "response").otherwise("resource"))
    rows = rows.withColumn("record_type", kind).withColumn(
        "block", F.when(F.col("record_type") == "revisit", F.col("head")).otherwise(F.concat("head", "payload")))
    instant = lambda c: F.date_format(F.try_to_timestamp(c, F.lit("yyyyMMddHHmmss")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    only = lambda kinds, text: F.when(F.col("record_type").isin(*kinds), text)
    media = (F.when(F.col("record_type") == "warcinfo", F.lit("text/plain")).when(F.col("record_type") == "resource", F.col("mime"))
             .otherwise(F.lit("application/http;msgtype=response")))
    header = F.concat_ws(
        "", F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", F.concat(F.lit("<"), "record_id", F.lit(">"))),
        line("WARC-Date", instant(F.col("date"))), only(("response", "revisit", "resource"), line("WARC-Target-URI", F.col("url"))),
        only(("response", "revisit"), line("WARC-IP-Address", F.col("ip"))), line("Content-Type", media),
        only(("response", "revisit"), line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "payload_sha256"))),
        only(("revisit",), F.concat(
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            line("WARC-Refers-To", F.concat(F.lit("<"), F.col("first.record_id"), F.lit(">"))),
            line("WARC-Refers-To-Target-URI", F.col("first.url")), line("WARC-Refers-To-Date", instant(F.col("first.date"))))),
        line("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.sha2("block", 256))),
        line("Content-Length", F.octet_length("block").cast("string")), F.lit("\r\n"))
    return rows.select("record_type", "record_id", header.alias("header"), "block")


def write_warc(records: DataFrame, folder: str) -> None:
    """Gzipped WARC files of at most 5,000 records."""
    value = F.concat(_binary(F.col("header")), F.col("block")).cast("string").alias("value")
    records.select(value).write.options(**GZIP, lineSep="\r\n\r\n", maxRecordsPerFile=5000).text(folder)


def parse_warc(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(header, block) of each record."""
    at = 0
    while at < len(data):
        stop = data.find(b"\r\n\r\n", at)
        if stop < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC header at byte {at}")
        header = data[at:stop]
        size = _number(header_value(header, b"content-length"))
        block = data[stop + 4:stop + 4 + (size or 0)]
        at = stop + 4 + (size or 0)
        if size is None or len(block) < size or data[at:at + 4] != b"\r\n\r\n":
            raise ValueError(f"WARC record before byte {at} is truncated")
        at += 4
        yield header, block


def warc_records(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """(record_type, record_id, refers_to_id, url, date, id, payload_bytes, payload_sha256, payload) of every record.

    Length and digest of a response's payload are taken from its bytes and must agree with the header; a revisit has
    those of the full payload from its own head and header, and a null payload.
    """
    schema = pa.schema([("record_type", pa.string()), ("record_id", pa.string()), ("refers_to_id", pa.string()), ("url", pa.string()), ("date", pa.string()),
                        ("id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("payload", pa.binary())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict]]:
        for batch in batches:
            for content in batch.column(1):
                for header, block in parse_warc(inflate(content.as_py())):
                    kind = header_value(header, b"warc-type")
                    head, payload = split_http(block)
                    stated = (header_value(header, b"warc-payload-digest") or "").removeprefix("sha256:") or None
                    if kind == "revisit":
                        size, digest = _number(header_value(head, b"content-length")), stated
                    else:
                        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
                        if stated not in (None, digest):
                            raise ValueError(f"payload of {header_value(header, b'warc-record-id')} does not have the digest it states")
                    whole = payloads and kind != "revisit"
                    yield len(payload) if whole else 0, {
                        "record_type": kind, "record_id": (header_value(header, b"warc-record-id") or "").strip("<>"),
                        "refers_to_id": (header_value(header, b"warc-refers-to") or "").strip("<>") or None,
                        "url": header_value(header, b"warc-target-uri"), "date": header_value(header, b"warc-date"),
                        "id": _number(header_value(head, b"x-page-id")), "payload_bytes": size, "payload_sha256": digest, "payload": payload if whole else None}

    return _archives(spark, folder).mapInArrow(
        lambda batches: _batches(rows(batches), schema),
        "record_type string, record_id string, refers_to_id string, url string, date string, id long, payload_bytes long, payload_sha256 string, payload binary")
