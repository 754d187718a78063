"""Operator 3: convert legacy ARC archives to WARC.

``write_arc`` writes pages as ARC files (versions 1 and 2), ``read_arc`` parses them by their version block and the
declared lengths, ``convert_to_warc`` writes the equivalent WARC 1.1 files, and ``read_warc`` reads those back. The
converter synthesises what ARC lacks: record ids (a name-based UUID of archive, offset and URI, so a retried task gives
the same ids), ISO timestamps, record types (warcinfo for the filedesc block, response for HTTP, resource otherwise),
block and payload digests, and revisit records for payloads that another response already holds.

Archives are gzip files of about ``archive_bytes`` of records. They are written by Spark's text writer (a record is a
"line"; the line separator is the record's own end, LF in ARC and CRLF in WARC) and read by its binary reader, so any
store that Spark reaches will do. A task holds one compressed archive and one record at a time.

Defined cases: null html is an empty payload; a null or empty URL becomes ``urn:page:<id>``; spaces and controls in a
URL are percent-encoded; a null page_id has no X-Page-Id header and reads back as null; repeated rows are records of
their own, and the largest (page_id, record id) of equal payloads is the response; a record shorter than declared is
kept and marked WARC-Truncated; an empty table gives no archives and an empty result. Other columns are ignored."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm.scratch import Scratch, bounded_batches

# Fixed values of the two formats.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
ARC_VERSION_LINE = {1: "1 0 logloom", 2: "2 0 logloom"}
WARC_VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

BLOCKS = "archive string, seq long, block binary"
RECORDS = ("archive string, at long, version int, uri string, ip string, date string, mime string, record_id string, page_id long, "
           "truncated boolean, http binary, payload binary, payload_bytes long, payload_digest string")
NARROW = "path string, at long, record_id string, page_id long, uri string, date string, payload_bytes long, payload_digest string"
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, record_id string, refers_to_id string, uri string, date string"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _column(values: list, kind: str) -> pa.Array:
    return pa.array(values, {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}[kind])


def _batched(rows, schema: str, most_bytes: int = 4 << 20):
    """Record batches of tuples, each of about ``most_bytes`` of binary values at most (or one row)."""
    names, kinds = zip(*(c.strip().split(" ") for c in schema.split(",")), strict=True)
    held, size = [], 0

    def flush():
        return pa.RecordBatch.from_arrays([_column([r[i] for r in held], k) for i, k in enumerate(kinds)], list(names))

    for row in rows:
        held.append(row)
        size += 200 + sum(len(v) for v in row if isinstance(v, bytes))
        if size >= most_bytes:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


def _rolled(records, first, name: str, archive_bytes: int):
    """Rows (archive, seq, block) of this task; a new archive begins with ``first(archive)`` when one is full.
    The partition's number names its archives, so a retried task writes the same ones."""
    part, n, seq, size = TaskContext.get().partitionId(), 0, 0, archive_bytes
    archive = ""
    for record in records:
        if size >= archive_bytes:
            archive, n, seq, size = f"{name}-{part:06d}-{n:05d}", n + 1, 0, 0
            yield archive, seq, first(archive)
        seq += 1
        size += len(record)
        yield archive, seq, record


def _write_blocks(blocks: DataFrame, folder: str, line_end: str) -> None:
    blocks.sortWithinPartitions("archive", "seq").select("archive", F.col("block").cast("string").alias("value")) \
        .write.partitionBy("archive").option("lineSep", line_end).option("compression", "gzip").text(folder)


def _archives(spark: SparkSession, folder: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    own, name = F.regexp_extract("path", "archive=([^/]+)/", 1), F.substring_index("path", "/", -1)
    return files.select(F.when(own != "", own).otherwise(name).alias("archive"), "path", "content")


def _encode_uri(uri: str | None, page_id: int | None) -> str:
    if not uri:
        return f"urn:page:{'' if page_id is None else page_id}"
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri)


def write_arc(pages: DataFrame, folder: str, date: str = "20240101000000", archive_bytes: int = 64 << 20) -> None:
    """Pages (page_id, url, html) as ARC files: each archive begins with a filedesc block, odd ones are version 2."""
    bounded_batches(pages.sparkSession)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").cast("binary").alias("html"))

    def version_of(archive: str) -> int:
        return 1 + int(archive[-5:]) % 2

    def filedesc(archive: str) -> bytes:
        version = version_of(archive)
        body = f"{ARC_VERSION_LINE[version]}\n{ARC_FIELDS[version]}\n".encode()
        rest = "" if version == 1 else "200 - - 0 " + archive + " "
        return f"filedesc://{archive} 0.0.0.0 {date} text/plain {rest}{len(body)}\n".encode() + body

    class Page(bytes):
        """An HTTP message that knows its URI; its header line depends on the archive it falls into."""
        uri = ""

    def messages(batches):
        for batch in batches:
            for page_id, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                html = html or b""
                own = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
                message = Page(f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}\r\n{own}\r\n".encode() + html)
                message.uri = _encode_uri(url, page_id)
                yield message

    def run(batches):
        offset = 0
        def blocks():
            nonlocal offset
            for archive, seq, message in _rolled(messages(batches), filedesc, "arc", archive_bytes):
                if seq:
                    rest = "" if version_of(archive) == 1 else f"200 {hashlib.md5(message).hexdigest()} - {offset} {archive} "
                    message = f"{message.uri} 0.0.0.0 {date} text/html {rest}{len(message)}\n".encode("utf-8", "surrogatepass") + message
                else:
                    offset = 0
                offset += len(message) + 1
                yield archive, seq, bytes(message)
        yield from _batched(blocks(), BLOCKS)

    _write_blocks(pages.mapInArrow(run, BLOCKS), folder, "\n")


def parse_arc(archive: str, content: bytes):
    """The records of one ARC file (gzip or plain) as tuples of RECORDS, the filedesc block left out."""
    stream = gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    fields, version, at = ARC_FIELDS[1].split(" "), 1, 0
    while line := stream.readline():
        begin, at = at, at + len(line)
        if not line.strip():
            continue
        values = line.rstrip(b"\r\n").decode("utf-8", "replace").rsplit(" ", len(fields) - 1)
        if line.startswith(b"filedesc://"):
            values = line.rstrip(b"\r\n").decode("utf-8", "replace").split(" ")
        if not values[-1].isdigit():
            raise ValueError(f"{archive}, byte {begin}: no length in {line[:80]!r}")
        length = int(values[-1])
        message = stream.read(length)
        at += len(message)
        if line.startswith(b"filedesc://"):
            head = message.decode("utf-8", "replace").split("\n")
            version, fields = int(head[0].split(" ")[0]), head[1].strip().split(" ")
            continue
        of = dict(zip(fields, values, strict=False))
        http, payload = b"", message
        if message.startswith(b"HTTP/") and (cut := message.find(b"\r\n\r\n")) >= 0:
            http, payload = message[: cut + 4], message[cut + 4 :]
        own = re.search(rb"\r\nX-Page-Id: (-?\d+)\r\n", http)
        stamp = of["Archive-date"].ljust(14, "0")
        date = f"{stamp[:4]}-{stamp[4:6]}-{stamp[6:8]}T{stamp[8:10]}:{stamp[10:12]}:{stamp[12:14]}Z"
        name = f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{begin}#{of['URL']}')}"
        yield (archive, begin, version, of["URL"], of["IP-address"], date, of["Content-type"], name, int(own[1]) if own else None,
               len(message) < length, http, payload, len(payload), digest(payload))


def read_arc(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The records of all ARC files below ``folder``; without ``payloads`` only the columns of NARROW."""
    def rows(batches):
        for batch in batches:
            for archive, path, content in zip(*(batch.column(c) for c in ("archive", "path", "content")), strict=True):
                for r in parse_arc(archive.as_py(), content.as_py()):
                    yield r if payloads else (path.as_py(), r[1], r[7], r[8], r[3], r[5], r[12], r[13])

    schema = RECORDS if payloads else NARROW
    return _archives(spark, folder).mapInArrow(lambda batches: _batched(rows(batches), schema), schema)


def _header(lines: list[tuple[str, object]]) -> bytes:
    return "".join([f"{WARC_VERSION}\r\n", *(f"{k}: {v}\r\n" for k, v in lines if v is not None), "\r\n"]).encode()


def warc_record(r: dict) -> bytes:
    """One WARC record of a converted ARC record, without its last CRLF (the text writer's line end)."""
    revisit = r["first_id"] is not None and r["first_id"] != r["record_id"]
    kind = "revisit" if revisit else "response" if r["http"] or not r["uri"].startswith("dns:") else "resource"
    block = r["http"] if revisit else r["http"] + r["payload"]
    mime = "application/http;msgtype=response" if r["http"] else r["mime"]
    lines = [("WARC-Type", kind), ("WARC-Record-ID", f"<{r['record_id']}>"), ("WARC-Date", r["date"]), ("WARC-Target-URI", r["uri"]),
             ("WARC-IP-Address", None if r["ip"] == "0.0.0.0" else r["ip"]), ("WARC-Block-Digest", f"sha1:{digest(block)}"),
             ("WARC-Payload-Digest", f"sha1:{r['payload_digest']}"), ("WARC-Payload-Length", r["payload_bytes"]), ("WARC-Truncated", "length" if r["truncated"] else None)]
    if revisit:
        lines += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{r['first_id']}>"), ("WARC-Refers-To-Target-URI", r["first_uri"]), ("WARC-Refers-To-Date", r["first_date"])]
    return _header([*lines, ("Content-Type", mime), ("Content-Length", len(block))]) + block + b"\r\n"


def convert_to_warc(spark: SparkSession, arc_folder: str, warc_folder: str, least_payload: int = 0, archive_bytes: int = 64 << 20) -> None:
    """Convert all ARC files. Of records with equal payloads of at least ``least_payload`` bytes, the one with the
    largest (page_id, record id) is written whole and the others revisit it. Who revisits whom is learned from the
    records without payloads; each archive then gets its revisits, and no payload is shuffled."""
    bounded_batches(spark)
    scratch = Scratch(spark, "arc-records")
    records = scratch.save(read_arc(spark, arc_folder, payloads=False), "records")
    same = ["payload_digest", "payload_bytes"]
    equal = records.where(F.col("payload_bytes") >= least_payload).groupBy(*same).agg(
        F.max(F.struct("page_id", "record_id", "uri", "date")).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = records.select("path", "at", "record_id", *same).join(equal, same).where("record_id <> first.record_id")
    revisits = later.select("path", F.struct("at", F.col("first.record_id").alias("first_id"), F.col("first.uri").alias("first_uri"), F.col("first.date").alias("first_date")).alias("r"))
    revisits = revisits.groupBy("path").agg(F.collect_list("r").alias("revisits"))  # at most an archive's records
    archives = _archives(spark, arc_folder).join(revisits, "path", "left").select("archive", "content", "revisits")

    def warcinfo(archive: str) -> bytes:
        body = f"software: logloom\r\nformat: {WARC_VERSION}\r\ndescription: converted from ARC\r\n".encode()
        name = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, archive)}>"
        return _header([("WARC-Type", "warcinfo"), ("WARC-Record-ID", name), ("WARC-Date", "2024-01-01T00:00:00Z"), ("WARC-Filename", archive),
                        ("Content-Type", "application/warc-fields"), ("Content-Length", len(body))]) + body + b"\r\n"

    names = [c.split(" ")[0] for c in RECORDS.split(", ")]

    def converted(batches):
        for batch in batches:
            for archive, content, found in zip(*batch.columns, strict=True):
                found = found.values if found.is_valid else None
                place = {} if found is None else {at: i for i, at in enumerate(found.field("at").to_pylist())}
                for r in parse_arc(archive.as_py(), content.as_py()):
                    i = place.get(r[1])
                    yield warc_record(dict(zip(names, r, strict=True)) | ({"first_id": None} if i is None else found[i].as_py()))

    def run(batches):
        yield from _batched(_rolled(converted(batches), warcinfo, "warc", archive_bytes), BLOCKS)

    _write_blocks(archives.mapInArrow(run, BLOCKS), warc_folder, "\r\n")
    scratch.drop(records)


def _payload_length(head: dict[str, str], http: bytes) -> int | None:
    """Bytes of the payload that a revisit leaves out: by this library's header field, else by the HTTP header, whose
    names have any case; null where neither says it."""
    if "warc-payload-length" in head:
        return int(head["warc-payload-length"])
    found = re.search(rb"(?i)\r\ncontent-length:[ \t]*(\d+)[ \t]*\r\n", http)
    return int(found[1]) if found else None


def parse_warc(content: bytes):
    """The response, resource and revisit records of one WARC file as tuples of READ."""
    stream = gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:80]!r}")
        head = {}
        while (line := stream.readline()).strip():
            k, _, v = line.decode("utf-8", "replace").rstrip("\r\n").partition(": ")
            head[k.lower()] = v
        block = stream.read(int(head["content-length"]))
        kind = head["warc-type"]
        if kind not in ("response", "resource", "revisit"):
            continue
        http, payload = b"", block
        if head["content-type"].startswith("application/http") and (cut := block.find(b"\r\n\r\n")) >= 0:
            http, payload = block[: cut + 4], block[cut + 4 :]
        own = re.search(rb"\r\nX-Page-Id: (-?\d+)\r\n", http)
        if kind == "revisit":
            size, said = _payload_length(head, http), head.get("warc-payload-digest", "").removeprefix("sha1:") or None
        else:
            size, said = len(payload), digest(payload)
        yield (int(own[1]) if own else None, size, said, kind, head["warc-record-id"].strip("<>"),
               head["warc-refers-to"].strip("<>") if "warc-refers-to" in head else None, head.get("warc-target-uri"), head["warc-date"])


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all WARC files below ``folder``; sizes and digests are of the full payload."""
    def rows(batches):
        for batch in batches:
            for content in batch.column("content"):
                yield from parse_warc(content.as_py())

    return _archives(spark, folder).mapInArrow(lambda batches: _batched(rows(batches), READ), READ)


def pages_to_warc(pages: DataFrame, least_payload: int = 0, archive_bytes: int = 64 << 20) -> tuple[str, DataFrame]:
    """Pages to ARC to WARC: the folder of WARC files, and its records with ``refers_to``, the page id of the response
    that a revisit names."""
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    arcs, warcs = scratch.path("arc"), scratch.path("warc")
    write_arc(pages, arcs, archive_bytes=archive_bytes)
    convert_to_warc(spark, arcs, warcs, least_payload, archive_bytes)
    records = read_warc(spark, warcs)
    responses = records.where("record_type <> 'revisit'").select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
    return warcs, records.join(responses, "refers_to_id", "left")
