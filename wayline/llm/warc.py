"""WARC archives: a writer through Spark's file sink and a salvage reader that recovers damaged archives."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayline.llm.common import arrow_batches, stored
from wayline.session import scratch_path

#: A gzip member without content (between two records), the start of a member, a version line.
EMPTY_MEMBER = bytes([31, 139, 8, 0, 0, 0, 0, 0, 0, 255, 3, 0, 0, 0, 0, 0, 0, 0, 0, 0])
MEMBER_START = bytes([31, 139, 8])
VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
ALGORITHMS = ["md5", "sha1", "sha224", "sha256", "sha384", "sha512"]
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

READ_SCHEMA = ("path string, offset long, length long, kind string, reason string, record_id string, type string, "
               "target_uri string, refers_to string, payload_digest string, payload binary")
_READ_ARROW = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("kind", pa.string()),
                         ("reason", pa.string()), ("record_id", pa.string()), ("type", pa.string()),
                         ("target_uri", pa.string()), ("refers_to", pa.string()), ("payload_digest", pa.string()),
                         ("payload", pa.binary())])


def sha1_name(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def digest_agrees(named: str, data: bytes) -> bool | None:
    """Whether a digest is that of the data, in hex, base32 or base64; None if its label names no known algorithm."""
    label, colon, value = named.strip().partition(":")
    algorithm, value = label.strip().lower().replace("-", ""), value.strip().rstrip("=")
    if not colon or algorithm not in ALGORITHMS:
        return None
    own = hashlib.new(algorithm, data).digest()
    return (value.lower() == own.hex() or value.upper() == base64.b32encode(own).decode().rstrip("=")
            or value == base64.b64encode(own).decode().rstrip("="))


def record_bytes(record_type: str, record_id: str, uri: str | None, block: bytes, payload_digest: str,
                 refers_to: str | None = None) -> bytes:
    """One WARC/1.1 record; the dates are fixed so that a rerun writes the same bytes."""
    safe = re.sub(r"[\r\n]", " ", uri or "")
    lines = ["WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Record-ID: <{record_id}>",
             "WARC-Date: 2000-01-01T00:00:00Z", f"WARC-Target-URI: {safe}", f"WARC-Block-Digest: {sha1_name(block)}",
             f"WARC-Payload-Digest: {payload_digest}"]
    if refers_to:
        lines += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class Damaged(ValueError):
    """A record that fails a check."""


def parse_record(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(headers, block, end) of the record at a place; raises Damaged on any failed check."""
    if not VERSION_LINE.match(data, at):
        raise Damaged("no version line")
    head = data.find(b"\r\n\r\n", at)
    if head < 0:
        raise Damaged("headers not ended")
    headers = {}
    for line in data[at:head].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("bad header line")
        headers[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    size = headers.get("content-length", "")
    if not (size.isascii() and size.isdigit()):
        raise Damaged("no content length")
    first, end = head + 4, head + 4 + int(size)
    if data[end:end + 4] != b"\r\n\r\n":
        raise Damaged("record end not where its length says")
    block = data[first:end]
    if digest_agrees(headers.get("warc-block-digest", ""), block) is False:
        raise Damaged("block digest differs")
    return headers, block, end + 4


def _member(data: bytes, at: int) -> tuple[bytes, int, str]:
    """(content, end, problem) of a gzip member; of a damaged one what came out before the error."""
    unpacker, out, end, size, view = zlib.decompressobj(31), [], at, 4096, memoryview(data)
    try:
        while not unpacker.eof and end < len(data):  # in pieces, as zlib copies what it doesn't use
            out.append(unpacker.decompress(view[end:end + size]))
            end, size = min(end + size, len(data)), min(2 * size, 1 << 20)
    except zlib.error:
        return *_piecewise(data, at), "member does not unpack"
    return b"".join(out), end - len(unpacker.unused_data), "" if unpacker.eof else "member not ended"


def _piecewise(data: bytes, at: int, piece: int = 4096) -> tuple[bytes, int]:
    """Unpack up to an error, the last piece byte by byte."""
    unpacker, out, size = zlib.decompressobj(31), [], piece
    while at < len(data):
        saved = unpacker.copy() if size > 1 else None
        try:
            out.append(unpacker.decompress(data[at:at + size]))
            at += size
        except zlib.error:
            if saved is None:
                break
            unpacker, size = saved, 1
    return b"".join(out), at


def _unpacked(inner: bytes, problem: str) -> tuple[list[tuple[dict[str, str], bytes]], list[str]]:
    """Records of a member's content and the reasons of the gaps in it, found as in a plain archive.

    In a damaged member the last thing that came out is never sure, and after an error in its bytes only
    records whose digest was checked are.
    """
    records, gaps, place, gap, reason = [], [], 0, None, ""

    def close() -> None:
        gaps.append(f"{reason} (unpacked bytes {gap} to {place})")

    while place < len(inner):
        try:
            headers, block, end = parse_record(inner, place)
            if problem and end == len(inner):
                raise Damaged(problem)
            if problem == "member does not unpack" and not (
                    digest_agrees(headers.get("warc-block-digest", ""), block)
                    or digest_agrees(headers.get("warc-payload-digest", ""), _payload(headers, block))):
                raise Damaged(problem)
        except Damaged as found:
            if gap is None:
                gap, reason = place, str(found)
            line = VERSION_LINE.search(inner, place + 1)
            place = line.start() if line else len(inner)
            continue
        if gap is not None:
            close()
            gap = None
        records.append((headers, block))
        place = end
    if gap is not None:
        close()
    return records, gaps


def _unpack_at(data: bytes, at: int) -> tuple[list[tuple[dict[str, str], bytes]], list[str], int, str]:
    """(records, reasons of gaps, end, problem) of what stands at a place: a gzip member (with any number of
    records) or a plain record. Damaged if there is no record in something damaged."""
    if data[at:at + 3] == MEMBER_START:
        inner, end, problem = _member(data, at)
        records, gaps = _unpacked(inner, problem)
        if not records and (problem or gaps):
            raise Damaged(problem or gaps[0].partition(" (")[0])
        return records, gaps, end, problem
    headers, block, end = parse_record(data, at)
    return [(headers, block)], [], end, ""


def _next_start(data: bytes, at: int) -> int:
    """The next place that looks like a member or a version line, or the end of the data."""
    member = data.find(MEMBER_START, at)
    line = VERSION_LINE.search(data, at, member if member >= 0 else len(data))
    places = [p for p in (member, line.start() if line else -1) if p >= 0]
    return min(places, default=len(data))


def salvage(data: bytes) -> Iterator[tuple]:
    """Every record that passes its checks, and the byte gaps between them.

    Yields ("record", offset, length, headers, block) and ("gap", offset, length, reason). After a failed check
    the search goes on one byte later for the next member or version line from which a record reads well; all
    bytes up to there are one quarantined gap. In a gzip member the same search goes on in what it unpacks to, and
    a gap in it has the member's place and names the unpacked bytes. A member that is cut or breaks while it
    unpacks gives the records before the break, with the bytes read for them, and is then a gap as a whole.
    """
    at, gap, reason = 0, None, ""
    while at < len(data):
        try:
            records, gaps, end, problem = _unpack_at(data, at)
        except Damaged as found:
            if gap is None:
                gap, reason = at, str(found)
            at = _next_start(data, at + 1)
            continue
        if gap is not None:
            yield "gap", gap, at - gap, reason
            gap = None
        for headers, block in records:
            yield "record", at, end - at, headers, block
        if problem:  # the end is unknown: another member may follow inside the bytes read
            gap, reason = at, problem
            at = _next_start(data, at + 1)
            continue
        for inner in gaps:
            yield "gap", at, end - at, inner
        at = end
    if gap is not None:
        yield "gap", gap, len(data) - gap, reason


def _payload(headers: dict[str, str], block: bytes) -> bytes:
    if headers.get("content-type", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def _read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = data.as_py()
                for found in salvage(data):
                    kind, offset, length = found[:3]
                    if kind == "gap":
                        yield path, offset, length, kind, found[3], None, None, None, None, None, None
                        continue
                    headers, block = found[3:]
                    payload = _payload(headers, block)
                    digest = headers.get("warc-payload-digest")
                    kept = headers.get("warc-type") == "revisit"
                    if not kept and digest and digest_agrees(digest, payload) is False:
                        yield path, offset, length, "gap", "payload digest differs", *[None] * 6
                        continue
                    yield (path, offset, length, kind, None, headers.get("warc-record-id", "").strip("<>"),
                           headers.get("warc-type"), headers.get("warc-target-uri"),
                           headers.get("warc-refers-to", "").strip("<>") or None, digest, None if kept else payload)

    yield from arrow_batches(rows(), _READ_ARROW)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Rows of kind ``record`` and, for damaged stretches, of kind ``gap`` with the reason.

    Reads plain and gzipped archives through Spark's binary source, one file at a time in a task; a file must
    fit a worker's memory (the writer bounds its files). Empty files give no rows.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(_read_files, READ_SCHEMA)


def _write_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("value", pa.binary())])

    def rows():
        for batch in batches:
            for page, uri, html, refers in zip(*(batch.column(i).to_pylist() for i in range(4))):
                payload = b"" if html is None else html.encode()
                head = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
                        + str(len(payload)).encode() + b"\r\n\r\n")
                revisit = refers is not None
                yield (gzip_member(record_bytes(
                    "revisit" if revisit else "response", page, uri, head if revisit else head + payload,
                    sha1_name(payload), refers)),)

    yield from arrow_batches(rows(), schema)


def page_urn(page_id) -> F.Column:
    return F.concat(F.lit("urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")))


def write_archives(pages: DataFrame, path: str, id_column: str = "page_id", url_column: str = "url",
                   html_column: str = "html", min_revisit_bytes: int = 1000, records_per_file: int = 20_000) -> None:
    """Write one gzip member per page, each a response or revisit record.

    Of records with equal payloads of at least ``min_revisit_bytes`` the one with the largest id is a response
    and the others are revisits that refer to it; smaller ones are all responses. A NULL html is an empty
    payload; rows with a NULL id never are referred to, and repeated rows with the largest id are responses.
    Other columns are not read. An empty table writes no record.

    Payloads are compared by digest and length. Only digests are grouped (partial maxima first) and only
    digests that repeat are joined back; where those are few no page is shuffled. The sink is Spark's text
    writer over bytes, whose separator is an empty gzip member, so task commits keep the archives whole when
    executors are lost, and any file system Spark knows will do.
    """
    html = F.coalesce(F.col(html_column), F.lit(""))
    plain = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).cast("string").alias("url"),
                         F.col(html_column).cast("string").alias("html"), F.unhex(F.sha1(html)).alias("digest"),
                         F.octet_length(html).alias("bytes"))
    repeated = stored(
        plain.filter(F.col("bytes") >= min_revisit_bytes).groupBy(F.col("digest").alias("same"), F.col("bytes").alias(
            "same_bytes")).agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1").drop("n"), "warc-repeats")
    marked = plain.join(repeated, (F.col("digest") == F.col("same")) & (F.col("bytes") == F.col("same_bytes")), "left")
    refers = F.when(F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")),
                    page_urn(F.col("first_id")))
    records = marked.select(page_urn(F.col("page_id")).alias("page"), "url", "html", refers.alias("refers"))
    members = records.mapInArrow(_write_records, "value binary").select(F.col("value").cast("string").alias("value"))
    (members.write.mode("overwrite").option("lineSep", EMPTY_MEMBER.decode("latin-1"))
     .option("encoding", "ISO-8859-1").option("compression", "none")
     .option("maxRecordsPerFile", records_per_file).text(path))


def archive_round_trip(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write the pages as archives, read them back and resolve revisits: one row per record read."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "archives")
    write_archives(pages, path, **options)
    # the digests of payloads are short: kept in a table, so that archives are unpacked once
    records = stored(read_archives(spark, path).filter("kind = 'record'").select(
        F.regexp_extract("record_id", "^urn:page:(-?[0-9]+)$", 1).alias("page"), F.col("type").alias("record_type"),
        "record_id", "refers_to", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest")), "archive-records")
    page = F.when(F.col("page") != "", F.col("page").cast("long"))
    responses = records.filter("record_type = 'response'").select(
        page.alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias(
            "refers_to"))
    first = records.filter("record_type = 'response'").select(
        F.col("record_id").alias("of"), "payload_bytes", "payload_digest").dropDuplicates(["of"])
    revisits = records.filter("record_type = 'revisit'").drop("payload_bytes", "payload_digest").join(
        first, F.col("refers_to") == F.col("of"), "left").select(
        page.alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.regexp_extract("refers_to", "(-?[0-9]+)$", 1).cast("long").alias("refers_to"))
    return responses.unionByName(revisits)
