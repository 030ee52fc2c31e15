"""WARC archives: writing pages as segmented records and putting them together again.

Writing: a page is an HTTP response in chunked transfer framing. A block longer than the segment size becomes a first
segment and continuation records that name the first one's id, count upwards, and the last of which states the total length.
Of equal large payloads one is stored, the others are revisit records that refer to it. Records go through
Spark's text writer as raw bytes, with the record end as line separator, one gzipped archive per task and number of records.

Reading: archives are read as binary files and parsed as streams; continuation records meet their first segment by
a grouping on the origin id, which moves segmented records only. Numbers must be complete and lengths must add up, then
the transfer framing is decoded. A revisit takes its payload's length from the response it refers to.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldglass.sources.scratch import materialize, scratch_path

from .common import record_batch

CRLF = b"\r\n"
RECORD_END = "\r\n\r\n"
#: Equal payloads of at least so many bytes are stored once.
REVISIT_BYTES = 1000
#: Bytes of a record's block before it is continued in another record.
SEGMENT_BYTES = 16_384
#: Bytes of one chunk of the transfer framing.
CHUNK_BYTES = 4_096
#: Records of one archive; with the segment size this bounds an archive at about 34 MB before compression.
ARCHIVE_RECORDS = 2_048
#: Bytes of the rows that go to Spark at a time.
BATCH_BYTES = 1 << 20
#: Repeated digests that are broadcast (about 100 bytes each), and the part of all rows beyond which one always is.
BROADCAST_DIGESTS, HOT = 200_000, 10_000
STATUS = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = []
    for start in range(0, len(payload), size):
        piece = payload[start : start + size]
        parts += [b"%x" % len(piece), CRLF, piece, CRLF]
    return b"".join([*parts, b"0", CRLF, CRLF])


def dechunked(body: bytes) -> bytes:
    """Payload of a body in chunked framing; extensions and trailers are allowed, anything unfinished is an error."""
    parts, at = [], 0
    while True:
        end = body.index(CRLF, at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            if not body[at:].endswith(CRLF):
                raise ValueError("the framing has no end")
            return b"".join(parts)
        if body[at + size : at + size + 2] != CRLF:
            raise ValueError("a chunk's length is wrong")
        parts.append(body[at : at + size])
        at += size + 2


def record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    """A record without the two line ends that close it; the writer adds them."""
    lines = ["WARC/1.0", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + CRLF + CRLF + block


def page_records(number: str, uri: str, payload: bytes | None, digest: str, refers_to: str | None, segment: int) -> Iterator[bytes]:
    """Records of one page. ``number`` makes ids unique; ``payload`` is None for a revisit."""
    origin = f"<urn:page:{number}:1>"
    kind = "response" if payload is not None else "revisit"
    block = STATUS + (b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload) if payload is not None else CRLF)
    pieces = [block[i : i + segment] for i in range(0, len(block), segment)]
    head = [("WARC-Type", kind), ("WARC-Record-ID", origin), ("WARC-Target-URI", uri), ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if refers_to is not None:
        head += [("WARC-Refers-To", f"<urn:payload:{refers_to}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")]
    if len(pieces) > 1:
        head.append(("WARC-Segment-Number", 1))
    yield record(head, pieces[0])
    for n, piece in enumerate(pieces[1:], 2):
        more = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:page:{number}:{n}>"), ("WARC-Segment-Origin-ID", origin), ("WARC-Segment-Number", n), ("WARC-Target-URI", uri), ("WARC-Date", "1970-01-01T00:00:00Z")]
        yield record(more + ([("WARC-Segment-Total-Length", len(block))] if n == len(pieces) else []), piece)


def deduplicated(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, uri, payload) with digest and ``refers_to``, the largest page_id that has the same large payload; then without the payload.

    Repeated digests are found from digests and ids alone. Their table is broadcast if it is small; else those that many pages have
    are, and the pages with one of the others are joined by a shuffle in which no digest has more than a ``HOT``-th part of all rows.
    """
    known = pages.select("*", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("bytes"))
    large = F.col("bytes") >= REVISIT_BYTES
    repeated = known.where(large).groupBy("digest").agg(F.max("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1")
    repeated = materialize(repeated.select(F.col("digest").alias("of"), "first_id", "n"), "repeated-digests")
    sizes = repeated.agg(F.count("*").alias("digests"), F.sum("n").alias("rows")).first()
    same = (F.col("digest") == F.col("of")) & large
    if sizes["digests"] <= BROADCAST_DIGESTS:
        joined = known.join(F.broadcast(repeated), same, "left")
    else:
        often = F.col("n") > max(1, sizes["rows"] // HOT)
        settled = known.join(F.broadcast(repeated.where(often)), same, "left")
        open_ = settled.where("of IS NULL").drop("of", "first_id", "n")
        joined = settled.where("of IS NOT NULL").unionByName(open_.join(repeated.where(~often), same, "left"))
    revisit = F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("page_id"))
    return joined.select("page_id", "uri", F.when(~revisit, F.col("payload")).alias("payload"), "digest", F.when(revisit, F.col("first_id")).alias("refers_to"))


def _by_bytes(schema: pa.Schema, rows: Iterator[tuple], size) -> Iterator[pa.RecordBatch]:
    """Batches of rows, each closed once its rows have ``BATCH_BYTES``."""
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += 200 + size(row)
        if total >= BATCH_BYTES:
            yield record_batch(schema, list(zip(*held)))
            held, total = [], 0
    if held:
        yield record_batch(schema, list(zip(*held)))


def write_archives(pages: DataFrame, path: str, segment: int = SEGMENT_BYTES, records: int = ARCHIVE_RECORDS) -> None:
    """Write archives for ``pages`` (page_id, uri, payload, digest, refers_to) below ``path``; those that refer to another have no payload."""
    schema = pa.schema([("record", pa.binary())])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes]]:
        from pyspark import TaskContext

        part, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            # one row after the other, so that only one page at a time is held twice
            for values in zip(*batch.columns):
                page_id, uri, payload, digest, refers_to = (v.as_py() for v in values)
                name = f"{'' if page_id is None else page_id}:{part}-{row}"
                row += 1
                clean = "".join(c for c in uri or "" if c not in "\r\n")
                for record in page_records(name, clean, None if refers_to is not None else payload, digest, refers_to, segment):
                    yield (record,)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _by_bytes(schema, made(batches), lambda r: len(r[0]))

    rows = pages.select("page_id", "uri", "payload", "digest", "refers_to").mapInArrow(run, "record binary")
    writer = rows.select(F.col("record").cast("string").alias("value")).write
    writer.option("lineSep", RECORD_END).option("compression", "gzip").option("maxRecordsPerFile", records).text(path)


def parse_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of a gzipped archive, unpacked as a stream."""
    unpack, buffer, fed = zlib.decompressobj(31), bytearray(), 0

    def fill() -> bool:
        nonlocal fed, unpack
        while fed < len(data) or unpack.unconsumed_tail:
            if unpack.eof:
                unpack = zlib.decompressobj(31)
            got = unpack.decompress(unpack.unconsumed_tail or data[fed : (fed := fed + 65_536)], 1 << 20)
            if unpack.eof and unpack.unused_data:
                fed -= len(unpack.unused_data)
            if got:
                buffer.extend(got)
                return True
        return False

    while buffer or fill():
        while (end := buffer.find(b"\r\n\r\n")) < 0:
            if not fill():
                raise ValueError("an archive ends inside a header")
        lines = bytes(buffer[:end]).decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record starts with {lines[0][:40]!r}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        size = int(headers["Content-Length"])
        while len(buffer) < end + 8 + size:
            if not fill():
                raise ValueError("an archive ends inside a block")
        block = bytes(buffer[end + 4 : end + 4 + size])
        if buffer[end + 4 + size : end + 8 + size] != b"\r\n\r\n":
            raise ValueError("a block's length is wrong")
        del buffer[: end + 8 + size]
        yield headers, block


RECORDS = "origin string, number int, total long, type string, uri string, digest string, refers_to string, block binary"
RECORDS_ARROW = pa.schema([("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()), ("type", pa.string()), ("uri", pa.string()), ("digest", pa.string()), ("refers_to", pa.string()), ("block", pa.binary())])


def _archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz").load(path).select("content")


def _records_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for data in batch.column(0):
            for h, block in parse_archive(data.as_py()):
                number, total = h.get("WARC-Segment-Number"), h.get("WARC-Segment-Total-Length")
                origin = h.get("WARC-Segment-Origin-ID", h["WARC-Record-ID"])
                yield origin, number and int(number), total and int(total), h["WARC-Type"], h.get("WARC-Target-URI"), h.get("WARC-Payload-Digest"), h.get("WARC-Refers-To"), block


def read_records(spark: SparkSession, path: str, segmented: bool | None = None) -> DataFrame:
    """One row per record of the archives below ``path``; ``number`` is null for records in one piece. ``segmented``: only those in several, or in one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for r in _records_of(batches) if segmented is None or segmented == (r[1] is not None))
        yield from _by_bytes(RECORDS_ARROW, rows, lambda r: len(r[-1]))

    return _archives(spark, path).mapInArrow(run, RECORDS)


def reassembled(records: DataFrame) -> DataFrame:
    """Whole records: segments joined in the order of their numbers.

    Fails if numbers are missing or repeated or if the lengths do not add up to the stated total.
    """
    whole = records.where("number IS NULL").select("origin", "type", "uri", "digest", "refers_to", "block")
    first = lambda c: F.max(F.when(F.col("number") == 1, F.col(c))).alias(c)
    parts = (
        records.where("number IS NOT NULL").groupBy("origin")
        .agg(first("type"), first("uri"), first("digest"), first("refers_to"), F.max("total").alias("total"),
             F.sort_array(F.collect_list(F.struct("number", "block"))).alias("parts"))
    )
    numbers = F.transform("parts", lambda p: p["number"])
    length = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + F.octet_length(p["block"]))
    good = numbers.eqNullSafe(F.sequence(F.lit(1), F.size("parts"))) & length.eqNullSafe(F.col("total"))
    # joined in one call: adding one part after the other would copy a long block once per part
    block = F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["block"])), ""))
    failed = F.raise_error(F.concat(F.lit("segments are missing or lengths differ: "), "origin")).cast("binary")
    return whole.unionByName(parts.select("origin", "type", "uri", "digest", "refers_to", F.when(good, block).otherwise(failed).alias("block")))


PAGES = "page_id long, uri string, type string, stated string, refers_to long, bytes long, payload binary"
PAGES_ARROW = pa.schema([("page_id", pa.int64()), ("uri", pa.string()), ("type", pa.string()), ("stated", pa.string()), ("refers_to", pa.int64()), ("bytes", pa.int64()), ("payload", pa.binary())])


def page_of(origin: str, kind: str, uri: str, digest: str, refers_to: str | None, block: bytes, payloads: bool) -> tuple:
    """The page of a whole record: HTTP header cut off, transfer framing decoded, digest compared with the stated one."""
    head, _, body = block.partition(b"\r\n\r\n")
    page, payload = origin.split(":")[2], None
    if kind == "response":
        payload = dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body
        if "sha1:" + hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"{origin} has another payload than its digest says")
    size = None if payload is None else len(payload)
    return int(page) if page else None, uri, kind, digest.removeprefix("sha1:"), refers_to and int(refers_to[13:-1]), size, payload if payloads else None


def _page_batches(rows: Iterator[tuple], payloads: bool) -> Iterator[pa.RecordBatch]:
    return _by_bytes(PAGES_ARROW, (page_of(*r, payloads) for r in rows), lambda p: len(p[-1] or b""))


def decoded(records: DataFrame, payloads: bool = True) -> DataFrame:
    """Pages of whole records. A revisit has no payload of its own (null); without ``payloads`` only their lengths are given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (tuple(v.as_py() for v in values) for batch in batches for values in zip(*batch.columns))
        yield from _page_batches(rows, payloads)

    return records.select("origin", "type", "uri", "digest", "refers_to", "block").mapInArrow(run, PAGES)


def read_pages(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All pages of the archives below ``path``. Records in one piece are decoded where they are read, the others once their segments have met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((origin, *rest) for origin, number, _, *rest in _records_of(batches) if number is None)
        yield from _page_batches(rows, payloads)

    whole = _archives(spark, path).mapInArrow(run, PAGES)
    return whole.unionByName(decoded(reassembled(read_records(spark, path, segmented=True)), payloads))


def round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Archive ``pages`` (page_id, url, html) and read them back: one row per page.

    A null html is an empty payload. A page_id may be null or repeat; of equal large payloads all rows that carry the largest
    id are responses, rows without an id are revisits. Other columns are not archived.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    picked = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("uri"), payload.alias("payload"))
    write_archives(deduplicated(picked), path)
    slim = materialize(read_pages(spark, path, payloads=False).drop("payload").withColumnRenamed("bytes", "own_bytes"), "warc-pages")
    lengths = slim.where("type = 'response'").groupBy(F.col("stated").alias("of")).agg(F.max("own_bytes").alias("bytes"))
    revisits = slim.where("type = 'revisit'").join(lengths, F.col("stated") == F.col("of"), "left")
    columns = ["page_id", F.col("uri").alias("url"), F.col("stated").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to"]
    responses = slim.where("type = 'response'").select(F.col("own_bytes").alias("payload_bytes"), *columns)
    return responses.unionByName(revisits.select(F.col("bytes").alias("payload_bytes"), *columns)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"
    )
