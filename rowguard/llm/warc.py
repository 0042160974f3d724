"""Operator 7: WARC writing and reading with segment reassembly.

Writing (DataFrame functions): every page is an HTTP response record. A payload
is sent in chunks (chunked transfer framing). A response longer than one segment
is cut into a first record and continuation records that name its id and their
segment number; the last one carries the total length. Of equal payloads of at
least ``MIN_REVISIT`` bytes the one with the largest page id is stored, the
others become revisit records that refer to it. Archives are gzip files written
by Spark into the shared folder, so any store that Spark reaches will do.

Reading: an archive is a stream of records, parsed by Content-Length; no byte of
a payload is mistaken for a separator. Unsegmented records are decoded at once;
segments are grouped by origin id, ordered by number and checked against the
total length before the chunked framing is decoded. Only segments and revisits
are shuffled. Revisits look their response up by id.

Cuts are made between code points, so every archive is valid UTF-8 text.

Defined results: null html is an empty payload; rows that repeat a page id with
equal html are written once each and read back alike (the first of equal rows
is the response, the others revisit it); a null page id is written as the id
``null`` and read back as null; an unreadable record raises an error, a segmented
response with a missing or wrong segment has verified = false.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowguard.session import ensure_checkpoint_dir

MIN_REVISIT = 1000
CHUNK_CHARS = 4096
#: code points of a record's block in one segment
SEGMENT_CHARS = 16384
#: records of one archive file
RECORDS_PER_FILE = 4000
CRLF = "\r\n"
URI = "urn:page:"

PARSED = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to string, "
          "origin string, segment int, total long, block binary, verified boolean")


def _rows(pages: DataFrame, id_col: str, html_col: str, url_col: str | None) -> DataFrame:
    url = F.col(url_col).cast("string") if url_col else F.lit(None).cast("string")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"),
                        F.regexp_replace(F.coalesce(url, F.lit("about:blank")), r"\s", "%20").alias("url"))
    payload = F.encode("html", "UTF-8")
    return rows.withColumn("bytes", F.octet_length(payload).cast("long")).withColumn("digest", F.sha1(payload))


def _cut(text: Column, size: int) -> Column:
    """Pieces of ``size`` code points, in one pass over the text."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))


def chunked(html: Column) -> Column:
    """Chunked transfer framing: pieces between code points, sizes in bytes."""
    framed = F.transform(_cut(html, CHUNK_CHARS), lambda p: F.concat(F.lower(F.hex(F.octet_length(p))), F.lit(CRLF), p, F.lit(CRLF)))
    return F.concat(F.concat_ws("", framed), F.lit("0" + CRLF + CRLF))


def records(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str | None = "url",
            segment_chars: int = SEGMENT_CHARS, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """One row per WARC record: its text without the closing blank lines.

    The newest page of each payload digest is found by an aggregation over
    digests (map-side combined, so a payload that many pages share is a row per
    task) and joined back by digest.
    """
    rows = _rows(pages, id_col, html_col, url_col).withColumn("me", F.struct("page_id", F.monotonically_increasing_id().alias("row")))
    newest = rows.filter(F.col("bytes") >= min_revisit).groupBy("digest").agg(
        F.max("me").alias("newest"), F.count(F.lit(1)).alias("copies")).filter("copies > 1").drop("copies")
    rows = rows.join(newest, "digest", "left")
    revisit = F.col("newest").isNotNull() & (F.col("me") != F.col("newest"))
    uri = lambda of: F.concat(F.lit(URI), F.coalesce(of["page_id"].cast("string"), F.lit("null")), F.lit(":"), of["row"].cast("string"))
    http = F.concat(F.lit(CRLF.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "Transfer-Encoding: chunked"]) + CRLF + CRLF))
    block = F.when(revisit, http).otherwise(F.concat(http, chunked(F.col("html"))))
    rows = rows.select("url", "digest", revisit.alias("revisit"), uri(F.col("me")).alias("name"), uri(F.col("newest")).alias("target"),
                       block.alias("block"))
    rows = rows.withColumn("total", F.octet_length("block")).withColumn("parts", _cut(F.col("block"), segment_chars)).withColumn(
        "segments", F.size("parts"))
    rows = rows.select("url", "digest", "revisit", "name", "target", "total", "segments", F.posexplode("parts").alias("segment", "part"))
    rows = rows.withColumn("segment", F.col("segment") + 1)
    own = F.concat(F.lit("<"), F.col("name"), F.when(F.col("segment") > 1, F.concat(F.lit(":"), F.col("segment"))).otherwise(""), F.lit(">"))
    kind = F.when(F.col("segment") > 1, "continuation").when(F.col("revisit"), "revisit").otherwise("response")
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit(CRLF))
    many, last = F.col("segments") > 1, F.col("segment") == F.col("segments")
    header = F.concat(
        F.lit("WARC/1.1" + CRLF), line("WARC-Type", kind), line("WARC-Record-ID", own), line("WARC-Target-URI", F.col("url")),
        line("WARC-Date", F.lit("2024-01-01T00:00:00Z")), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        F.when(F.col("revisit"), F.concat(
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            line("WARC-Refers-To", F.concat(F.lit("<"), F.col("target"), F.lit(">"))))).otherwise(""),
        F.when(many, line("WARC-Segment-Number", F.col("segment").cast("string"))).otherwise(""),
        F.when(F.col("segment") > 1, line("WARC-Segment-Origin-ID", F.concat(F.lit("<"), F.col("name"), F.lit(">")))).otherwise(""),
        F.when(many & last, line("WARC-Segment-Total-Length", F.col("total").cast("string"))).otherwise(""),
        line("Content-Length", F.octet_length("part").cast("string")), F.lit(CRLF))
    return rows.select(F.concat(header, "part").alias("value"))


def write(pages: DataFrame, path: str, **options) -> None:
    """Archives under ``path``: gzip files of whole records, each ended by two line breaks."""
    records(pages, **options).write.option("lineSep", CRLF + CRLF).option("compression", "gzip").option(
        "maxRecordsPerFile", RECORDS_PER_FILE).text(path)


# ---------------------------------------------------------------------- reading

def inflate(data: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """Pieces of bounded size of all members of a gzip file."""
    unzip, at, pending = zlib.decompressobj(31), 0, b""
    while pending or at < len(data):
        if not pending:
            pending, at = data[at:at + step], at + step
        yield unzip.decompress(pending, 4 * step)
        pending = unzip.unconsumed_tail
        if unzip.eof:
            pending, unzip = unzip.unused_data, zlib.decompressobj(31)


def stream(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header, block) of every record of a gzip archive, decompressed piece by piece."""
    pieces, buffer = inflate(data), bytearray()
    while True:
        while (end := buffer.find(b"\r\n\r\n")) < 0:
            piece = next(pieces, None)
            if piece is None:
                if buffer.strip():
                    raise ValueError("the archive ends within a header")
                return
            buffer += piece
        lines = bytes(buffer[:end]).decode().split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record begins with {lines[0][:40]!r}")
        header = dict(x.split(": ", 1) for x in lines[1:])
        close = end + 4 + int(header["Content-Length"])
        while len(buffer) < close + 4:
            piece = next(pieces, None)
            if piece is None:
                raise ValueError("the archive ends within a record")
            buffer += piece
        if buffer[close:close + 4] != b"\r\n\r\n":
            raise ValueError("a record is longer than its Content-Length")
        yield header, bytes(buffer[end + 4:close])
        del buffer[:close + 4]


def dechunk(body: bytes) -> bytes:
    """Payload of a chunked body; raises ValueError where the framing is broken."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            return b"".join(out)
        if body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("a chunk has another size than it says")
        out.append(body[at:at + size])
        at += size + 2


def payload(block: bytes) -> tuple[dict[str, str], bytes]:
    head, _, body = block.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split(CRLF)[1:])
    return fields, dechunk(body) if fields.get("Transfer-Encoding") == "chunked" and body else body


def _page(uri: str) -> int | None:
    name = uri.strip("<>").removeprefix(URI).split(":")[0]
    return None if name == "null" else int(name)


def _finish(block: bytes, digest: str | None, total: int | None) -> tuple[int, str, bool]:
    try:
        _, data = payload(block)
    except ValueError:
        return len(block), hashlib.sha1(block).hexdigest(), False
    found = hashlib.sha1(data).hexdigest()
    return len(data), found, (total is None or total == len(block)) and (digest is None or digest == found)


def read(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, n_segments, verified."""
    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in PARSED.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.bool_()]

        def flush(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for i in range(batch.num_rows):
                rows, size = [], 0
                for header, block in stream(batch.column("content")[i].as_py()):
                    digest = header.get("WARC-Payload-Digest", "sha1:").split(":", 1)[1]
                    kind, number = header["WARC-Type"], header.get("WARC-Segment-Number")
                    total = header.get("WARC-Segment-Total-Length")
                    own = header["WARC-Record-ID"]
                    if number:
                        origin = header.get("WARC-Segment-Origin-ID", own)
                        rows.append((_page(own), None, digest, "response", None, origin, int(number), total and int(total), block, None))
                    elif kind == "revisit":
                        rows.append((_page(own), None, digest, kind, header["WARC-Refers-To"], own, None, None, None, True))
                    else:
                        n, found, good = _finish(block, digest, None)
                        rows.append((_page(own), n, found, kind, None, own, None, None, None, good))
                    size += len(block) if number else 64
                    if size > 4 << 20:
                        yield flush(rows)
                        rows, size = [], 0
                if rows:
                    yield flush(rows)

    def join(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["segment"])
        total = rows[-1]["total"]
        n, found, good = _finish(b"".join(r["block"] for r in rows), rows[0]["digest"], total)
        good = good and total is not None and [r["segment"] for r in rows] == list(range(1, len(rows) + 1))
        return pa.table({"origin": [rows[0]["origin"]], "page_id": pa.array([rows[0]["page_id"]], pa.int64()), "payload_bytes": pa.array([n], pa.int64()),
                         "payload_digest": [found], "n_segments": pa.array([len(rows)], pa.int64()), "verified": [good]})

    parsed = archives.mapInArrow(parse, PARSED)
    path_of = f"{ensure_checkpoint_dir(spark).rstrip('/')}/rowguard-records-{uuid.uuid4().hex}"
    parsed.write.parquet(path_of)  # archives are read once
    parsed = spark.read.schema(parsed.schema).parquet(path_of)
    none = F.lit(None).cast("long")
    single = parsed.filter("segment IS NULL AND record_type = 'response'").select(
        "origin", "page_id", "payload_bytes", "payload_digest", F.lit(1).cast("long").alias("n_segments"), "verified")
    # segments of one origin only meet here: a response's own size bounds the group
    joined = parsed.filter("segment IS NOT NULL").select("page_id", "origin", "segment", "total", "block", F.col("payload_digest").alias("digest"))
    joined = joined.groupBy("origin").applyInArrow(join, "origin string, page_id long, payload_bytes long, payload_digest string, n_segments long, verified boolean")
    responses = single.unionByName(joined)
    revisits = parsed.filter("record_type = 'revisit'").select("page_id", F.col("payload_digest").alias("said"), "refers_to")
    # a payload that many pages share is a hot key on the left only; adaptive execution splits it
    found = responses.select(F.col("origin").alias("refers_to"), F.col("page_id").alias("first_id"), F.col("payload_bytes").alias("n"),
                             F.col("payload_digest").alias("d"), "verified")
    revisits = revisits.join(found, "refers_to", "left").select(
        "page_id", F.col("n").alias("payload_bytes"), F.coalesce("d", "said").alias("payload_digest"), F.lit("revisit").alias("record_type"),
        F.col("first_id").alias("refers_to"), F.lit(0).cast("long").alias("n_segments"),
        (F.coalesce("verified", F.lit(False)) & (F.col("d") == F.col("said"))).alias("verified"))
    return responses.select("page_id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"),
                            none.alias("refers_to"), "n_segments", "verified").unionByName(revisits)


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write all pages as archives into the shared folder and read them back."""
    spark = pages.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/rowguard-warc-{uuid.uuid4().hex}"
    write(pages, path, **options)
    return read(spark, path)
