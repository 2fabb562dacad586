"""WARC archives with per-record Zstandard frames and a shared dictionary.

Writing: a page is a ``response`` record if no page with an equal payload has a smaller
page_id, else a ``revisit`` record that refers to that page and carries no payload.
Payloads are compared by SHA-1 and length; the first page of each payload is one
partial aggregate, so a payload that a third of all pages share moves as one row per
task. A dictionary is built once from a bounded sample of the archived records.
Every archive file starts with a skippable frame that embeds the dictionary; each
record follows as a frame of its own, so one record is read with the dictionary and
its own bytes alone.

Files are written by Spark's line writer, which commits a file only when its task ends
well and works on any store. The writer puts one newline after each row; every row
therefore ends in the header of a one-byte skippable frame whose content is that newline,
and the whole file is a valid sequence of Zstandard frames. A file takes at most
``FILE_ROWS`` rows and every file begins with the dictionary, so a reader's memory is
bounded by that many records and not by the size of a task.

Reading: files by Spark's binary reader, a few megabytes of files at once; records are
decompressed one at a time, and their payload's length and digest computed anew and held
against the record's header. A revisit's length and digest come from its own headers.

Defined cases: a null payload is empty. Pages that share their smallest page_id and
payload are all responses; a null page_id counts after all others. An empty table writes
no record and reads back as no row. Extra columns are ignored; a null url is written
as an empty target.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import draw, map_arrow
from tarmac.session import scratch_root

DICTIONARY_BYTES = 64 * 1024
SAMPLE_RECORDS = 400
SAMPLE_BYTES = 16 * 1024
LEVEL = 3
FILE_ROWS = 8192  # rows of an archive file, the dictionary's included
READ_BYTES = 32 * 1024  # compressed bytes handed to the decompressor at once
# Fixed values of the archive format: frame magic numbers, and the trailing frame's header.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_MAGIC = 0x184D2A50
NEWLINE_FRAME = struct.pack("<II", SKIPPABLE_MAGIC, 1)
DATE = "2024-01-01T00:00:00Z"

RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def mark_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, sha1 and refers_to (null for responses)."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    sized = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         payload.alias("payload"))
    sized = sized.withColumns({"sha1": F.sha1("payload"), "n": F.octet_length("payload")})
    first = sized.filter(F.col("n") >= min_bytes).groupBy("sha1", "n").agg(F.min("page_id").alias("first"))
    return sized.join(first, ["sha1", "n"], "left").withColumn(
        "refers_to", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")))


def record(page_id, url, payload: bytes, sha1_hex: str, refers_to) -> bytes:
    digest = base64.b32encode(bytes.fromhex(sha1_hex)).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    name = "" if page_id is None else page_id
    head = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {' '.join((url or '').split())}",
            f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple:
    """A row of RECORDS from one record; raises if its payload digest doesn't hold."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    told = int(next(x for x in http.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    number = lambda key: int(fields[key][len("<urn:page:"):-1]) if len(fields.get(key, "")) > len("<urn:page:>") else None
    if fields["WARC-Type"] == "response" and (len(payload) != told or base32_sha1(payload) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    return number("WARC-Record-ID"), told, digest, fields["WARC-Type"], number("WARC-Refers-To")


def build_dictionary(pages: DataFrame, sample_records: int = SAMPLE_RECORDS, sample_bytes: int = SAMPLE_BYTES,
                     size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from about ``sample_records`` records (twice as many at most), each with
    ``sample_bytes`` of its payload, taken at four places of a longer one; without enough of
    them, the records' own bytes."""
    import zstandard

    rate = min(1.0, sample_records / max(1, pages.count()))
    payload, part = F.col("html").cast("binary"), sample_bytes // 4
    step = F.floor((F.octet_length(payload) - part) / 3).cast("int")
    pieces = F.concat(*[F.substring(payload, 1 + i * step, F.lit(part)) for i in range(4)])
    head = F.when(F.octet_length(payload) > sample_bytes, pieces).otherwise(payload)
    rows = (pages.filter(draw(F.struct("page_id", "url", "html"), 3) < rate).select("page_id", "url", head.alias("head"))
            .orderBy(F.xxhash64("page_id", "url", "head")).limit(2 * sample_records).collect())
    rows = sorted(rows, key=lambda r: (r["page_id"] is None, r["page_id"], r["url"] or ""))
    samples = [record(r["page_id"], r["url"], p := bytes(r["head"] or b""), hashlib.sha1(p).hexdigest(), None) for r in rows]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _dictionary(raw: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(raw) if raw else None


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, level: int = LEVEL,
                   file_rows: int = FILE_ROWS) -> None:
    """Write the pages as archive files below ``path``, ``file_rows`` rows a file."""
    dictionary = build_dictionary(pages)

    def compressed(batches):
        import zstandard

        frames = zstandard.ZstdCompressor(level=level, dict_data=_dictionary(dictionary), write_checksum=True)
        first = struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary + NEWLINE_FRAME
        row = 0
        for batch in batches:
            cols = [batch.column(n) for n in ("page_id", "url", "payload", "sha1", "refers_to")]
            out = []
            for fields in zip(*cols):
                if row % file_rows == 0:  # the writer opens a file here
                    out.append(first)
                    row += 1
                out.append(frames.compress(record(*(x.as_py() for x in fields))) + NEWLINE_FRAME)
                row += 1
            yield pa.record_batch([pa.array(out, pa.binary())], names=["value"])

    marked = mark_revisits(pages, min_bytes).select("page_id", "url", "payload", "sha1", "refers_to")
    # the line writer copies the bytes as they are
    lines = marked.transform(map_arrow, compressed, "value binary").select(F.col("value").cast("string"))
    lines.write.option("maxRecordsPerFile", file_rows).text(path, lineSep="\n")


def frames_of(raw: bytes):
    """The record frames of an archive file, decompressed one after another."""
    import zstandard

    at, reader = 0, None
    while at < len(raw):
        magic, size = struct.unpack_from("<II", raw, at)
        if SKIPPABLE_MAGIC <= magic <= SKIPPABLE_MAGIC + 15:
            if magic == DICTIONARY_MAGIC:
                reader = zstandard.ZstdDecompressor(dict_data=_dictionary(raw[at + 8:at + 8 + size]))
            at += 8 + size
            continue
        stream = (reader or zstandard.ZstdDecompressor()).decompressobj()
        out = []
        while not stream.eof:
            held = raw[at:at + READ_BYTES]
            if not held:
                raise ValueError("an archive file ends inside a record")
            out.append(stream.decompress(held))
            at += len(held)
        at -= len(stream.unused_data)
        yield b"".join(out)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row of RECORDS per archived record, payloads checked against their digests."""
    def rows(batches):
        for batch in batches:
            for raw in batch.column("content"):
                found = [parse(x) for x in frames_of(raw.as_py())]
                columns = list(zip(*found)) or [()] * 5
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)],
                                      names=[f.split()[0] for f in RECORDS.split(", ")])

    files = spark.read.format("binaryFile").load(path)
    return files.select("content").transform(map_arrow, rows, RECORDS)


def archive_round_trip(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to a new archive folder in the shared scratch folder; read it back."""
    path = f"{scratch_root(spark).rstrip('/')}/tarmac-llm/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, min_bytes)
    return read_archives(spark, path)
