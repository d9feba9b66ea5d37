"""Dictionary-compressed WARC archives: writer and reader.

An archive starts with a skippable Zstandard frame that holds a dictionary, built from all records of that archive; after it every
record is a frame of its own, so any record can be read alone with the dictionary. Equal payloads are stored once: the record
with the smallest page id is a response, the others are revisits of it, without payload.

At scale: digests are grouped with partial aggregation, and only digests of several rows are joined back. A payload that a third
of all rows share makes one large key in that join; adaptive execution splits it, as the large side is the outer one. A task holds
one archive (``archive_bytes`` of payload, or one record if that is longer) in memory. Archive names are used once and the table
of the names is what readers go by, so repeated tasks leave no double records.

Defined cases: null html is an empty payload; equal page ids with equal payloads are responses all; a null page id is never the
first of its group unless all are null, and then all are responses; a null url is written as ``urn:none``; control characters in a url are
percent-encoded; an empty table gives no archive and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.llm.common import kept, new_path
from txrisk.llm.files import read_file, write_file

# Fixed values of the WARC and Zstandard formats.
_VERSION = b"WARC/1.1"
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DICTIONARY_MAGIC = 0x184D2A5D

_READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
_ID = re.compile(r"<urn:page:(-?\d*)>")


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = quote(url, safe="".join(map(chr, range(33, 127)))) if url else "urn:none"
    head = [
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [f"WARC-Profile: {_REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return _VERSION + b"\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _archive(records: list[bytes], dictionary_bytes: int, level: int) -> bytes:
    """The bytes of one archive; too few or too uniform records to train on get a raw-content dictionary."""
    total = sum(map(len, records))
    try:
        # Fixed segment and d-mer sizes: without them the library tries out many, at many times the cost.
        trained = zstandard.train_dictionary(min(dictionary_bytes, max(total // 8, 256)), records, k=512, d=8, level=level)
    except zstandard.ZstdError:
        trained = zstandard.ZstdCompressionDict(b"".join(records)[:dictionary_bytes], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    compressor = zstandard.ZstdCompressor(level=level, dict_data=trained, write_content_size=True, write_checksum=True)
    content = trained.as_bytes()
    return b"".join([struct.pack("<II", _DICTIONARY_MAGIC, len(content)), content, *map(compressor.compress, records)])


def records_of(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of an archive."""
    magic, length = struct.unpack_from("<II", archive)
    if magic != _DICTIONARY_MAGIC:
        raise ValueError("the archive doesn't start with a dictionary frame")
    dictionary = zstandard.ZstdCompressionDict(archive[8 : 8 + length])
    stream = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(archive[8 + length :], read_across_frames=True)
    text, at = stream.readall(), 0
    while at < len(text):
        end = text.index(b"\r\n\r\n", at)
        first, *lines = text[at:end].split(b"\r\n")
        if first != _VERSION:
            raise ValueError("a record doesn't start where the one before it ends")
        head = dict(line.decode().split(": ", 1) for line in lines)
        at = end + 4 + int(head["Content-Length"])
        yield head, text[end + 4 : at]
        at += 4


def write_archives(
    pages: DataFrame,
    min_bytes: int = 0,
    archive_bytes: int = 16 << 20,
    dictionary_bytes: int = 64 << 10,
    level: int = 6,
    date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Write a record for every row of ``pages`` (page_id, url, html) and return the table of archives: path, records, bytes.

    Payloads of less than ``min_bytes`` are never revisits.
    """
    spark = pages.sparkSession
    folder = new_path(spark, "warc")
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("html"))
    rows = rows.withColumn("digest", F.unhex(F.sha1(F.col("html").cast("binary"))))
    long_enough = F.octet_length("html") >= min_bytes
    firsts = (
        rows.where(long_enough)
        .groupBy(F.col("digest").alias("of_digest"))
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1")
    )
    rows = rows.join(firsts, (F.col("digest") == F.col("of_digest")) & long_enough, "left")
    rows = rows.select("page_id", "url", "html", "digest", F.expr("nullif(first_id, page_id)").alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close() -> pa.RecordBatch:
            path = write_file(folder, ".warc.zst", _archive(records, dictionary_bytes, level))
            return pa.RecordBatch.from_pydict({"path": [path], "records": [len(records)], "bytes": [size]})

        records: list[bytes] = []
        size = 0
        for batch in batches:
            for page_id, url, page, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                content = page.encode("utf-8", "surrogatepass")
                if records and size + len(content) > archive_bytes:
                    yield close()
                    records, size = [], 0
                records.append(_record(page_id, url, content, _base32(digest), refers_to, date))
                size += len(content)
        if records:
            yield close()

    return kept(rows.mapInArrow(write, "path string, records long, bytes long"), "warc-archives")


def read_archives(archives: DataFrame) -> DataFrame:
    """One row per record of the archives in ``path``; the payload of every response is held against its digest."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                for head, block in records_of(read_file(path)):
                    http, _, content = block.partition(b"\r\n\r\n")
                    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    if head["WARC-Type"] == "response" and (len(content) != size or _base32(hashlib.sha1(content).digest()) != digest):
                        raise ValueError(f"damaged payload of {head['WARC-Record-ID']} in {path}")
                    page, first = (_ID.fullmatch(head.get(k, "<urn:page:>"))[1] for k in ("WARC-Record-ID", "WARC-Refers-To"))
                    rows.append((int(page) if page else None, size, digest, head["WARC-Type"], int(first) if first else None, head["WARC-Target-URI"]))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[f.split()[0] for f in _READ.split(", ")])

    # The names take no room, so Spark would read them as one partition; every file becomes a task's work again.
    files = max(archives.count(), 1)
    return archives.select("path").repartition(min(files, 4096)).mapInArrow(read, _READ)


def archive_round_trip(spark: SparkSession, pages: DataFrame, **options: object) -> DataFrame:
    """Write all pages, then read them back."""
    return read_archives(write_archives(pages, **options))
