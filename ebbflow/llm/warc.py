"""WARC writer with dictionary compression, and its reader.

Layout of an archive file (``.warc.zst``): a leading skippable frame (magic 0x184D2A5D) holds a Zstandard dictionary;
then follow the records, each a frame of its own compressed with that dictionary, so any record can be read alone from
its offset and length. The dictionary is trained per file on at most ``SAMPLE_BYTES`` of the records that the file
archives (spread evenly over them); if they are too few to train on, their bytes are a plain content dictionary.

Payloads of at least ``MIN_REVISIT`` bytes are stored once: of equal payloads that with the smallest page id is a
``response`` record, the others are ``revisit`` records that name it in ``WARC-Refers-To`` and keep the payload's length
and SHA-256 in their headers.

Scale: the digests of repeated payloads are found by a map-side combined aggregate over 32-byte digests, so a payload
that a third of all pages share is one row per task. That table (repeated payloads only) is written and joined back;
Spark broadcasts it when its files are small and otherwise sort-merges with skew split. Writing is narrow: each task closes a
file at ``FILE_BYTES``; files get their name by a move once whole.

Defined results: null html is the empty payload; null page ids and urls are allowed (a null id is never the smallest
unless all are null). Repeated rows of the smallest id are all responses. Every row becomes a record, however long its payload. An empty table gives no file and no row.
Columns other than the id, the url and the html are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import io
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.llm.common import as_bytes, file_system, materialize, pieces, read_files, scratch, write_file

SUFFIX = ".warc.zst"
SKIPPABLE = 0x184D2A5D
MIN_REVISIT = 100
FILE_BYTES = 16_000_000
SAMPLE_BYTES = 2_000_000
DICT_BYTES = 64 * 1024
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _page(urn: str) -> int | None:
    number = urn.removeprefix("<urn:x-page:").removesuffix(">")
    return int(number) if number else None


def _head(first: str, fields: list[tuple[str, str]]) -> bytes:
    return "\r\n".join([first, *(f"{k}: {v}" for k, v in fields), "", ""]).encode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, original: int | None, revisit: bool, date: str = DATE) -> bytes:
    """One uncompressed WARC record."""
    http = _head("HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))])
    block = http if revisit else http + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _urn(page_id)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    fields.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _urn(original))]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return _head("WARC/1.1", fields) + block + b"\r\n\r\n"


def train(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """A dictionary from an even sample of the records."""
    total = sum(map(len, records))
    step = max(1, -(-total // SAMPLE_BYTES))
    sample = [r[: DICT_BYTES * 2] for r in records[::step]]
    try:
        return zstandard.train_dictionary(DICT_BYTES, sample, k=256, d=8, f=18, accel=4)
    except zstandard.ZstdError:  # too little to train on
        return zstandard.ZstdCompressionDict(b"".join(sample)[-DICT_BYTES:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def archive(records: list[bytes], level: int = 6) -> tuple[bytes, list[tuple[int, int]]]:
    """(file, offset and length of each record's frame)."""
    dictionary = train(records)
    packed = zstandard.ZstdCompressor(level=9).compress(dictionary.as_bytes())
    compressor = zstandard.ZstdCompressor(level=level, dict_data=dictionary)
    out, places = [struct.pack("<II", SKIPPABLE, len(packed)), packed], []
    at = 8 + len(packed)
    for r in records:
        frame = compressor.compress(r)
        out.append(frame)
        places.append((at, len(frame)))
        at += len(frame)
    return b"".join(out), places


def dictionary_of(data: bytes) -> tuple[zstandard.ZstdCompressionDict, int]:
    """The dictionary of an archive file and the place of its first record."""
    magic, size = struct.unpack("<II", data[:8])
    if magic != SKIPPABLE:
        raise ValueError("no leading dictionary frame")
    return zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8 : 8 + size])), 8 + size


def read_record(data: bytes, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """One record by its place: WARC header fields and block."""
    dictionary, _ = dictionary_of(data)
    return next(_records(zstandard.ZstdDecompressor(dict_data=dictionary).decompress(data[offset : offset + length])))


def read_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """All records of a file, in order."""
    dictionary, start = dictionary_of(data)
    reader = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(io.BytesIO(data[start:]), read_across_frames=True)
    yield from _records(reader.read())


def _records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no WARC record at {at}")
        fields = dict(line.split(": ", 1) for line in lines)
        start, size = end + 4, int(fields["Content-Length"])
        yield fields, data[start : start + size]
        at = start + size + 4


def payload_of(fields: dict[str, str], block: bytes) -> tuple[int, bytes | None]:
    """(length of the full payload, the payload or None for a revisit)."""
    end = block.index(b"\r\n\r\n")
    head = dict(line.split(": ", 1) for line in block[:end].decode().split("\r\n")[1:])
    return int(head["Content-Length"]), None if fields["WARC-Type"] == "revisit" else block[end + 4 :]


def classify(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """page_id, url, html, digest, original (smallest id with this payload, null where it is not repeated)."""
    rows = pages.select(
        F.col(f"`{id_col}`").cast("bigint").alias("page_id"),
        F.col(f"`{url_col}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("html"),
    ).withColumn("digest", F.unhex(F.sha2(F.encode("html", "utf-8"), 256)))
    long = rows.filter(F.octet_length("html") >= MIN_REVISIT)
    repeated = long.groupBy("digest").agg(F.min("page_id").alias("original"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return rows.join(materialize(repeated.select("digest", "original"), "repeated-payloads"), "digest", "left")


def write_archives(pages: DataFrame, uri: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write all pages below ``uri``; returns the (written) index: page_id, file, offset, length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held = TaskContext.get().partitionId(), 0, 0
        ids, records = [], []

        def close() -> pa.RecordBatch:
            data, places = archive(records)
            name = f"part-{part:07d}-{number:07d}{SUFFIX}"
            write_file(uri, name, data)
            columns = [pa.array(ids, pa.int64()), pa.array([name] * len(ids), pa.string()), *(pa.array([p[k] for p in places], pa.int64()) for k in (0, 1))]
            return pa.RecordBatch.from_arrays(columns, ["page_id", "file", "offset", "length"])

        for batch in pieces(batches, "html", 4_000_000):
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "digest", "original")]
            for page_id, url, digest, original, payload in zip(*columns, as_bytes(batch.column("html")), strict=True):
                made = record(page_id, url, payload, digest.hex(), original, original is not None and page_id != original)
                if records and held + len(made) > FILE_BYTES:
                    yield close()
                    ids, records, held, number = [], [], 0, number + 1
                ids.append(page_id)
                records.append(made)
                held += len(made)
        if records:
            yield close()

    rows = classify(pages, id_col, url_col, html_col)
    return materialize(rows.mapInArrow(run, "page_id bigint, file string, offset bigint, length bigint"), "warc-index")


def read_archives(files: DataFrame) -> DataFrame:
    """Parse archive files (path, content); every response payload is checked against its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for fields, block in read_archive(content.as_buffer().to_pybytes()):
                    size, payload = payload_of(fields, block)
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    if payload is not None and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
                    original = _page(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None
                    rows.append((_page(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), size, digest, fields["WARC-Type"], original))
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
                names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

    return files.mapInArrow(run, "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")


def warc_report(pages: DataFrame) -> DataFrame:
    """The report of the contract, read back from freshly written archives."""
    spark = pages.sparkSession
    uri = scratch(spark, "warc")
    uri = uri if ":/" in uri else f"file://{uri}"
    system, folder = file_system(uri)
    system.create_dir(folder, recursive=True)
    write_archives(pages, uri)
    return read_archives(read_files(spark, uri, SUFFIX)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
