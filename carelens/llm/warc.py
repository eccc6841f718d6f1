"""Web archives of individually compressed records that share a dictionary stored in the file itself."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.llm.common import batch, parts, ship, utf8
from carelens.sources.staging import new_folder, stage

# Fixed values of the archive format: a skippable frame of this number holds the dictionary.
DICTIONARY_FRAME = 0x184D2A5D
ZSTD_FRAME = 0xFD2FB528
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

DICTIONARY_BYTES = 64 * 1024
SAMPLE_BYTES = 2 * 1024 * 1024  # of a file's first records, to build its dictionary from
FILE_BYTES = 64 * 1024 * 1024  # payload after which a task begins its next file
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"

FILES = pa.schema([("path", pa.string()), ("records", pa.int64())])
RECORDS = pa.schema(
    [
        ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()),
    ]
)


def _header_value(text: str) -> str:
    """A URL as one header line: control and other unsafe characters percent-encoded."""
    return quote(text, safe="!#$%&'()*+,/:;=?@[]~-._")


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def make_record(page_id, url, payload: bytes, refers_to, refers_url) -> bytes:
    """One record: a response with its payload, or a revisit of another page's without."""
    digest = hashlib.sha1(payload).hexdigest()
    block = HTTP if refers_to is not None else HTTP + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers_to is not None else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id, digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header_value(url)}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, digest)}", f"X-Refers-To-Page: {refers_to}"]
        if refers_url is not None:
            lines.append(f"WARC-Refers-To-Target-URI: {_header_value(refers_url)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def make_dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on the records; where there are too few to train on, their bytes themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records, k=512, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(records)[-DICTIONARY_BYTES:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class _Writer:
    """One archive file: the dictionary is built from the first records, then all go out one frame each."""

    def __init__(self, folder: str):
        self.fs, base = pafs.FileSystem.from_uri(folder)
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.zst"  # unknown to readers until the task ends well
        self.out = self.fs.open_output_stream(f"{base}/{self.path.rpartition('/')[2]}")
        self.waiting: list[bytes] = []
        self.size = self.records = 0
        self.packer = None

    def add(self, record: bytes) -> None:
        self.waiting.append(record)
        self.size += len(record)
        self.records += 1
        if self.packer is None and self.size < SAMPLE_BYTES:
            return
        self.flush()

    def flush(self) -> None:
        if self.packer is None:
            dictionary = make_dictionary(self.waiting)
            raw = dictionary.as_bytes()
            self.out.write(struct.pack("<II", DICTIONARY_FRAME, len(raw)) + raw)
            self.packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary)
        for r in self.waiting:
            self.out.write(self.packer.compress(r))
        self.waiting = []

    def close(self) -> tuple[str, int]:
        self.flush()
        self.out.close()
        return self.path, self.records


def _write(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    writer = None
    for b in (part for whole in batches for part in parts(whole, 2)):
        ids, urls, payloads, targets, target_urls = (b.column(i) for i in range(5))
        for page, url, payload, to, to_url in zip(
            ids.to_pylist(), urls.to_pylist(), utf8(payloads), targets.to_pylist(), target_urls.to_pylist()
        ):
            writer = writer or _Writer(folder)
            writer.add(make_record(page, url, payload, to, to_url))
            if writer.size >= FILE_BYTES:
                yield batch(FILES, *([x] for x in writer.close()))
                writer = None
    if writer:
        yield batch(FILES, *([x] for x in writer.close()))


def read_records(stream) -> Iterator[tuple[dict, bytes]]:
    """Headers and block of every record of an open archive, one frame in memory at a time."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICTIONARY_FRAME:
        raise ValueError("the archive has no leading dictionary frame")
    opener = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(stream.read(size)))
    rest = b""
    while True:
        frame, parts = opener.decompressobj(), []
        while not frame.eof:
            rest = rest or stream.read(1 << 20)
            if not rest:
                if parts:
                    raise ValueError("the archive ends within a record")
                return
            parts.append(frame.decompress(rest))
            rest = frame.unused_data if frame.eof else b""
        head, _, tail = b"".join(parts).partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError("not a record")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        yield fields, tail[: int(fields["Content-Length"])]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = lambda x: None if x is None else int(x)
    for b in batches:
        for path in b.column(0).to_pylist():
            fs, base = pafs.FileSystem.from_uri(path)
            with fs.open_input_stream(base) as stream:
                rows = []
                for fields, block in read_records(stream):
                    kind, length = fields["WARC-Type"], int(fields["X-Payload-Length"])
                    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    if kind == "response":
                        payload = block[len(HTTP) :]
                        if len(payload) != length or hashlib.sha1(payload).hexdigest() != digest:
                            raise ValueError(f"payload of {fields['WARC-Record-ID']} in {path} is damaged")
                    rows.append((number(fields.get("X-Page-Id")), length, digest, kind, number(fields.get("X-Refers-To-Page")), fields.get("WARC-Target-URI")))
                    if len(rows) == 5000:
                        yield batch(RECORDS, *zip(*rows))
                        rows = []
                if rows:
                    yield batch(RECORDS, *zip(*rows))


# Schemes as Spark names them, and as the file library here does.
SCHEMES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "gcs": "gs", "abfs": "abfs", "abfss": "abfss"}


def _as_uri(folder: str) -> str:
    """The folder as the file library names it; a store it does not know is refused before anything is written."""
    if not re.match(r"[a-z][a-z0-9+.-]*:/", folder):
        return f"file://{folder}"
    scheme, _, rest = folder.partition(":")
    if scheme not in SCHEMES:
        raise ValueError(f"archives cannot be written to {scheme}: stores; use one of {', '.join(sorted(SCHEMES))}")
    return f"{SCHEMES[scheme]}:{rest}"


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 1000, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write a record per row into ``folder``, a URI all executors reach; returns path and records of each file.

    Of rows with equal payloads (by SHA-1) of at least ``least_bytes``, the one with the largest key is a
    response and the others revisit it; smaller payloads are all responses.  A dictionary is built for each file
    from its first records (2 MB), stored in a leading skippable frame; every record is a frame of its own.

    Only digests are shuffled, and repeated payloads' digests joined back; a payload that fills a third of the table
    is one row on that side.  A missing payload is empty, a missing URL has no header, a row without key is never
    revisited nor a revisit.  Rows that repeat the largest key are all responses.  No rows give no files; a file
    appears in the result only when its task has ended, so a lost task's files are never read.
    """
    spark = pages.sparkSession
    ship(spark)
    rows = pages.select(F.col(key).cast("long").alias("_page"), F.col(url).alias("_url"), F.coalesce(F.col(payload), F.lit("")).alias("_payload"))
    rows = rows.withColumn("_sha1", F.when(F.octet_length("_payload") >= least_bytes, F.sha1(F.encode("_payload", "UTF-8"))))
    repeated = stage(
        rows.where("_sha1 IS NOT NULL AND _page IS NOT NULL")
        .groupBy("_sha1")
        .agg(F.max("_page").alias("_to"), F.max_by("_url", "_page").alias("_to_url"), F.min("_page").alias("_least"))
        .where("_least < _to"),
        "repeated",
    ).drop("_least")
    linked = rows.join(repeated, "_sha1", "left")
    earlier = F.col("_page") < F.col("_to")
    linked = linked.select("_page", "_url", "_payload", F.when(earlier, F.col("_to")).alias("_to"), F.when(earlier, F.col("_to_url")).alias("_to_url"))
    target = _as_uri(folder)
    make_folder(target)
    return linked.mapInArrow(lambda it: _write(it, target), "path string, records long")


def make_folder(uri: str) -> None:
    fs, base = pafs.FileSystem.from_uri(uri)
    fs.create_dir(base, recursive=True)


def read_archives(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Rows of the archives named in ``path``: page_id, payload_bytes, payload_digest, record_type, refers_to, url.

    Payloads are unpacked and checked against their digests; a damaged one ends the job.  ``url`` is as written,
    with unsafe characters percent-encoded.
    """
    ship(spark)
    return files.select("path").mapInArrow(
        _read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
    )


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages into the shared folder, keep the list of files, and read them back."""
    spark = pages.sparkSession
    folder = f"{new_folder(spark)}/warc"
    files = stage(write_archives(pages, folder), "files")
    count = files.count()  # one row per file
    return read_archives(spark, files.repartition(max(1, min(count, 4096))))
