"""WARC archives of individually compressed records with an embedded Zstandard dictionary.

An archive is a leading skippable frame that holds the dictionary, then one Zstandard frame for
each record, so a record can be read from its offset. The dictionary is trained on the archive's own
first records (``SAMPLE_BYTES`` at most; the sample only steers compression). An archive too small to
train on has no dictionary and no such frame.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from conceptree.llm.words import small_batches
from conceptree.session import materialize, new_table_path

#: Frame that holds the dictionary, and the frames of Zstandard itself.
SKIPPABLE, FRAME = 0x184D2A5D, 0xFD2FB528
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 4 << 20
ARCHIVE_BYTES = 1 << 30
LEVEL = 6
_IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def _uri(url: str | None, page_id: int | None) -> str:
    """A header value: no white space or control characters, never empty."""
    kept = "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "")
    return kept or f"urn:page:{page_id}"


def _record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return b"WARC/1.1\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    headers = [
        ("WARC-Record-ID", _record_id(page_id, digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", _uri(url, page_id)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if page_id is not None:
        headers.append(("X-Page-Id", str(page_id)))
    head = _HTTP % len(payload)
    if refers_to is None:
        return _record("response", headers, head + payload)
    headers += [("WARC-Profile", _IDENTICAL), ("WARC-Refers-To", _record_id(refers_to, digest)), ("X-Refers-To-Page-Id", str(refers_to))]
    return _record("revisit", headers, head)


def train(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    try:
        found = zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, sum(map(len, samples)) // 10)), samples, level=LEVEL)
    except zstandard.ZstdError:  # too few or too small
        return None
    return found if len(found) else None


class ArchiveWriter:
    def __init__(self, out, samples: list[bytes], date: str):
        self.out, self.bytes, self.records = out, 0, 0
        dictionary = train(samples)
        self.dictionary_bytes = len(dictionary) if dictionary else 0
        if dictionary:
            self._put(struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary.as_bytes())
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
        about = b"format: WARC File Format 1.1\r\n"
        self.write(_record("warcinfo", [("WARC-Record-ID", _record_id(None, date)), ("WARC-Date", date), ("Content-Type", "application/warc-fields")], about))
        self.records = 0

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def write(self, record: bytes) -> None:
        self._put(self.compressor.compress(record))
        self.records += 1


def _write(folder: str, date: str):
    """Archives of a partition. A file counts only once its row is in the list of archives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pa.fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)

        def records() -> Iterator[bytes]:
            for batch in batches:
                columns = (batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to"))
                for page_id, url, payload, refers_to in zip(*columns, strict=True):
                    yield page_record(page_id, url, payload.encode(), refers_to, date)

        todo = records()
        while True:
            first, size = [], 0
            for record in todo:
                first.append(record)
                size += len(record)
                if size >= SAMPLE_BYTES:
                    break
            if not first:
                return
            name = f"{uuid.uuid4().hex}.warc.zst"
            with store.open_output_stream(f"{base}/{name}") as out:
                archive = ArchiveWriter(out, first, date)
                for record in first:
                    archive.write(record)
                del first
                while archive.bytes < ARCHIVE_BYTES and (record := next(todo, None)) is not None:
                    archive.write(record)
            row = [[f"{folder}/{name}"], [archive.records], [archive.dictionary_bytes], [archive.bytes]]
            yield pa.record_batch([pa.array(x) for x in row], ["archive", "records", "dictionary_bytes", "bytes"])

    return run


def write_pages(pages: DataFrame, folder: str, least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write a record for each row of ``pages`` (page_id, url, html) and return the archives.

    archive (its path), records, dictionary_bytes, bytes. A null html is an empty payload. Of
    records with equal payloads of at least ``least_bytes`` bytes, that with the largest page_id
    is the response and the others revisit it; rows that repeat its page_id are responses too, as
    no page revisits itself. A null page_id revisits if its payload has a page_id elsewhere. A
    null or empty url becomes ``urn:page:<page_id>``. ``folder`` is a URI that all executors
    reach. An empty table writes nothing.
    """
    small_batches(pages.sparkSession)
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"),
    ).withColumn("digest", F.sha1(F.encode("payload", "UTF-8")))
    largest = rows.groupBy("digest").agg(F.max("page_id").alias("response"))
    shared = F.octet_length("payload") >= least_bytes
    other = F.col("page_id").isNull() | (F.col("page_id") < F.col("response"))
    records = rows.join(largest, "digest").select("page_id", "url", "payload", F.when(shared & other, F.col("response")).alias("refers_to"))
    return materialize(records.mapInArrow(_write(folder, date), "archive string, records long, dictionary_bytes long, bytes long"), "archives")


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive, one after the other."""
    head = stream.read(8)
    dictionary = None
    if len(head) == 8 and (sizes := struct.unpack("<II", head))[0] == SKIPPABLE:
        data = stream.read(sizes[1])
        if data[:4] == struct.pack("<I", FRAME):  # the dictionary itself may be compressed
            data = zstandard.ZstdDecompressor().decompressobj().decompress(data)
        dictionary, head = zstandard.ZstdCompressionDict(data), b""
    plain = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(_Joined(head, stream), read_across_frames=True)
    text = io.BufferedReader(plain, 1 << 18)
    while line := text.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record starts with {line[:40]!r}")
        headers = {}
        while (line := text.readline()) not in (b"\r\n", b""):
            key, _, value = line.decode().rstrip("\r\n").partition(": ")
            headers[key] = value
        block = text.read(int(headers["Content-Length"]))
        if len(block) != int(headers["Content-Length"]) or text.read(4) != b"\r\n\r\n":
            raise ValueError("a record is cut off")
        yield headers, block


class _Joined(io.RawIOBase):
    def __init__(self, head: bytes, rest):
        self.head, self.rest = head, rest

    def read(self, n: int = -1) -> bytes:
        out, self.head = self.head, b""
        return out or self.rest.read(n)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    for batch in batches:
        for path in batch.column("archive").to_pylist():
            store, base = pa.fs.FileSystem.from_uri(path)
            rows, held = [], 0
            with store.open_input_stream(base) as stream:
                for headers, block in read_records(stream):
                    kind = headers["WARC-Type"]
                    if kind == "warcinfo":
                        continue
                    payload = block.partition(b"\r\n\r\n")[2]
                    size, digest = int(headers["X-Payload-Length"]), headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "response" and (len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()) != (size, digest):
                        raise ValueError(f"{path}: the payload of {headers['WARC-Record-ID']} is damaged")
                    ids = [int(x) if (x := headers.get(k)) else None for k in ("X-Page-Id", "X-Refers-To-Page-Id")]
                    rows.append((ids[0], size, digest, kind, ids[1], headers["WARC-Target-URI"], payload.decode() if kind == "response" else None))
                    held += len(payload)
                    if len(rows) == 1000 or held >= 4 << 20:
                        yield out(rows)
                        rows, held = [], 0
            if rows:
                yield out(rows)


def read_pages(archives: DataFrame) -> DataFrame:
    """The records of ``archives`` (archive: path): page_id, payload_bytes, payload_digest, record_type,
    refers_to, url, payload (null for a revisit). Each task streams whole archives, record by record."""
    n = max(1, archives.count())
    return archives.select("archive").repartition(n).mapInArrow(
        _read,
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload string",
    )


def new_folder(spark: SparkSession) -> str:
    return new_table_path(spark, "warc")
