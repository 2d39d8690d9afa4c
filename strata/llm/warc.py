"""WARC archives as a chunked record table.

``write_archive`` turns every page into one WARC/1.1 record and stores the
record's byte stream as rows (archive, record_no, chunk_no, data, ...) of at
most CHUNK_BYTES. The data of one archive in (record_no, chunk_no) order is a
valid WARC file. Each chunk row carries the SHA-256 of the payload up to its
end, so a reader can stop, resume and verify anywhere, and neither side ever
builds a whole record: the writer slices the payload, the reader feeds chunk
after chunk to one running digest.

``read_records`` parses the stored stream back: headers, payload length,
payload digest, revisit references; it raises on a digest that does not match.

Defined results: null payload is empty; of equal payloads of at least
MIN_REVISIT_BYTES the smallest page_id is the response and the others revisit
it; rows that repeat that page_id and payload are captures of the same page
and are responses too; a null page_id ranks after all others; a null url
leaves out the target header; control characters in a url are
percent-encoded; an empty table gives an empty archive; extra columns are not
archived.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored

CHUNK_BYTES = 64 * 1024
MIN_REVISIT_BYTES = 100
#: Revisit decisions are broadcast up to this many rows (32 bytes each), else joined by shuffle.
BROADCAST_ROWS = 500_000
_FLUSH_BYTES = 4 << 20
_BLANK = b"\r\n\r\n"
_URN = "urn:page:"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CHUNKS = ("archive int, record_no long, chunk_no int, page_id string, data binary, "
          "payload_end long, payload_sha256 string")
RECORDS = ("page_id string, payload_bytes long, payload_digest string, record_type string, "
           "refers_to string, target_uri string, n_chunks int")


def _target(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def _head(page_id: str | None, url: str | None, digest: str, size: int,
          refers_to: str | None) -> bytes:
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {size}\r\n\r\n").encode()
    kind = "response" if refers_to is None else "revisit"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{_URN}{page_id or ''}>"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_target(url)}")
    lines.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{_URN}{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response",
              f"Content-Length: {len(http) + (size if refers_to is None else 0)}"]
    return "\r\n".join(lines).encode() + _BLANK + http


def _chunks(head: bytes, payload: memoryview, size: int) -> Iterator[tuple[bytes, int, str]]:
    """Chunk data, payload bytes so far and their digest; the record ends with a blank line."""
    running = hashlib.sha256()
    at = min(size, max(0, CHUNK_BYTES - len(head)))
    running.update(payload[:at])
    data = head + payload[:at]
    while at < size:
        yield data, at, running.hexdigest()
        end = min(size, at + CHUNK_BYTES)
        data = bytes(payload[at:end])
        running.update(data)
        at = end
    yield data + _BLANK, at, running.hexdigest()


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    archive, record_no = TaskContext.get().partitionId(), 0
    names = [f.split()[0] for f in CHUNKS.split(", ")]
    types = [pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.binary(), pa.int64(), pa.string()]
    rows: list[tuple] = []
    held = 0

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    for batch in batches:
        page_ids, urls, payloads, digests, refers = batch.columns
        for page_id, url, digest, ref, i in zip(page_ids.to_pylist(), urls.to_pylist(),
                                                digests.to_pylist(), refers.to_pylist(),
                                                range(len(batch))):
            whole = memoryview(payloads[i].as_buffer())
            head = _head(page_id, url, digest, len(whole), ref)
            body = whole if ref is None else whole[:0]
            for n, (data, end, so_far) in enumerate(_chunks(head, body, len(body))):
                rows.append((archive, record_no, n, page_id, data, end, so_far))
                held += len(data)
                if held >= _FLUSH_BYTES:
                    yield flush()
                    rows, held = [], 0
            record_no += 1
    if rows:
        yield flush()


def write_archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html") -> DataFrame:
    """Archive every row of ``pages``; returns the stored chunk table."""
    payload = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8")
    page = F.col(id_col)
    narrow = pages.select(page.alias("page_id"), F.octet_length(payload).alias("size"),
                          F.sha2(payload, 256).alias("digest"))
    long_enough = narrow.filter(F.col("size") >= MIN_REVISIT_BYTES)
    firsts = (long_enough.groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
              .filter("n > 1 AND first IS NOT NULL").select("digest", "first"))
    revisits = stored(long_enough.join(firsts, "digest")
                      .filter(~F.col("page_id").eqNullSafe(F.col("first")))
                      .select(F.col("page_id").alias("revisit_id"), F.col("digest").alias("d"),
                              F.col("first").cast("string").alias("refers_to")).distinct(),
                      "warc-revisits")
    side = F.broadcast(revisits) if revisits.count() <= BROADCAST_ROWS else revisits
    records = pages.select(page.alias("page_id"), F.col(url_col).cast("string").alias("url"),
                           payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    records = records.join(side, records.page_id.eqNullSafe(side.revisit_id)
                           & (records.digest == side.d), "left")
    return stored(records.select(F.col("page_id").cast("string"), "url", "payload", "digest",
                                 "refers_to").mapInArrow(_write, CHUNKS), "warc-archive")


class _Record:
    """Streaming parse of one record: headers first, then a running payload digest."""

    def __init__(self) -> None:
        self.head = b""
        self.fields: dict[str, str] | None = None
        self.left = 0
        self.digest = hashlib.sha256()
        self.n_chunks = 0

    def feed(self, data: bytes) -> None:
        self.n_chunks += 1
        if self.fields is None:
            self.head += data
            parts = self.head.split(_BLANK, 2)
            if len(parts) < 3:
                return
            warc, http, data = parts
            self.fields = self._parse(warc)
            self.http = self._parse(http)
            self.left = int(self.fields["content-length"]) - len(http) - len(_BLANK)
            self.size, self.head = self.left, b""
        body = data[:self.left]
        self.digest.update(body)
        self.left -= len(body)

    @staticmethod
    def _parse(block: bytes) -> dict[str, str]:
        pairs = (line.partition(": ") for line in block.decode().split("\r\n")[1:])
        return {k.lower(): v for k, _, v in pairs}

    def row(self) -> tuple:
        f = self.fields
        if f is None or self.left:
            raise ValueError("truncated WARC record")
        stated = f["warc-payload-digest"].removeprefix("sha256:")
        revisit = f["warc-type"] == "revisit"
        if not revisit and stated != self.digest.hexdigest():
            raise ValueError(f"payload digest mismatch in {f['warc-record-id']}")
        page = f["warc-record-id"][1 + len(_URN):-1] or None
        refers = f["warc-refers-to"][1 + len(_URN):-1] if revisit else None
        size = int(self.http["content-length"]) if revisit else self.size
        return (page, size, stated, f["warc-type"], refers, f.get("warc-target-uri"),
                self.n_chunks)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in RECORDS.split(", ")]
    types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(),
             pa.int32()]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    record, key = _Record(), None
    for batch in batches:
        rows = []
        for archive, number, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                         batch.column(3)):
            if (archive, number) != key:
                if key is not None:
                    rows.append(record.row())
                record, key = _Record(), (archive, number)
            record.feed(data.as_py())
        if rows:
            yield out(rows)
    if key is not None:
        yield out([record.row()])


def read_records(chunks: DataFrame) -> DataFrame:
    """One row per record, parsed and verified from the chunk rows in stream order."""
    ordered = (chunks.select("archive", "record_no", "chunk_no", "data")
               .repartition("archive", "record_no")
               .sortWithinPartitions("archive", "record_no", "chunk_no"))
    return ordered.mapInArrow(_read, RECORDS)


def export_archive(chunks: DataFrame, archive: int, path: str) -> None:
    """Write one archive as a plain .warc file, streaming one chunk at a time."""
    spark: SparkSession = chunks.sparkSession
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
    try:
        rows = chunks.filter(F.col("archive") == archive).orderBy("record_no", "chunk_no")
        for row in rows.select("data").toLocalIterator():
            stream.write(bytearray(row.data))
    finally:
        stream.close()
