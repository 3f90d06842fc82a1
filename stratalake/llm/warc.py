"""WARC archives written and read as a chunked record table."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from stratalake.sources import stage

CHUNK = 1 << 16  # bytes of payload in a row, and of a file at a time
SEGMENT = 8 << 20  # bytes of an archive that are read in one piece
TASK_BYTES = 128 << 20  # bytes of archives that a reading task gets at most, as far as segments allow
REVISIT_FROM = 1000  # bytes from which equal payloads are stored once
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, start long, size long, records long"
CHUNKS = (
    "page_id long, record_type string, refers_to long, chunk_no int, payload_bytes long, running_sha1 string, "
    "payload_digest string, last boolean, payload binary"
)


def record_chunks(pages: DataFrame, revisit_from: int = REVISIT_FROM, chunk: int = CHUNK) -> DataFrame:
    """Records as rows of page and chunk number, each with at most ``chunk`` bytes of payload.

    The payload is the html in UTF-8 (null: empty). Of equal payloads of at least
    ``revisit_from`` bytes that with the largest page_id is a response; the others
    revisit it and carry no payload. Rows that repeat the largest page_id are
    responses too; where all ids are null, so are all rows.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("html"), F.sha1(payload).alias("digest"))
    size = F.octet_length("html").cast("bigint")
    kept = (
        rows.filter(size >= revisit_from)
        .groupBy(F.col("digest").alias("of_digest"))
        .agg(F.max("page_id").alias("kept_id"), F.count(F.lit(1)).alias("rows"))
        .filter("rows > 1 AND kept_id IS NOT NULL")
        .drop("rows")
    )
    revisit = F.col("kept_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept_id"))
    # Small payloads have nothing to look up and stay where they are.
    small = rows.filter(size < revisit_from).withColumns(
        {"of_digest": F.lit(None).cast("string"), "kept_id": F.lit(None).cast(rows.schema["page_id"].dataType)}
    )
    looked_up = rows.filter(size >= revisit_from).join(kept, F.col("digest") == F.col("of_digest"), "left")
    marked = looked_up.unionByName(small).select(
        "page_id",
        "url",
        "digest",
        size.alias("payload_bytes"),
        F.when(revisit, F.col("kept_id")).alias("refers_to"),
        F.when(revisit, F.lit("").cast("binary")).otherwise(F.col("html")).alias("stored"),
    )
    pieces = F.transform(
        F.sequence(F.lit(0), F.greatest(F.ceil(F.octet_length("stored") / chunk).cast("int") - 1, F.lit(0))),
        lambda k: F.substr(F.col("stored"), k * chunk + 1, F.lit(chunk)),
    )
    return marked.select(
        "page_id", "url", "digest", "payload_bytes", "refers_to", F.posexplode(pieces).alias("chunk_no", "payload")
    )


def _head(fields: dict[str, Any]) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode()


def _one_line(text: str | None) -> str | None:
    """A url as it may stand in a header."""
    return None if text is None else "".join(c if c > " " else f"%{ord(c):02X}" for c in text)


def _record_head(row: dict[str, Any]) -> bytes:
    """Headers of a record and of the HTTP response in it; the payload follows."""
    page, refers_to = row["page_id"], row["refers_to"]
    stored = row["payload_bytes"] if refers_to is None else 0
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n"
    digest = base64.b32encode(bytes.fromhex(row["digest"])).decode()
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<urn:page:{'' if page is None else page}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": _one_line(row["url"]),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Profile": None if refers_to is None else PROFILE,
        "WARC-Refers-To": None if refers_to is None else f"<urn:page:{refers_to}>",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(http) + stored,
    }
    return _head(fields) + http.encode()


def _writer(root: str, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One file for each task; its rows name stretches of whole records, each record a gzip member."""
        system, folder = fs.FileSystem.from_uri(root)
        task = TaskContext.get()
        name = f"{task.partitionId() if task else 0:05d}-{uuid.uuid4().hex}.warc.gz"
        out = member = None
        start = at = records = 0
        done: list[tuple[str, int, int, int]] = []

        def put(data: bytes) -> None:
            nonlocal at
            at += len(data)
            out.write(data)

        def end_record() -> None:
            nonlocal member, start, records
            if member is not None:
                put(member.compress(b"\r\n\r\n") + member.flush())
                member, records = None, records + 1
                if at - start >= SEGMENT:
                    done.append((name, start, at - start, records))
                    start, records = at, 0

        try:
            for batch in batches:
                for row in batch.to_pylist():
                    if out is None:
                        system.create_dir(folder, recursive=True)
                        out = system.open_output_stream(f"{folder}/{name}", compression=None)
                    if row["chunk_no"] == 0:
                        end_record()
                        member = zlib.compressobj(level, zlib.DEFLATED, 31)
                        put(member.compress(_record_head(row)))
                    put(member.compress(row["payload"]))
            if out is not None:
                end_record()
        finally:
            if out is not None:
                out.close()
        if records:
            done.append((name, start, at - start, records))
        columns = list(zip(*done, strict=True)) or [[], [], [], []]
        types = (pa.string(), pa.int64(), pa.int64(), pa.int64())
        yield pa.record_batch(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["file", "start", "size", "records"]
        )

    return run


def write_warc(chunks: DataFrame, root: str, level: int = 4) -> DataFrame:
    """Writes records into archives under ``root``, a folder that all executors reach; returns the manifest.

    Each task writes a file of its own name and streams its chunks into it, so no
    record is held whole. The manifest, a written table, lists only what tasks
    that succeeded have written: a file left by a lost executor is in no row of
    it and is never read.
    """
    return stage(chunks.mapInArrow(_writer(root, level), MANIFEST), "warc-manifest")


class _Record:
    """One record while its bytes come in: headers first, then payload in chunks with a running digest."""

    def __init__(self, chunk: int, with_payload: bool) -> None:
        self.chunk, self.with_payload = chunk, with_payload
        self.fields: dict[str, str] | None = None
        self.waiting, self.left, self.in_http = bytearray(), 0, True
        self.sha1, self.length, self.number = hashlib.sha1(), 0, 0
        self.full = 0

    def feed(self, data: bytes) -> Iterator[tuple]:
        self.waiting += data
        if self.fields is None:
            if (end := self.waiting.find(b"\r\n\r\n")) < 0:
                return
            lines = self.waiting[:end].decode().split("\r\n")[1:]
            self.fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
            self.left = int(self.fields["content-length"])
            del self.waiting[: end + 4]
        if self.in_http:
            if (end := self.waiting.find(b"\r\n\r\n")) < 0:
                return
            http = self.waiting[:end].decode()
            self.full = int(http.rpartition("Content-Length: ")[2])
            self.left -= end + 4
            del self.waiting[: end + 4]
            self.in_http = False
        while self.left > self.chunk and len(self.waiting) >= self.chunk:
            yield self._take(self.chunk, last=False)

    def finish(self) -> tuple:
        """The last chunk, when the member has ended."""
        if self.fields is None or self.in_http or len(self.waiting) < self.left:
            raise ValueError("a record ends before its content does")
        return self._take(self.left, last=True)

    def _take(self, size: int, last: bool) -> tuple:
        part = bytes(self.waiting[:size])
        del self.waiting[:size]
        self.left -= size
        self.sha1.update(part)
        self.length += size
        self.number += 1
        kind = self.fields["warc-type"]
        page = self.fields["warc-record-id"][len("<urn:page:") : -1]
        to = self.fields.get("warc-refers-to")
        claimed = base64.b32decode(self.fields["warc-payload-digest"].removeprefix("sha1:")).hex()
        running = self.sha1.hexdigest()
        if last and kind == "response" and running != claimed:
            raise ValueError(f"page {page}: the payload does not have its digest")
        return (
            int(page) if page else None,
            kind,
            int(to[len("<urn:page:") : -1]) if to else None,
            self.number - 1,
            self.length if kind == "response" else self.full,
            running,
            claimed,
            last,
            part if self.with_payload else None,
        )


def _members(stream: Any, size: int, chunk: int) -> Iterator[bytes | None]:
    """Content of the gzip members in the next ``size`` bytes, in parts; None after each member."""
    engine, left, data = zlib.decompressobj(31), size, b""
    while True:
        if not data:
            if not left:
                return
            data = stream.read(min(chunk, left))
            if not data:
                raise ValueError("an archive ends before its manifest does")
            left -= len(data)
        part = engine.decompress(data, chunk)
        data = engine.unconsumed_tail
        if part:
            yield part
        if engine.eof:
            data = engine.unused_data
            engine = zlib.decompressobj(31)
            yield None


def _reader(root: str, chunk: int, with_payload: bool):
    names = [f.strip().split()[0] for f in CHUNKS.split(",")]
    types = [
        pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.binary(),
    ]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = fs.FileSystem.from_uri(root)
        rows: list[tuple] = []
        for batch in batches:
            for part in batch.to_pylist():
                with system.open_input_file(f"{folder}/{part['file']}") as stream:
                    stream.seek(part["start"])
                    record = _Record(chunk, with_payload)
                    for data in _members(stream, part["size"], chunk):
                        if data is None:
                            rows.append(record.finish())
                            record = _Record(chunk, with_payload)
                        else:
                            rows.extend(record.feed(data))
                        if len(rows) >= 256:
                            yield batch_of(rows)
                            rows = []
        if rows:
            yield batch_of(rows)

    return run


def read_warc(manifest: DataFrame, root: str, chunk: int = CHUNK, with_payload: bool = True) -> DataFrame:
    """The archives' records as rows of page and chunk number.

    ``running_sha1`` and ``payload_bytes`` cover a record's chunks so far; the row
    marked ``last`` has those of the whole payload, which must have the digest in
    its header. For revisits both are of the payload referred to. A worker holds
    a chunk and 256 rows. Segments are dealt out one by one to as many tasks as
    their bytes need, and to all cores in any case; the number does not follow
    from the size of the manifest, which is tiny.
    """
    found = manifest.agg(F.count(F.lit(1)).alias("segments"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    cores = manifest.sparkSession.sparkContext.defaultParallelism
    tasks = min(found["segments"], max(4 * cores, -(-found["bytes"] // TASK_BYTES)))
    parts = manifest.repartition(max(1, tasks))
    return parts.mapInArrow(_reader(root, chunk, with_payload), CHUNKS)


def archive_pages(spark: SparkSession, pages: DataFrame, root: str, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """Writes all pages to archives under ``root`` and reads them back: one row for each record.

    Repeated rows are records of their own; an empty table gives none; other
    columns are not looked at. Columns: page_id, payload_bytes, payload_digest,
    record_type, refers_to.
    """
    manifest = write_warc(record_chunks(pages, revisit_from), root)
    read = read_warc(manifest, root, with_payload=False)
    return read.filter("last").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
