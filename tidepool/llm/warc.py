"""WARC archives through a chunked record table.

A payload travels as rows (record, chunk number, data) of at most
``chunk_bytes`` each. Every row carries the SHA-1 of the payload up to its own
end, so the last row of a record has the digest of all of it and no step ever
joins a payload together again: the writer streams the rows of a record into
one gzip member, the reader streams the member back into rows.

Archives are written by the executors through ``pyarrow.fs`` below the shared
checkpoint folder. A file counts once its task has returned its name, so a
file that a lost or repeated task left behind is never read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import in_batches, partitions, utf8_values
from tidepool.session import materialize, scratch_path

CHUNK_BYTES = 1 << 20
FILE_BYTES = 64 << 20
READ_BYTES = 256 << 10

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:x-record:"


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


# ---- rows -------------------------------------------------------------------

def payload_chunks(records: DataFrame, id_col: str, uri_col: str, payload_col: str,
                   chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunked record table of a table of payloads.

    Columns: ``record`` (a number for each input row), ``id``, ``uri`` (on
    chunk 0), ``chunk``, ``start``, ``payload_bytes`` (of the whole payload),
    ``sha1`` (of the payload up to the end of this chunk), ``last`` and
    ``data`` (Zstandard). An empty or null payload is one chunk of no bytes.
    Checkpoint the result before it is read twice: ``record`` is only fixed then.
    """
    schema = pa.schema([("record", pa.int64()), ("id", pa.string()), ("uri", pa.string()),
                        ("chunk", pa.int32()), ("start", pa.int64()), ("payload_bytes", pa.int64()),
                        ("sha1", pa.binary()), ("last", pa.bool_()), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        number = TaskContext.get().partitionId() << 40

        def rows():
            nonlocal number
            for batch in batches:
                heads = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                            utf8_values(batch.column(2)), strict=True)
                for key, uri, payload in heads:
                    number += 1
                    size, digest = len(payload), hashlib.sha1()
                    for k, start in enumerate(range(0, max(size, 1), chunk_bytes)):
                        part = payload[start:start + chunk_bytes]
                        digest.update(part)
                        yield (number, key, None if k else uri, k, start, size, digest.digest(),
                               start + chunk_bytes >= size, pack(part))

        yield from in_batches(rows(), schema, weight=lambda r: len(r[8]))

    return records.select(F.col(id_col).cast("string"), F.col(uri_col).cast("string"),
                          F.col(payload_col).cast("string")).mapInArrow(
        run, "record bigint, id string, uri string, chunk int, start bigint, payload_bytes bigint, "
             "sha1 binary, last boolean, data binary")


def revisits(chunks: DataFrame, id_type: str, min_bytes: int = 0) -> DataFrame:
    """Per record ``record, digest, refers_to``: null for responses, else the response's id.

    Of records with equal payloads of at least ``min_bytes``, the one with the
    largest id (compared as ``id_type``) is the response.
    """
    whole = chunks.where("last").select("record", "id", "payload_bytes", F.col("sha1").alias("digest"))
    best = F.max(F.struct(F.col("id").cast(id_type).alias("k"), "record", "id"))
    groups = materialize(
        whole.where(F.col("payload_bytes") >= min_bytes).groupBy("digest", "payload_bytes")
        .agg(best.alias("best"), F.count("*").alias("n")).where("n > 1").drop("n"))
    return whole.join(groups, ["digest", "payload_bytes"], "left").select(
        "record", "digest",
        (F.col("best").isNotNull() & (F.col("best.record") != F.col("record"))).alias("revisit"),
        F.col("best.id").alias("refers_to"))


# ---- writing ----------------------------------------------------------------

def open_folder(uri: str):
    """File system and path of a folder's URI, on the executor that calls it."""
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "file://" + uri[5:].replace("//", "/") if not uri.startswith("file:///") else uri
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def _urn(key: str | None) -> str:
    return f"<{URN}{quote(key or '', safe='')}>" if key is not None else f"<{URN[:-1]}>"


def _key(urn: str | None) -> str | None:
    return unquote(urn[1 + len(URN):-1]) if urn and urn.startswith(f"<{URN}") else None


def _head(kind: str, fields: Iterable[tuple[str, str | None]], length: int) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}"]
    lines += [f"{k}: {v}" for k, v in fields if v is not None]
    lines += [f"Content-Length: {length}", "", ""]
    return "\r\n".join(lines).encode()


class ArchiveWriter:
    """Appends records, each its own gzip member, to files of about ``file_bytes``."""

    def __init__(self, folder: str, date: str, file_bytes: int):
        self.fs, self.path = open_folder(folder)
        self.folder, self.date, self.file_bytes = folder, date, file_bytes
        self.out, self.done = None, []
        self.fs.create_dir(self.path, recursive=True)

    def _open(self) -> None:
        self.name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        self.out = self.fs.open_output_stream(f"{self.path}/{self.name}", compression=None)
        self.bytes = self.records = 0
        self.begin()
        self.write(_head("warcinfo", [("WARC-Record-ID", f"<{uuid.uuid4().urn}>"),
                                      ("WARC-Date", self.date),
                                      ("Content-Type", "application/warc-fields")], 18))
        self.write(b"format: WARC/1.1\r\n")
        self.end()

    def begin(self) -> None:
        self.gz = zlib.compressobj(1, zlib.DEFLATED, 31)

    def write(self, data: bytes) -> None:
        part = self.gz.compress(data)
        self.bytes += len(part)
        self.out.write(part)

    def end(self) -> None:
        part = self.gz.compress(b"\r\n\r\n") + self.gz.flush()
        self.bytes += len(part)
        self.out.write(part)

    def start(self, key, uri, size: int, digest: bytes, revisit: bool, refers_to) -> None:
        if self.out is None:
            self._open()
        http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                f"Content-Length: {size}\r\n\r\n").encode()
        fields = [("WARC-Record-ID", _urn(key)), ("WARC-Date", self.date),
                  ("WARC-Target-URI", quote(uri, safe=":/?#[]@!$&'()*+,;=%") if uri else None),
                  ("WARC-Payload-Digest", f"sha1:{base32(digest)}"),
                  ("Content-Type", "application/http; msgtype=response")]
        if revisit:
            fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _urn(refers_to))]
        self.begin()
        self.write(_head("revisit" if revisit else "response", fields,
                         len(http) + (0 if revisit else size)) + http)

    def finish(self) -> None:
        self.end()
        self.records += 1
        if self.bytes >= self.file_bytes:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((f"{self.folder}/{self.name}", self.records, self.bytes))
            self.out = None


def write_archives(records: DataFrame, id_col: str, uri_col: str, payload_col: str,
                   folder: str | None = None, min_bytes: int = 0, chunk_bytes: int = CHUNK_BYTES,
                   file_bytes: int = FILE_BYTES, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Writes every row as a WARC record and returns the files: ``file, records, bytes``.

    Rows with equal payloads become one response (the largest id) and revisits
    of it. Defined cases: a null payload is an empty one; a null id is the
    smallest id and has a bare URN; of repeated rows with the largest id one
    is the response; an empty table writes no file; other columns are ignored.
    """
    spark = records.sparkSession
    folder = folder or scratch_path(spark, "warc")
    id_type = records.schema[id_col].dataType.simpleString()
    chunks = materialize(payload_chunks(records, id_col, uri_col, payload_col, chunk_bytes))
    # A record's chunks come from one task in order, and a join on the record
    # keeps them together; the sort puts them in order again.
    rows = (chunks.join(materialize(revisits(chunks, id_type, min_bytes)), "record")
            .where("not revisit or chunk = 0")
            .select("record", "chunk", "id", "uri", "payload_bytes", "last", "digest", "revisit",
                    "refers_to", F.when(~F.col("revisit"), F.col("data")).alias("data"))
            .sortWithinPartitions("record", "chunk"))

    schema = pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, unpack = None, zstandard.ZstdDecompressor()
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[:-1]]
            for i, (_, chunk, key, uri, size, last, digest, revisit, refers) in enumerate(
                    zip(*columns, strict=True)):
                writer = writer or ArchiveWriter(folder, date, file_bytes)
                if chunk == 0:
                    writer.start(key, uri, size, digest, revisit, refers)
                if not revisit:
                    writer.write(unpack.decompress(batch.column(9)[i].as_buffer(), max_output_size=chunk_bytes))
                if last or revisit:
                    writer.finish()
        if writer:
            writer.close()
            yield from in_batches(writer.done, schema)

    return materialize(rows.mapInArrow(run, "file string, records bigint, bytes bigint"))


# ---- reading ----------------------------------------------------------------

def _members(stream) -> Iterator[Iterator[bytes]]:
    """Each gzip member of a stream as an iterator of its decompressed parts."""
    rest = stream.read(READ_BYTES)
    while rest:
        gz = zlib.decompressobj(31)

        def parts(gz=gz):
            nonlocal rest
            while not gz.eof:
                data = rest or stream.read(READ_BYTES)
                if not data:
                    raise ValueError("an archive ends inside a record")
                part = gz.decompress(data, READ_BYTES)
                rest = gz.unused_data if gz.eof else gz.unconsumed_tail
                if part:
                    yield part

        yield (member := parts())
        for _ in member:  # what the caller left
            pass
        rest = rest or stream.read(READ_BYTES)


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def _until(parts: Iterator[bytes], buffer: bytes, mark: bytes = b"\r\n\r\n") -> tuple[bytes, bytes]:
    while mark not in buffer:
        buffer += next(parts)
    head, _, rest = buffer.partition(mark)
    return head, rest


def _record_rows(parts: Iterator[bytes], chunk_bytes: int, with_data: bool) -> Iterator[tuple]:
    head, rest = _until(parts, b"")
    fields = _fields(head)
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        return
    http, rest = _until(parts, rest)
    size = int(_fields(http)["content-length"])
    key, refers = _key(fields["warc-record-id"]), _key(fields.get("warc-refers-to"))
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    common = (key, fields.get("warc-target-uri"), kind, refers, size)
    if kind == "revisit":
        yield (*common, 0, 0, digest, True, None)
        return
    if int(fields["content-length"]) != len(http) + 4 + size:
        raise ValueError(f"record {key}: the block's length does not fit its payload")
    seen, sha1, chunk, left = 0, hashlib.sha1(), 0, rest
    while True:
        want = min(chunk_bytes, size - seen)
        held = bytearray(left[:want])
        left = left[want:]
        while len(held) < want:
            left = next(parts)
            take = want - len(held)
            held += left[:take]
            left = left[take:]
        sha1.update(held)
        last = seen + want >= size
        if last and base32(sha1.digest()) != digest:
            raise ValueError(f"record {key}: payload and digest differ")
        yield (*common, chunk, seen, base32(sha1.digest()), last, bytes(held) if with_data else None)
        seen, chunk = seen + want, chunk + 1
        if last:
            return


def read_archives(files: DataFrame, chunk_bytes: int = CHUNK_BYTES, with_data: bool = True) -> DataFrame:
    """The chunked record table of the archives named in ``files.file``.

    Columns: ``id, uri, record_type, refers_to, payload_bytes, chunk, start,
    digest`` (base32, of the payload up to the end of this chunk), ``last``
    and ``data`` (null without ``with_data``). A revisit is one row with the
    digest and length of the payload it stands for. A record whose payload
    does not give the digest in its header raises.
    """
    schema = pa.schema([("id", pa.string()), ("uri", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("chunk", pa.int32()),
                        ("start", pa.int64()), ("digest", pa.string()), ("last", pa.bool_()),
                        ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for name in batch.column(0).to_pylist():
                    fs, path = open_folder(name)
                    with fs.open_input_stream(path, compression=None) as stream:
                        for parts in _members(stream):
                            yield from _record_rows(parts, chunk_bytes, with_data)

        yield from in_batches(rows(), schema, weight=lambda r: len(r[9] or b""))

    files = files.select("file").repartition(partitions(files.sparkSession), "file")
    return files.mapInArrow(run, "id string, uri string, record_type string, refers_to string, "
                                 "payload_bytes bigint, chunk int, start bigint, digest string, "
                                 "last boolean, data binary")
