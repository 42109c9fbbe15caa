"""WARC archives through a chunked record table.

A payload travels as rows of record identifier and chunk number; writer and
reader handle one chunk at a time, carrying the record's running digest, so no
Python step holds a whole record.  Each task writes one archive of gzip
members (one per record) below a shared folder and returns the spans it wrote:
``(path, offset, length)``.  Those rows are the commit: they are checkpointed,
and a file of a lost or repeated attempt is in no row and never read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kardex.llm.common import cut, shared_dir

CHUNK = 64 << 10
#: Compressed bytes of one span, the unit of reading.
SPAN = 4 << 20
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


def chunk_table(records: DataFrame, payload: str, chunk_bytes: int = CHUNK) -> DataFrame:
    """Replaces the binary column ``payload`` by rows ``chunk, data, last``, in
    order; an empty or null payload has one empty chunk."""
    body = F.coalesce(F.col(payload), F.lit(b""))
    last = F.greatest(F.lit(0), F.floor((F.octet_length(body) - 1) / chunk_bytes)).cast("int")
    keep = [c for c in records.columns if c != payload]
    return records.withColumn("__last", last).select(
        *keep, "__last", F.explode(F.sequence(F.lit(0), F.col("__last"))).alias("chunk"), body.alias("__body")).select(
        *keep, "chunk", F.substring("__body", F.col("chunk") * chunk_bytes + 1, F.lit(chunk_bytes)).alias("data"),
        (F.col("chunk") == F.col("__last")).alias("last"))


def mark_revisits(records: DataFrame, least_bytes: int = 100) -> DataFrame:
    """``records(page_id, url, payload)`` -> adds ``size, digest, refers_to``.

    Of equal payloads of ``least_bytes`` or more the smallest page id is the
    response that the others refer to.  Null ids come last: they refer to it
    too.  Repeated rows of that smallest id are all responses, as are all rows
    of a payload that has null ids only.
    """
    marked = records.withColumns({"size": F.octet_length("payload").cast("long"), "digest": F.sha2("payload", 256)})
    ids = marked.where(F.col("size") >= least_bytes).select("page_id", "digest")
    # The key leaves the aggregate inside a struct: both sides of the join are
    # then shuffled, and the engine can split a digest with very many pages.
    first = (ids.groupBy("digest").agg(F.max(F.struct("digest")).alias("r"), F.min("page_id").alias("refers_to"),
                                       F.count("*").alias("n"))
             .where("n > 1").select("r.digest", "refers_to"))
    again = (ids.join(first, "digest").where("refers_to is not null and (page_id is null or page_id > refers_to)")
             .distinct().select(F.col("page_id").alias("__p"), F.col("digest").alias("__d"), "refers_to"))
    return marked.join(again, F.col("page_id").eqNullSafe(F.col("__p")) & (F.col("digest") == F.col("__d")),
                       "left").drop("__p", "__d")


def record_uri(page: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}/{digest}')}>"


def _head(row: dict, date: str) -> bytes:
    page, refers = row["page"], row["refers"]
    stored = 0 if refers is not None else row["size"]
    http = _HTTP.format(stored)
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}",
             f"WARC-Record-ID: {record_uri(page, row['digest'])}", f"WARC-Date: {date}",
             f"WARC-Payload-Digest: sha256:{row['digest']}", f"X-Payload-Length: {row['size']}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + stored}"]
    if page is not None:
        lines.append(f"X-Page-Id: {page}")
    if row["url"] is not None:
        lines.append("WARC-Target-URI: " + row["url"].replace("\r", "%0D").replace("\n", "%0A"))
    if refers is not None:
        lines += [f"WARC-Refers-To: {record_uri(refers, row['digest'])}", f"X-Refers-To-Page: {refers}",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return ("\r\n".join(lines) + "\r\n\r\n" + http).encode()


def write_archives(chunks: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", level: int = 1) -> DataFrame:
    """Writes the chunk rows ``page, url, digest, size, refers, chunk, data,
    last`` (each record's in order, in one partition); returns the spans."""
    schema = "path string, offset long, length long, records long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        task = TaskContext.get()
        place = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
        out = None
        spans, begin, at, records = [], 0, 0, 0
        packer = digest = None
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    files, path = fs.FileSystem.from_uri(place)
                    files.create_dir(path.rpartition("/")[0], recursive=True)
                    out = files.open_output_stream(path, compression=None)
                if row["chunk"] == 0:
                    packer, digest = zlib.compressobj(level, zlib.DEFLATED, 31), hashlib.sha256()
                    at += out.write(packer.compress(_head(row, date)))
                if row["refers"] is None:
                    digest.update(row["data"])
                    at += out.write(packer.compress(row["data"]))
                if row["last"]:
                    if row["refers"] is None and digest.hexdigest() != row["digest"]:
                        raise ValueError(f"chunks of page {row['page']} do not make up its payload")
                    at += out.write(packer.compress(b"\r\n\r\n") + packer.flush())
                    records += 1
                    if at - begin >= SPAN:
                        spans.append((place, begin, at - begin, records))
                        begin, records = at, 0
        if out is not None:
            out.close()
            if at > begin:
                spans.append((place, begin, at - begin, records))
        if spans:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*spans)],
                                             names=["path", "offset", "length", "records"])

    return chunks.select("page", "url", "digest", "size", "refers", "chunk", "data", "last").mapInArrow(run, schema)


class _Inflater:
    """Plain bytes of consecutive gzip members, a bounded piece at a time."""

    def __init__(self, stream, length: int):
        self.stream, self.left = stream, length
        self.raw, self.plain = b"", bytearray()
        self.member = zlib.decompressobj(31)

    def fill(self) -> bool:
        if self.member.eof:
            self.raw, self.member = self.member.unused_data, zlib.decompressobj(31)
        elif self.member.unconsumed_tail:
            self.raw = self.member.unconsumed_tail
        if not self.raw:
            if not self.left:
                return False
            self.raw = self.stream.read(min(CHUNK, self.left))
            self.left -= len(self.raw)
        raw, self.raw = self.raw, b""
        self.plain += self.member.decompress(raw, CHUNK)
        return True

    def until(self, mark: bytes) -> bytes | None:
        seen = 0
        while (at := self.plain.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.plain)
            if not self.fill():
                return None
        got = bytes(self.plain[:at])
        del self.plain[:at + len(mark)]
        return got

    def take(self, most: int) -> bytes:
        while len(self.plain) < most and self.fill():
            pass
        got = bytes(self.plain[:most])
        del self.plain[:most]
        return got


def _records(stream, length: int, chunk_bytes: int):
    """Chunk rows of one span: ``(headers, chunk, data, bytes so far, digest so
    far, last)``."""
    source = _Inflater(stream, length)
    while (head := source.until(b"\r\n\r\n")) is not None:
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        http = source.until(b"\r\n\r\n")
        left = int(fields["Content-Length"]) - len(http) - 4
        digest, size, chunk = hashlib.sha256(), 0, 0
        while True:
            data = source.take(min(chunk_bytes, left - size))
            digest.update(data)
            size += len(data)
            if not data and size < left:
                raise ValueError("archive ends inside a record")
            yield fields, chunk, data, size, digest.hexdigest(), size == left
            if size == left:
                break
            chunk += 1
        if source.take(4) != b"\r\n\r\n":
            raise ValueError("record has no end mark")


def read_archives(spans: DataFrame, with_data: bool = True, chunk_bytes: int = CHUNK) -> DataFrame:
    """The chunked record table of the spans: ``page, url, type, refers_to,
    payload_bytes, payload_digest`` (of the whole payload, as the header says),
    ``chunk, data, size_so_far, digest_so_far, last``.  A stored payload whose
    digest differs from its header raises.  ``with_data`` false leaves ``data``
    null: all bytes are read and digested, but not handed on."""
    schema = T.StructType([T.StructField(n, t) for n, t in (
        ("page", T.StringType()), ("url", T.StringType()), ("type", T.StringType()), ("refers_to", T.StringType()),
        ("payload_bytes", T.LongType()), ("payload_digest", T.StringType()), ("chunk", T.IntegerType()),
        ("data", T.BinaryType()), ("size_so_far", T.LongType()), ("digest_so_far", T.StringType()),
        ("last", T.BooleanType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)
        rows, held = [], 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), out)], schema=out)

        for batch in batches:
            for span in batch.to_pylist():
                files, path = fs.FileSystem.from_uri(span["path"])
                with files.open_input_file(path) as file:
                    file.seek(span["offset"])
                    for fields, chunk, data, size, digest, last in _records(file, span["length"], chunk_bytes):
                        declared = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                        kind = fields["WARC-Type"]
                        if last and kind == "response" and digest != declared:
                            raise ValueError(f"digest of {fields['WARC-Record-ID']} differs")
                        rows.append((fields.get("X-Page-Id"), fields.get("WARC-Target-URI"), kind,
                                     fields.get("X-Refers-To-Page"), int(fields["X-Payload-Length"]), declared, chunk,
                                     data if with_data else None, size, digest, last))
                        held += len(data) if with_data else 256
                        if held >= 4 << 20:
                            yield flush()
                            rows, held = [], 0
        if rows:
            yield flush()

    return spans.select("path", "offset", "length").mapInArrow(run, schema)


def archive(pages: DataFrame, folder: str | None = None, least_bytes: int = 100, chunk_bytes: int = CHUNK,
            id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Writes ``pages`` as archives into ``folder`` (default: a new one in the
    shared folder) and returns the checkpointed spans.

    Defined cases: a null payload is empty; a null url or id leaves its header
    out; line ends in a url are percent-encoded; see ``mark_revisits`` for
    ties; an empty table writes no file; other columns are not read.
    """
    folder = folder or f"{shared_dir(pages.sparkSession).rstrip('/')}/warc-{uuid.uuid4()}"
    records = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                           F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    marked = mark_revisits(records, least_bytes).select(
        F.col("page_id").cast("string").alias("page"), "url", "digest", "size",
        F.col("refers_to").cast("string").alias("refers"),
        F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"))
    return cut(write_archives(chunk_table(marked, "payload", chunk_bytes), folder))
