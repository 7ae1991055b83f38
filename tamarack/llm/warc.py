"""WARC archives through a chunked record table.

Payloads travel as rows (record_id, chunk, data, last) of at most CHUNK bytes each. The
reader's rows also have the size and the SHA-256 of all bytes up to and including the row's,
so that the last row carries the whole payload's digest; the writer keeps such a running
digest too and compares it, at the last chunk, with the one that the header had to state
before. Outside the JVM, which has each page as one value of its table, nothing holds a whole
record. The JVM cuts payloads into chunks; writers and readers go chunk by chunk
between them and the archive. Archives are files of the shared folder, one or more
a task, each record a gzip member; a task writes under a name of its own and
reports what it has closed, so that a lost or repeated task leaves at most a file
that no report names.

Of records with equal payloads of at least LEAST bytes the one of smallest page_id
is a response and the others revisit it; smaller ones are all responses. Equal
payloads are counted by their digest before rows are joined, and the digests of
very many rows go by broadcast. Null html is an empty payload; a null url is left
out of the header; rows that repeat a page_id give a record each, and those that
share the smallest page_id are all responses; a row without a page_id revisits any
that has one; an empty table gives an empty table; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, shared_path, sweep, table, with_groups

CHUNK, LEAST, ARCHIVE_BYTES = 256 << 10, 100, 256 << 20
DATE = "1970-01-01T00:00:00Z"
CHUNKS = "record_id long, page_id long, chunk int, data binary, digest string, size long, last boolean, record_type string, refers_to long, stated_digest string, stated_size long, url string"


def open_folder(path: str):
    """The file system of a path or URI, and the path within it."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), unquote(urlsplit(path).path)
    return fs.FileSystem.from_uri(path)


def chunk_rows(pages: DataFrame, payload: str, chunk: int = CHUNK) -> DataFrame:
    """pages with a row for each chunk of a binary column: chunk, data, last."""
    size = F.octet_length(payload)
    many = F.greatest(F.lit(1), F.ceil(size / chunk).cast("int"))
    rows = pages.withColumn("chunk", F.explode(F.sequence(F.lit(0), many - 1))).withColumn("last", F.col("chunk") == many - 1)
    return rows.withColumn("data", F.expr(f"substring({payload}, chunk * {chunk} + 1, {chunk})")).drop(payload)


class Member:
    """A gzip member that is written in parts."""

    def __init__(self, out):
        self.out, self.deflate = out, zlib.compressobj(1, zlib.DEFLATED, 31)

    def write(self, data: bytes) -> None:
        self.out.write(self.deflate.compress(data))

    def close(self) -> None:
        self.out.write(self.deflate.flush())


def header_of(row: dict) -> bytes:
    """The header of a record; a revisit has no block, and says the size of what it revisits."""
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <urn:record:{row['record_id']}>", f"WARC-Date: {DATE}"]
    if row["url"] is not None:
        lines.append(f"WARC-Target-URI: {quote(row['url'], safe=':/?#[]@!$&()*+,;=%~')}")
    if row["page_id"] is not None:
        lines.append(f"Page-Id: {row['page_id']}")
    lines.append(f"WARC-Payload-Digest: sha-256:{row['stated_digest']}")
    if row["record_type"] == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{row['refers_to']}>", f"Payload-Length: {row['stated_size']}"]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {0 if row['record_type'] == 'revisit' else row['stated_size']}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n"


def write_archives(chunks: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes chunk rows, those of a record in order and one after the other; gives (path, records, bytes) of each archive."""
    names = ["record_id", "page_id", "url", "record_type", "refers_to", "stated_digest", "stated_size", "chunk", "last"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, where = open_folder(folder)
        system.create_dir(where, recursive=True)
        out = member = path = digest = None
        records = 0
        for batch in batches:
            meta, data = batch.select(names).to_pylist(), batch.column("data")
            for row, value in zip(meta, data):
                if out is None:
                    path, records = f"{where}/{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(path, compression=None)
                if row["chunk"] == 0:
                    member, digest = Member(out), hashlib.sha256()
                    member.write(header_of(row))
                if row["record_type"] != "revisit":
                    member.write(value.as_buffer())
                    digest.update(value.as_buffer())
                if row["last"]:
                    if row["record_type"] != "revisit" and digest.hexdigest() != row["stated_digest"]:
                        raise ValueError(f"record {row['record_id']} is not the payload that its header states")
                    member.write(b"\r\n\r\n")
                    member.close()
                    records += 1
                    if out.tell() >= archive_bytes:
                        size = out.tell()
                        out.close()
                        out = None
                        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([records], pa.int64()), pa.array([size], pa.int64())], names=["path", "records", "bytes"])
        if out is not None:
            size = out.tell()
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([records], pa.int64()), pa.array([size], pa.int64())], names=["path", "records", "bytes"])

    return chunks.select(*names, "data").mapInArrow(write, "path string, records long, bytes long")


class Unpacked:
    """The bytes of an archive of gzip members, read in parts."""

    def __init__(self, stream, size: int):
        self.stream, self.size, self.held, self.inflate, self.raw = stream, size, b"", None, b""

    def more(self) -> bool:
        """Holds some more bytes; False at the archive's end."""
        while True:
            if not self.raw:
                self.raw = self.stream.read(self.size)
                if not self.raw:
                    return False
            if self.inflate is None:
                self.inflate = zlib.decompressobj(31)
            part = self.inflate.decompress(self.raw, self.size)
            self.raw = self.inflate.unconsumed_tail
            if self.inflate.eof:
                self.raw = self.inflate.unused_data
                self.inflate = None
            if part:
                self.held += part
                return True

    def header(self) -> dict[str, str] | None:
        while (end := self.held.find(b"\r\n\r\n")) < 0:
            if not self.more():
                if self.held:
                    raise ValueError("an archive ends within a record's header")
                return None
        lines, self.held = self.held[:end].decode().split("\r\n"), self.held[end + 4 :]
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record begins with {lines[0]!r}")
        return dict(x.split(": ", 1) for x in lines[1:])

    def take(self, n: int) -> bytes:
        """At most n bytes, at least one."""
        if not self.held and not self.more():
            raise ValueError("an archive ends within a record")
        out, self.held = self.held[:n], self.held[n:]
        return out


def read_file(system, path: str, chunk: int, with_data: bool) -> Iterator[dict]:
    """Chunk rows of an archive."""
    with system.open_input_stream(path, compression=None) as stream:
        source = Unpacked(stream, chunk)
        while (head := source.header()) is not None:
            left, digest, number = int(head["Content-Length"]), hashlib.sha256(), 0
            revisit = head["WARC-Type"] == "revisit"
            row = {
                "record_id": int(head["WARC-Record-ID"].rstrip(">").rpartition(":")[2]), "page_id": int(head["Page-Id"]) if "Page-Id" in head else None, "url": unquote(head["WARC-Target-URI"]) if "WARC-Target-URI" in head else None,
                "record_type": head["WARC-Type"], "refers_to": int(head["WARC-Refers-To"].rstrip(">").rpartition(":")[2]) if revisit else None,
                "stated_digest": head["WARC-Payload-Digest"].partition(":")[2], "stated_size": int(head["Payload-Length"]) if revisit else left,
            }
            size = 0
            while True:
                part = []
                room = min(chunk, left)
                while room:
                    part.append(source.take(room))
                    digest.update(part[-1])
                    room -= len(part[-1])
                    left -= len(part[-1])
                    size += len(part[-1])
                yield row | {"chunk": number, "data": b"".join(part) if with_data else None, "digest": digest.copy().hexdigest(), "size": size, "last": not left}
                number += 1
                if not left:
                    break
            rest = 4
            while rest:
                rest -= len(source.take(rest))


def read_archives(files: DataFrame, chunk: int = CHUNK, with_data: bool = True) -> DataFrame:
    """The chunk table of archives (path), a task to a few of them; of revisits one row, that has no data."""
    names = [x.split()[0] for x in CHUNKS.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_()}
    schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in CHUNKS.split(", ")])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                system, path = open_folder(uri)
                rows, size = [], 0
                for row in read_file(system, path, chunk, with_data):
                    rows.append(row)
                    size += len(row["data"] or b"") + 200
                    if size > 8 * chunk:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return files.select("path").mapInArrow(read, CHUNKS).select(*names)


def decided(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """pages (record_id, page_id, url, html) with stated_digest, stated_size, record_type and refers_to."""
    sized = pages.select("record_id", "page_id", "url", F.encode("html", "UTF-8").alias("payload")).withColumn("stated_size", F.octet_length("payload").cast("long")).withColumn("stated_digest", F.sha2("payload", 256))
    narrow = materialize(sized.select("page_id", "stated_size", "stated_digest"), "digests")
    groups = narrow.where(F.col("stated_size") >= least).groupBy("stated_digest").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first_page")).where("n > 1")
    groups = materialize(groups, "copies")
    out = with_groups(sized, groups, ["stated_digest"], narrow.count(), outer=True)
    revisit = F.coalesce(F.col("first_page") != F.col("page_id"), F.col("first_page").isNotNull())
    return out.select("record_id", "page_id", "url", "payload", "stated_size", "stated_digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("first_page")).alias("refers_to"))


def archive(pages: DataFrame, folder: str, chunk: int = CHUNK, least: int = LEAST, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes pages (page_id, url, html) as archives; gives the stored table (path, records, bytes) of them."""
    rows = pages.select(F.monotonically_increasing_id().alias("record_id"), F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html"), F.lit("")).alias("html"))
    files = materialize(write_archives(chunk_rows(decided(rows, least), "payload", chunk), folder, archive_bytes), "archives")
    sweep(pages.sparkSession)
    return files


def records(files: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record; a response's from its bytes."""
    spread = files.select("path").repartition(max(1, files.count()), "path")
    last = read_archives(spread, chunk, with_data=False).where("last")
    revisit = F.col("record_type") == "revisit"
    return last.select(
        "page_id", F.when(revisit, F.col("stated_size")).otherwise(F.col("size")).alias("payload_bytes"),
        F.when(revisit, F.col("stated_digest")).otherwise(F.col("digest")).alias("payload_digest"), "record_type", "refers_to",
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(archive(table(spark, sf_dir, "pages"), shared_path(spark, "warc")))


#: The same rows in DuckDB.
OP8_SQL = f"""
WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS payload_digest, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
g AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= {LEAST} GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN g.first IS NULL OR g.first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN g.first <> page_id THEN g.first END AS refers_to
FROM p LEFT JOIN g USING (payload_digest)
"""
