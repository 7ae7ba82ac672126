"""WARC archives as a table of chunks.

Records are written from, and read back as, rows of (record, chunk number):
no side ever holds a whole archive, and a payload of any size passes as rows
of at most ``chunk_bytes``, each with the SHA-1 of the payload up to and with
it, so that the last row of a record carries the digest of the whole.

Archives are gzip members, one per record.  A task writes one archive under a
name of its own; the names come back as rows and are written down as the
manifest, so that files of lost or repeated tasks are never read.  Paths go
through ``pyarrow.fs``: any store it knows will do, as long as the driver and
all executors reach it.

Payloads of at least ``min_revisit`` bytes that occur more than once are stored
once, with the record of the largest id; the others are ``revisit`` records
that refer to it and keep the HTTP headers, with the length, but no payload.

Defined cases: a null payload is empty; a null id takes no part in the choice
of the stored record: it becomes a revisit if a record with an id has the same
payload, and is stored otherwise; rows that repeat the largest id with the same
payload are all stored; a null address is empty; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.common import shared_path, stored

DATE = "2000-01-01T00:00:00Z"
READ_BYTES = 1 << 20
BATCH_BYTES = 4 << 20


def revisits(payloads: DataFrame, min_revisit: int = 1000) -> DataFrame:
    """(page_id, sha256, refers_to) of the records that are not stored, from
    rows of (page_id, sha256, n)."""
    large = payloads.filter(F.col("n") >= min_revisit)
    groups = (large.groupBy("sha256", "n").agg(F.max("page_id").alias("refers_to"),
                                               F.count(F.lit(1)).alias("copies"))
              .filter("copies > 1 AND refers_to IS NOT NULL").drop("copies"))
    return (large.join(groups, ["sha256", "n"])
            .filter("page_id IS NULL OR page_id < refers_to")
            .select("page_id", "sha256", "refers_to").distinct())


def chunk_rows(pages: DataFrame, page_id: str = "page_id", url: str = "url",
               payload: str = "html", chunk_bytes: int = 1 << 16,
               min_revisit: int = 1000) -> DataFrame:
    """The records to write: page_id, url, sha1 and n of the payload, refers_to,
    chunk_no, data.  The rows of a record follow each other in order; a revisit
    is one row without data."""
    body = F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8")
    base = pages.select(F.col(page_id).cast("long").alias("page_id"),
                        F.coalesce(F.col(url), F.lit("")).alias("url"), body.alias("body"))
    base = base.withColumns({"sha256": F.sha2("body", 256), "n": F.length("body").cast("long")})
    again = revisits(base.select("page_id", "sha256", "n"), min_revisit)
    again = again.select(F.col("page_id").alias("r_id"), F.col("sha256").alias("r_sha"), "refers_to")
    rows = base.join(again, base.page_id.eqNullSafe(again.r_id) & (base.sha256 == again.r_sha),
                     "left")
    rows = rows.withColumn("sha1", F.sha1("body"))
    last = F.when(F.col("refers_to").isNotNull(), F.lit(0)).otherwise(
        F.greatest(F.lit(0), F.ceil(F.col("n") / chunk_bytes).cast("int") - 1))
    rows = rows.withColumn("chunk_no", F.explode(F.sequence(F.lit(0), last)))
    data = F.when(F.col("refers_to").isNull(), F.substring(
        F.col("body"), F.col("chunk_no") * chunk_bytes + 1, F.lit(chunk_bytes)))
    return rows.select("page_id", "url", "sha1", "n", "refers_to", "chunk_no", data.alias("data"))


def _record_name(page_id: int | None) -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"


def _headers(page_id: int | None, url: str, sha1: str, n: int, refers_to: int | None) -> bytes:
    """Headers of a record, and the HTTP headers that its block begins with."""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {n}\r\n\r\n").encode()
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    block = len(http) + (n if refers_to is None else 0)
    kind = "response" if refers_to is None else "revisit"
    address = url.replace("\r", "%0D").replace("\n", "%0A")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_name(page_id)}",
             f"WARC-Date: {DATE}", f"WARC-Target-URI: {address}",
             f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {_record_name(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {block}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + http


def write_archives(chunks: DataFrame, folder: str) -> DataFrame:
    """Write ``chunks`` (see ``chunk_rows``) as archives below ``folder``; the
    manifest (path, records) is written to the shared folder and returned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = pafs.FileSystem.from_uri(folder)
        path, out, zipped, records = posixpath.join(top, f"{uuid.uuid4().hex}.warc.gz"), None, None, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    store.create_dir(top, recursive=True)
                    out = store.open_output_stream(path, compression=None)
                if row["chunk_no"] == 0:
                    if zipped is not None:
                        out.write(zipped.compress(b"\r\n\r\n") + zipped.flush())
                    zipped, records = zlib.compressobj(4, zlib.DEFLATED, 31), records + 1
                    out.write(zipped.compress(_headers(row["page_id"], row["url"], row["sha1"],
                                                       row["n"], row["refers_to"])))
                out.write(zipped.compress(row["data"] or b""))
        if out is not None:
            out.write(zipped.compress(b"\r\n\r\n") + zipped.flush())
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [records]})

    return stored(chunks.mapInArrow(run, "path string, records long"), "warc-manifest")


class _Unzipped:
    """Bytes of an archive of gzip members, read as they are needed."""

    def __init__(self, raw):
        self.raw, self.unzip, self.have = raw, zlib.decompressobj(31), b""
        self.rest = b""

    def _more(self) -> bool:
        data = self.rest or self.raw.read(READ_BYTES)
        if not data:
            return False
        self.have += self.unzip.decompress(data, READ_BYTES)
        self.rest = self.unzip.unconsumed_tail
        if self.unzip.eof:
            self.rest = self.unzip.unused_data
            self.unzip = zlib.decompressobj(31)
        return True

    def upto(self, mark: bytes) -> bytes | None:
        """Bytes before the next mark, which is skipped; None at the end."""
        seen = 0
        while (at := self.have.find(mark, seen)) < 0:
            seen = max(0, len(self.have) - len(mark))
            if not self._more():
                return None
        found, self.have = self.have[:at], self.have[at + len(mark):]
        return found

    def some(self, most: int) -> bytes:
        """At least one byte and at most ``most``."""
        while not self.have:
            if not self._more():
                raise EOFError("the archive ends within a record")
        found, self.have = self.have[:most], self.have[most:]
        return found


def _fields(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def _page_of(name: str | None) -> int | None:
    found = (name or "").strip("<>").rpartition("urn:page:")
    return int(found[2]) if found[1] else None


FIELDS = (("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
          ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
          ("chunk_no", pa.int64()), ("data", pa.binary()), ("sha1", pa.string()),
          ("is_last", pa.bool_()))


def archive_chunks(raw, chunk_bytes: int) -> Iterator[tuple]:
    """The rows of FIELDS for each chunk of each record of an open archive."""
    stream = _Unzipped(raw)
    while (head := stream.upto(b"\r\n\r\n")) is not None:
        warc = _fields(head)
        http = _fields(stream.upto(b"\r\n\r\n"))
        n, kind = int(http["content-length"]), warc["warc-type"]
        declared = base64.b32decode(warc["warc-payload-digest"].partition(":")[2]).hex()
        name = warc["warc-record-id"]
        common = (name, _page_of(name), warc["warc-target-uri"], kind,
                  _page_of(warc.get("warc-refers-to")), n)
        if kind == "revisit":
            yield (*common, 0, None, declared, True)
        else:
            digest, left, number = hashlib.sha1(), n, 0
            while True:
                parts, size = [], 0
                while left and size < chunk_bytes:
                    parts.append(stream.some(min(left, chunk_bytes - size)))
                    digest.update(parts[-1])
                    left, size = left - len(parts[-1]), size + len(parts[-1])
                yield (*common, number, b"".join(parts), digest.copy().hexdigest(), not left)
                if not left:
                    break
                number += 1
            if digest.hexdigest() != declared:
                raise ValueError(f"the payload of {name} does not have its digest")
        if stream.upto(b"\r\n\r\n") != b"":
            raise ValueError(f"{name} is longer than its headers say")


def read_archives(manifest: DataFrame, folder: str, chunk_bytes: int = 1 << 16) -> DataFrame:
    """The chunk table of the archives that the manifest lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = pafs.FileSystem.from_uri(folder)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, (_, k) in zip(zip(*rows), FIELDS)], [n for n, _ in FIELDS])

        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, size = [], 0
                with store.open_input_stream(path, compression=None) as raw:
                    for row in archive_chunks(raw, chunk_bytes):
                        rows.append(row)
                        size += 200 + len(row[7] or b"")
                        if size >= BATCH_BYTES:
                            yield batch_of(rows)
                            rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    schema = ("record_id string, page_id long, url string, record_type string, refers_to long, "
              "payload_bytes long, chunk_no long, data binary, sha1 string, is_last boolean")
    spread = manifest.repartition(max(1, manifest.count())).select("path")
    return spread.mapInArrow(run, schema)


def records_of(chunks: DataFrame) -> DataFrame:
    """One row per record, from its last chunk."""
    return chunks.filter("is_last").select(
        "page_id", "payload_bytes", F.col("sha1").alias("payload_digest"), "record_type",
        "refers_to", "url", (F.col("chunk_no") + 1).alias("n_chunks"))


def round_trip(spark: SparkSession, pages: DataFrame, chunk_bytes: int = 1 << 16,
               **options) -> DataFrame:
    """Write ``pages`` as archives to the shared folder and read their chunks."""
    folder = shared_path(spark, "warc")
    manifest = write_archives(chunk_rows(pages, chunk_bytes=chunk_bytes, **options), folder)
    return read_archives(manifest, folder, chunk_bytes)
