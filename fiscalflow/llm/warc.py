"""WARC archives with an index of byte ranges.

Writing: every task writes its records to archive files of its own in a shared folder, each
record a gzip member, and returns an index row a record: file, offset, length, URL, digest.
The index is a written table; a file of a task that was run again isn't in it, so lost
executors leave no wrong record.  Records whose payload equals that of a record with a
smaller id are written as revisits without payload.

Reading: the selected index rows are sorted by file and offset, and ranges that touch or lie
within ``gap`` bytes are read at once (at most ``most`` bytes).  Payloads are checked against
their digests.

Defined cases: a null payload is empty; a null URL has no target header; a null id comes after
all others when the first of equal payloads is picked; rows that repeat the smallest id and
its payload are responses like it; an empty table gives an empty index.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalflow.llm._common import TEXTS, batches, saved, shared_dir, small

INDEX = ("page_id long, url string, file string, offset long, length long, payload_digest string, payload_bytes long, "
         "record_type string, refers_to long")
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record, uncompressed."""
    block = HTTP if revisit else HTTP + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if " " < c and c != "%" else "".join(f"%{b:02X}" for b in c.encode()) for c in url))
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{refers_to}:{digest}')}>",
                 f"X-Refers-To-Page: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    return fields, rest[:int(fields["content-length"])]


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def with_first_of_equals(pages: DataFrame, page_id: str, html: str, least_bytes: int, broadcast_rows: int = 50_000) -> DataFrame:
    """page_id, url, html plus sha1 (hex) and first: the smallest id of an equal payload if it is another record's."""
    d = pages.withColumn("__sha1", F.sha1(F.coalesce(F.col(html), F.lit("")).cast("binary")))
    big = F.coalesce(F.octet_length(html), F.lit(0)) >= least_bytes
    equal = (d.where(big).groupBy("__sha1").agg(F.count(F.lit(1)).alias("n"), F.min(page_id).alias("__first"))
             .where("n > 1 and __first is not null").select("__sha1", "__first"))
    d = d.join(small(saved(equal), broadcast_rows), "__sha1", "left")
    other = big & F.col("__first").isNotNull() & ~F.col(page_id).eqNullSafe(F.col("__first"))
    return d.withColumn("__first", F.when(other, F.col("__first")))


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
                   least_bytes: int = 0, file_bytes: int = 256 << 20) -> DataFrame:
    """Writes a record a row below ``folder`` (shared by all executors) and returns the index.

    Files are closed at about ``file_bytes``.  The index is a Parquet table in ``folder``.
    """
    spark = pages.sparkSession
    d = with_first_of_equals(pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                                          F.col(html).cast("string").alias("html")), "page_id", "html", least_bytes)
    d = d.select("page_id", "url", "html", F.col("__sha1").alias("sha1"), F.col("__first").alias("refers_to"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pa.fs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        out, name, offset = None, "", 0
        for b in it:
            rows = []
            for i, u, t, sha1, first in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    name = f"records-{uuid.uuid4().hex}.warc.gz"
                    out, offset = fs.open_output_stream(f"{base}/{name}", compression=None), 0
                    info = b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
                    offset += out.write(gzip.compress(info, 1, mtime=0))
                payload = (t or "").encode()
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                raw = gzip.compress(record_bytes(i, u, payload, digest, first, first is not None), 1, mtime=0)
                out.write(raw)
                rows.append((i, u, name, offset, len(raw), digest, len(payload), "response" if first is None else "revisit", first))
                offset += len(raw)
                if offset >= file_bytes:
                    out.close()
                    out = None
            yield pa.RecordBatch.from_pylist([dict(zip(INDEX_TYPES.names, r)) for r in rows], schema=INDEX_TYPES)
        if out is not None:
            out.close()

    index = f"{folder}/index.parquet"
    batches(d, run, INDEX, TEXTS).write.parquet(index)
    return spark.read.schema(INDEX).parquet(index)


INDEX_TYPES = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
                         ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64())])
RECORD_TYPES = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                          ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def coalesced(rows: list[tuple[str, int, int]], gap: int, most: int) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """(file, start, end, members) of sorted (file, offset, length)."""
    name, start, end, members = None, 0, 0, []
    for f, o, n in rows:
        if members and (f != name or o > end + gap or max(end, o + n) - start > most):
            yield name, start, end, members
            members = []
        if not members:
            name, start, end = f, o, o
        members.append((o, n))
        end = max(end, o + n)
    if members:
        yield name, start, end, members


def read_records(index: DataFrame, folder: str, gap: int = 64 << 10, most: int = 4 << 20, with_payload: bool = True) -> DataFrame:
    """The records of the selected ``index`` rows, read back from the archives.

    Revisits have no payload of their own; length and digest are those of the full payload.
    Raises if a payload differs from its digest.
    """
    d = index.select("file", "offset", "length").withColumn("__span", F.expr(f"offset div {int(most)}"))
    d = d.repartition("file", "__span").sortWithinPartitions("file", "offset").drop("__span")

    def record(raw: bytes) -> tuple:
        fields, block = parse_record(gzip.decompress(raw))
        kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
        payload, n = None, int(fields["x-payload-length"])
        if kind == "response":
            payload = block[len(HTTP):]
            if base32_sha1(payload) != digest or len(payload) != n:
                raise ValueError(f"payload of page {fields.get('x-page-id')} differs from its digest")
        url = fields.get("warc-target-uri")
        if url is not None:
            parts = url.encode().split(b"%")
            url = (parts[0] + b"".join(bytes([int(x[:2], 16)]) + x[2:] for x in parts[1:])).decode()
        number = lambda k: int(fields[k]) if k in fields else None
        return number("x-page-id"), url, n, digest, kind, number("x-refers-to-page"), payload if with_payload else None

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pa.fs.FileSystem.from_uri(folder)
        for b in it:
            ranges = list(zip(*(c.to_pylist() for c in b.columns)))
            for name, start, end, members in coalesced(ranges, gap, most):
                with fs.open_input_file(f"{base}/{name}") as f:
                    data = f.read_at(end - start, start)
                rows = [record(data[o - start:o - start + n]) for o, n in members]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(RECORD_TYPES.types)],
                                                 schema=RECORD_TYPES)

    return batches(d, run, RECORD)


def new_folder(spark: SparkSession) -> str:
    """A folder for archives below the shared folder."""
    return f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
