"""WARC archives: write them, normalise monolithic gzip files, read them by index.

Records are first written one after the other into files that are one gzip
stream each, as some crawlers leave them. The normaliser inflates such a file
once, from front to back, writes every record as a gzip member of its own and
notes where each member lies in an index beside the file (``.idx``, a tab
separated line a record: offset, bytes, type, page id). A reader seeks to any
record by that index and inflates nothing else.

Of records with equal payloads the one with the smallest page_id is a response
and the others are revisits that refer to it and carry no payload; payloads
smaller than ``least`` bytes are responses always.

Defined results: a null html is an empty payload; null page_ids come after all
others, and of rows with equal page_id and payload one is the response (they
refer to that page_id); a null url is left out of the record; an empty table
gives no files and no rows; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgauge.llm.shared import attempt_name, fresh_path, open_shared, settle, table

FILE_BYTES = 64 << 20  # payload of a file; a larger record has a file to itself
READ_BYTES = 1 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"

FILES = "path string, n_records long"
INDEX = "path string, offset long, n_bytes long, record_type string, page_id long"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def _number(value: int | None) -> str:
    return "-" if value is None else str(value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    block = HTTP + b"Content-Length: %d\r\n\r\n" % len(payload)
    if not revisit:
        block += payload
    name = uuid.uuid5(uuid.NAMESPACE_OID, f"page {_number(page_id)} {digest} {url} {revisit}")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{name}>",
        f"WARC-Date: {DATE}",
        f"X-Page-Id: {_number(page_id)}",
        f"X-Payload-Bytes: {len(payload)}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if url is not None:  # a header is one line
        head.append(f"WARC-Target-URI: {' '.join(url.split())}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-Id: {_number(refers_to)}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers_of(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record here")
    return {name.lower(): value.strip() for name, _, value in (x.partition(":") for x in lines[1:])}


def inflated(file) -> Iterator[bytes]:
    """The content of a gzip file of one member or many, read once."""
    stream = zlib.decompressobj(31)
    while raw := file.read(READ_BYTES):
        while raw:
            yield stream.decompress(raw)
            raw = stream.unused_data
            if stream.eof:
                stream = zlib.decompressobj(31)


def records_of(parts: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, whole record) of a stream; holds one record and one part."""
    held, seek, need, headers = bytearray(), 0, None, {}
    for part in parts:
        held += part
        while True:
            if need is None:
                end = held.find(b"\r\n\r\n", seek)
                if end < 0:
                    seek = max(0, len(held) - 3)
                    break
                headers = headers_of(bytes(held[:end]))
                need = end + 4 + int(headers["content-length"]) + 4
            if len(held) < need:
                break
            yield headers, bytes(held[:need])
            del held[:need]
            seek, need = 0, None
    if held:
        raise ValueError("the last record is cut off")


class _Monolith:
    """A file that is one gzip stream."""

    def __init__(self, path: str):
        self.path, self.size, self.records = path, 0, 0
        self.stream, self.file = zlib.compressobj(6, zlib.DEFLATED, 31), open_shared(path, "wb")

    def add(self, raw: bytes) -> None:
        self.file.write(self.stream.compress(raw))
        self.size += len(raw)
        self.records += 1

    def close(self) -> tuple[str, int]:
        self.file.write(self.stream.flush())
        self.file.close()
        return self.path, self.records


def _write(folder: str, file_bytes: int):
    schema = pa.schema([("path", pa.string()), ("n_records", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, done = TaskContext.get().partitionId(), None, []
        for batch in batches:
            columns = (batch[name] for name in ("page_id", "url", "payload", "digest", "refers_to", "revisit"))
            for values in zip(*columns, strict=True):
                page, url, payload, digest, refers, revisit = (x.as_py() for x in values)
                if out is None:
                    out = _Monolith(attempt_name(folder, part, "mono.warc.gz"))
                digest = base64.b32encode(bytes.fromhex(digest)).decode()
                out.add(record(page, url, payload, digest, refers, revisit))
                if out.size >= file_bytes:
                    done.append(out.close())
                    out = None
        if out is not None:
            done.append(out.close())
        yield pa.record_batch([pa.array([x[i] for x in done], f.type) for i, f in enumerate(schema)], schema=schema)

    return run


def _normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("path", pa.string()), ("offset", pa.int64()), ("n_bytes", pa.int64()), ("record_type", pa.string()),
        ("page_id", pa.int64()),
    ])
    for batch in batches:
        for source, expected in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
            path = f"{source.removesuffix('.mono.warc.gz')}-{uuid.uuid4().hex[:8]}.warc.gz"
            found, place = [], 0
            with open_shared(source) as file, open_shared(path, "wb") as out:
                for headers, raw in records_of(inflated(file)):
                    stream = zlib.compressobj(6, zlib.DEFLATED, 31)
                    member = stream.compress(raw) + stream.flush()
                    out.write(member)
                    page = headers.get("x-page-id", "-")
                    found.append((path, place, len(member), headers["warc-type"], None if page == "-" else int(page)))
                    place += len(member)
            if expected is not None and len(found) != expected:
                raise ValueError(f"{source} has {len(found)} records, not {expected}")
            with open_shared(path.removesuffix(".warc.gz") + ".idx", "wb") as out:
                for _, offset, size, kind, page in found:
                    out.write(f"{offset}\t{size}\t{kind}\t{_number(page)}\n".encode())
            yield pa.record_batch([pa.array([x[i] for x in found], f.type) for i, f in enumerate(schema)], schema=schema)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ])
    path, file = None, None
    try:
        for batch in batches:
            found, size = [], 0
            for source, offset, n in zip(*(batch[i].to_pylist() for i in range(3)), strict=True):
                if source != path:
                    if file is not None:
                        file.close()
                    path, file = source, open_shared(source)
                file.seek(offset)
                ((headers, raw),) = records_of(iter([zlib.decompress(file.read(n), 31)]))
                found.append(_row(headers, raw))
                size += len(raw)
                if size > 8 << 20:
                    yield pa.record_batch([pa.array([x[i] for x in found], f.type) for i, f in enumerate(schema)], schema=schema)
                    found, size = [], 0
            yield pa.record_batch([pa.array([x[i] for x in found], f.type) for i, f in enumerate(schema)], schema=schema)
    finally:
        if file is not None:
            file.close()


def _row(headers: dict[str, str], raw: bytes) -> tuple:
    def page(name: str) -> int | None:
        value = headers.get(name, "-")
        return None if value == "-" else int(value)

    kind, digest = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha1:")
    if kind == "revisit":
        return page("x-page-id"), headers.get("warc-target-uri"), None, int(headers["x-payload-bytes"]), digest, kind, page("x-refers-to-page-id")
    block = raw[raw.index(b"\r\n\r\n") + 4 : -4]
    payload = block[block.index(b"\r\n\r\n") + 4 :]
    if sha1_base32(payload) != digest:
        raise ValueError(f"payload of page {headers.get('x-page-id')} is damaged")
    return page("x-page-id"), headers.get("warc-target-uri"), payload, len(payload), digest, kind, None


def write_archives(pages: DataFrame, folder: str, least: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write monolithic archives below ``folder``; returns their paths and numbers of records."""
    plain = settle(pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.encode(F.col("html").cast("string"), "UTF-8"), F.lit(b"")).alias("payload"),
        # Tells equal rows apart; written, so it is the same in every job.
        F.monotonically_increasing_id().alias("row"),
    ).withColumn("digest", F.sha1("payload")), "numbered-pages")
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row")
    # Only payloads that occur more than once need their first page.
    first = (
        plain.filter(F.length("payload") >= least)
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
        .filter("n > 1")
        .select("digest", "first")
    )
    first = settle(first, "first-pages")
    revisit = F.col("first").isNotNull() & (F.length("payload") >= least) & (F.col("row") != F.col("first.row"))
    marked = plain.join(first, "digest", "left").select(
        "page_id", "url", "payload", "digest",
        F.when(revisit, F.col("first.page_id")).alias("refers_to"), revisit.alias("revisit"),
    )
    return settle(marked.mapInArrow(_write(folder, file_bytes), FILES), "archives")


def normalise(files: DataFrame) -> DataFrame:
    """Rewrite monolithic files (path, n_records or null) a member a record; returns the index."""
    count = max(1, files.count())
    return settle(files.repartition(count, "path").mapInArrow(_normalise, INDEX), "warc-index")


def read_archives(index: DataFrame) -> DataFrame:
    """All records of an index; a revisit has no payload of its own."""
    return index.select("path", "offset", "n_bytes").mapInArrow(
        _read,
        "page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
        "record_type string, refers_to long",
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_archives(table(spark, sf_dir, "pages"), fresh_path(spark, "warc"))
    return read_archives(normalise(files)).drop("url", "payload")
