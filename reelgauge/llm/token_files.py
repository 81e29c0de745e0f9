"""Token-id files: canonical length-limited Huffman codes of ids.

Counts over the whole corpus give one code book. A file holds blocks of whole
documents; a block is a bit stream of its own with the bit offset of every
256th id (checkpoint), so any block is decoded without the others, and all its
checkpoints side by side by one table look-up an id.

File layout (little endian): ``HUF1``, then the blocks. A block: number of ids
(u64), of checkpoints (u32), of payload words (u32); bit offsets of the
checkpoints (u64 each); the payload (u32 words, first bit highest). What block
lies where, and the documents in it, is in the manifest, a Parquet table beside
the files; the code book is the table ``codebook`` there.

Defined results: a null text has only the end id; null doc_ids come first;
equal doc_ids are ordered by the hash of their ids, then in any order (they
differ in nothing then); an empty table gives an empty manifest; further
columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelgauge.llm.shared import attempt_name, fresh_path, open_shared, table, width
from reelgauge.llm.tokens import chunks, encoder

MAGIC = b"HUF1"
STRIDE = 256  # ids between checkpoints
BLOCK_IDS = 1 << 18  # a block ends with the document that reaches this
LONGEST = 18  # bits of a code; the table has 2**18 entries

MANIFEST = (
    "path string, part int, block int, offset long, n_bytes long, first_id long, n_ids long, "
    "docs array<struct<doc_id: bigint, n_tokens: bigint>>"
)


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Optimal code lengths of at most ``longest`` bits, by package-merge; 0 for unused ids."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.int64)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << longest:
        raise ValueError("more ids than codes of that length")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    levels = []
    packages = np.zeros(0)
    for _ in range(longest):
        merged = np.concatenate([weights, packages])
        is_package = np.concatenate([np.zeros(len(weights), bool), np.ones(len(packages), bool)])
        by = np.argsort(merged, kind="stable")
        merged, is_package = merged[by], is_package[by]
        levels.append(is_package)
        even = len(merged) // 2 * 2
        packages = merged[:even:2] + merged[1:even:2]
    take = 2 * (len(order) - 1)
    found = np.zeros(len(order), np.int64)
    for is_package in reversed(levels):
        chosen = is_package[:take]
        found[: int((~chosen).sum())] += 1
        take = 2 * int(chosen.sum())
    lengths[order] = found
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then id."""
    codes = np.zeros(len(lengths), np.uint64)
    code, before = 0, 0
    for number in np.lexsort((np.arange(len(lengths)), lengths)):
        size = int(lengths[number])
        if size:
            code <<= size - before
            codes[number], before = code, size
            code += 1
    return codes


class Codec:
    def __init__(self, lengths: np.ndarray):
        self.lengths = np.asarray(lengths, np.int64)
        self.codes = canonical_codes(self.lengths)
        self.peek = max(1, int(self.lengths.max(initial=1)))
        used = np.flatnonzero(self.lengths)
        order = used[np.lexsort((used, self.lengths[used]))]
        spans = 1 << (self.peek - self.lengths[order])
        self.ids = np.zeros(1 << self.peek, np.uint32)
        self.ids[: int(spans.sum())] = np.repeat(order, spans)

    def encode(self, ids: np.ndarray) -> bytes:
        sizes = self.lengths[ids]
        if len(ids) and not sizes.all():
            raise ValueError("an id has no code")
        ends = np.cumsum(sizes)
        starts = ends - sizes
        total = int(ends[-1]) if len(ids) else 0
        n_words = (total + 31) // 32 + 2  # room for the last look ahead
        word, room = starts >> 5, (64 - sizes - (starts & 31)).astype(np.uint64)
        pair = self.codes[ids] << room
        high = np.bincount(word, (pair >> np.uint64(32)).astype(np.float64), n_words)
        low = np.bincount(word + 1, (pair & np.uint64(0xFFFFFFFF)).astype(np.float64), n_words)
        marks = starts[::STRIDE].astype("<u8")
        head = struct.pack("<QII", len(ids), len(marks), n_words)
        return head + marks.tobytes() + (high + low).astype(np.uint64).astype("<u4").tobytes()

    def decode(self, block: bytes) -> np.ndarray:
        n, n_marks, n_words = struct.unpack_from("<QII", block)
        at = np.frombuffer(block, "<u8", n_marks, 16).astype(np.int64)
        words = np.frombuffer(block, "<u4", n_words, 16 + 8 * n_marks).astype(np.uint64)
        pairs = (words[:-1] << np.uint64(32)) | words[1:]
        out = np.zeros((n_marks, STRIDE), np.uint32)
        last = n - STRIDE * (n_marks - 1) if n_marks else 0
        shift = np.uint64(64 - self.peek)
        for step in range(STRIDE if n_marks > 1 else last):
            if step == last:
                at = at[:-1]
            look = (pairs[at >> 5] << (at & 31).astype(np.uint64)) >> shift
            found = self.ids[look]
            out[: len(at), step] = found
            at = at + self.lengths[found]
        return out.reshape(-1)[:n]


def _ids(vocabulary: str, end_id: int, id_bytes: int):
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(vocabulary)
        for batch in batches:
            texts = batch[1]
            for start, end in chunks(texts):
                flat, lengths = code.encode(texts.slice(start, end - start))
                cuts = np.cumsum(lengths)
                flat = np.insert(flat, cuts, end_id)
                if id_bytes < 4 and flat.max(initial=0) >> (8 * id_bytes):
                    raise ValueError("an id needs more bytes")
                flat = flat.astype(f"<u{id_bytes}")
                ends = id_bytes * (cuts + np.arange(1, len(cuts) + 1))
                raw = flat.tobytes()
                starts = np.concatenate([[0], ends[:-1]])
                blobs = [raw[a:b] for a, b in zip(starts, ends, strict=True)]
                yield pa.record_batch([batch[0].slice(start, end - start), pa.array(blobs, pa.binary()), lengths + 1], schema=schema)

    return run


def tokenize(documents: DataFrame, vocabulary: str, end_id: int, id_bytes: int = 2) -> DataFrame:
    """(doc_id, ids, n_tokens) written to the shared folder; ids little-endian, of 2 or 4 bytes."""
    encoded = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ids = encoded.mapInArrow(_ids(vocabulary, end_id, id_bytes), "doc_id long, ids binary, n_tokens long")
    path = fresh_path(documents.sparkSession, "ids")
    ids.write.option("compression", "zstd").parquet(path)
    return documents.sparkSession.read.schema(ids.schema).parquet(path)


def _unpacked(blob: pa.BinaryScalar, n: int) -> np.ndarray:
    return np.frombuffer(blob.as_buffer(), f"<u{len(blob.as_buffer()) // n}") if n else np.zeros(0, "<u2")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each id a partition holds."""
    counts = np.zeros(0, np.int64)
    for batch in batches:
        held = [_unpacked(blob, n) for blob, n in zip(batch[0], batch[1].to_pylist(), strict=True)]
        found = np.bincount(np.concatenate(held)) if held else counts[:0]
        if len(found) > len(counts):
            counts, found = found, counts
        counts[: len(found)] += found
    used = np.flatnonzero(counts)
    yield pa.record_batch([used, counts[used]], names=["id", "n"])


def code_book(ids: DataFrame, longest: int = LONGEST) -> np.ndarray:
    """Code lengths by id, from counts over all rows. Only counts by id reach the driver."""
    counted = ids.select("ids", "n_tokens").mapInArrow(_count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    found = counted.toPandas()
    counts = np.zeros(int(found["id"].max()) + 1 if len(found) else 1, np.int64)
    counts[found["id"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return code_lengths(counts, longest)


def _write(folder: str, lengths: np.ndarray):
    docs_type = pa.list_(pa.struct([("doc_id", pa.int64()), ("n_tokens", pa.int64())]))
    schema = pa.schema([
        ("path", pa.string()), ("part", pa.int32()), ("block", pa.int32()), ("offset", pa.int64()),
        ("n_bytes", pa.int64()), ("first_id", pa.int64()), ("n_ids", pa.int64()), ("docs", docs_type),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        codec, path, out = Codec(lengths), attempt_name(folder, part, "huf"), None
        place, block, first = len(MAGIC), 0, 0
        held: list[np.ndarray] = []
        docs: list[dict] = []
        count = 0
        try:
            for batch in _then_none(batches):
                for doc, blob, n in zip(batch[0].to_pylist(), batch[1], batch[2].to_pylist(), strict=True) if batch else [(None,) * 3]:
                    if blob is not None:
                        ids = _unpacked(blob, n)
                        held.append(ids)
                        docs.append({"doc_id": doc, "n_tokens": len(ids)})
                        count += len(ids)
                    if count >= BLOCK_IDS or blob is None and docs:
                        if out is None:
                            out = open_shared(path, "wb")
                            out.write(MAGIC)
                        raw = codec.encode(np.concatenate(held))
                        out.write(raw)
                        row = [path, part, block, place, len(raw), first, count, docs]
                        yield pa.record_batch([pa.array([x], f.type) for x, f in zip(row, schema, strict=True)], schema=schema)
                        place, block, first = place + len(raw), block + 1, first + count
                        held, docs, count = [], [], 0
        finally:
            if out is not None:
                out.close()

    return run


def _then_none(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def write_ids(ids: DataFrame, folder: str, longest: int = LONGEST) -> DataFrame:
    """Write ids in ascending doc_id order; returns the manifest, also kept in ``folder``.

    Documents are ranged by doc_id, so files follow each other in that order. A
    task that runs again writes a file of a new name, and the manifest has the
    one that counts.
    """
    spark = ids.sparkSession
    lengths = code_book(ids, longest)
    book = [(i, int(n)) for i, n in enumerate(lengths) if n]
    spark.createDataFrame(book, "id int, bits int").coalesce(1).write.parquet(f"{folder}/codebook")
    order = [F.col("doc_id").asc_nulls_first(), F.crc32("ids")]
    ranged = ids.withColumn("_crc", order[1]).repartitionByRange(width(spark), order[0], "_crc")
    ranged.sortWithinPartitions(order[0], "_crc").select("doc_id", "ids", "n_tokens").mapInArrow(
        _write(folder, lengths), MANIFEST
    ).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def _read(lengths: np.ndarray):
    schema = pa.schema([
        ("doc_id", pa.int64()), ("part", pa.int32()), ("start", pa.int64()), ("n_tokens", pa.int64()),
        ("ids", pa.binary()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(lengths)
        for batch in batches:
            for row in batch.to_pylist():
                with open_shared(row["path"]) as file:
                    if file.read(4) != MAGIC:
                        raise ValueError(f"not a token file: {row['path']}")
                    file.seek(row["offset"])
                    ids = codec.decode(file.read(row["n_bytes"]))
                if len(ids) != row["n_ids"]:
                    raise ValueError(f"block {row['block']} of {row['path']} is damaged")
                sizes = np.array([x["n_tokens"] for x in row["docs"]], np.int64)
                ends = np.cumsum(sizes)
                raw = ids.astype("<u4").tobytes()
                blobs = [raw[4 * (e - n) : 4 * e] for e, n in zip(ends, sizes, strict=True)]
                yield pa.record_batch([
                    pa.array([x["doc_id"] for x in row["docs"]], pa.int64()),
                    pa.array(np.full(len(sizes), row["part"]), pa.int32()),
                    pa.array(row["first_id"] + ends - sizes),
                    pa.array(sizes),
                    pa.array(blobs, pa.binary()),
                ], schema=schema)

    return run


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from the files of ``folder``; any block by any task."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    book = spark.read.schema("id int, bits int").parquet(f"{folder}/codebook").toPandas()
    lengths = np.zeros(int(book["id"].max()) + 1 if len(book) else 1, np.int64)
    lengths[book["id"].to_numpy()] = book["bits"].to_numpy()
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    offsets = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    # Blocks are dealt out evenly, whatever file they are in.
    read = manifest.repartition(width(spark), "part", "block").mapInArrow(
        _read(lengths), "doc_id long, part int, start long, n_tokens long, ids binary"
    )
    # A row for each part, as many as a shuffle has partitions: small, and never a reason to move ids.
    return read.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids"
    )


def digest(read: DataFrame) -> DataFrame:
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "token-files")
    write_ids(tokenize(table(spark, sf_dir, "documents"), "byte_bpe_50k.json", 0), folder)
    return digest(read_ids(spark, folder))
