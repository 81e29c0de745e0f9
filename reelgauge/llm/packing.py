"""Vector bin packing of examples into training sequences.

A sequence has limits on tokens, on segments and on loss-bearing tokens. Of the
waiting pieces that fit in every dimension, the one whose demand has the
largest dot product with the room left (both as shares of the limits) goes in
next. Examples longer than a sequence are cut into whole sequences and a rest;
where no waiting piece fits, one is cut to fill the gap.

Each task packs its own examples and holds at most ``POOL`` waiting pieces. What
does not fill a sequence there (less than one sequence of tokens, or pieces
that a limit keeps apart) is packed again with the rest of ``NEIGHBOURS`` other
tasks, so few sequences need padding however many tasks there are.

Defined results: a null text is an example of the end id alone; rows with equal
or null doc_id are examples of their own; an empty table gives no pieces;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgauge.llm.shared import settle, table
from reelgauge.llm.tokens import chunks, encoder

POOL = 4096
NEIGHBOURS = 64
#: Characters encoded at once, and rows held before they leave the worker.
AT_ONCE, HELD = 500_000, 500

PIECE = (
    "doc_id long, start long, length long, n_loss long, doc_tokens long, sequence_id long, "
    "offset long, ids binary, part int"
)
_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("n_loss", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()),
    ("part", pa.int32()),
])


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 64
    loss: int = 2048  # loss-bearing tokens
    least_cut: int = 16  # no piece shorter than this is cut off to fill a gap


@dataclass(slots=True)
class Piece:
    doc_id: int | None
    start: int
    ids: np.ndarray
    prompt: int  # leading ids of this piece without loss
    doc_tokens: int

    @property
    def loss(self) -> int:
        return len(self.ids) - self.prompt

    def cut(self, size: int) -> tuple[Piece, Piece]:
        head = Piece(self.doc_id, self.start, self.ids[:size], min(self.prompt, size), self.doc_tokens)
        rest = Piece(
            self.doc_id, self.start + size, self.ids[size:], max(0, self.prompt - size), self.doc_tokens
        )
        return head, rest


def whole_sequences(piece: Piece, limits: Limits) -> tuple[list[Piece], Piece | None]:
    """Cut off what fills a sequence by itself, in tokens or in loss."""
    full = []
    while len(piece.ids) > 0:
        size = min(limits.tokens, piece.prompt + limits.loss)
        if len(piece.ids) < size:
            return full, piece
        head, piece = piece.cut(size)
        full.append(head)
    return full, None


class Packer:
    def __init__(self, limits: Limits):
        self.limits = limits
        self.scale = np.array([limits.tokens, limits.segments, limits.loss], np.float64)

    def pack(self, pool: list[Piece], final: bool) -> tuple[list[list[Piece]], list[Piece]]:
        """Sequences, and the pieces left over; none are if ``final``."""
        limits, pool = self.limits, list(pool)
        demand = np.array([(len(x.ids), 1, x.loss) for x in pool], np.float64).reshape(-1, 3)
        prompt = np.array([x.prompt for x in pool], np.int64)
        share = demand / self.scale
        tokens, loss = demand[:, 0].copy(), demand[:, 2].copy()  # in a row, as each step compares them all
        alive = np.ones(len(pool), bool)
        left = len(pool)
        done: list[list[Piece]] = []
        while left:
            room = self.scale.copy()
            inside: list[int | Piece] = []
            while room[0] > 0 and room[1] > 0:
                fits = alive & (tokens <= room[0]) & (loss <= room[2])  # a segment is left
                if fits.any():
                    best = int(np.argmax(np.where(fits, share @ (room / self.scale), -1)))
                    inside.append(pool[best])
                    alive[best] = False
                    left -= 1
                    room -= demand[best]
                    continue
                cut = self._cut(pool, demand, prompt, alive, room)
                if cut is None:
                    break
                place, head, rest = cut
                inside.append(head)
                pool[place] = rest
                demand[place] = (len(rest.ids), 1, rest.loss)
                prompt[place] = rest.prompt
                share[place] = demand[place] / self.scale
                tokens[place], loss[place] = demand[place, 0], demand[place, 2]
                room -= (len(head.ids), 1, head.loss)
            if not final and not left and room[0] >= limits.least_cut and room[1] > 0:
                return done, inside
            done.append(inside)
        return done, []

    def _cut(self, pool, demand, prompt, alive, room) -> tuple[int, Piece, Piece] | None:
        if room[0] < self.limits.least_cut:
            return None
        # The piece that bears least loss in its first ids fits a loss limit best; of equal ones the longest.
        size = int(room[0])
        loss = size - np.minimum(prompt, size)
        places = np.flatnonzero(alive & (demand[:, 0] >= size + self.limits.least_cut) & (loss <= room[2]))
        if not len(places):
            return None
        place = int(places[np.lexsort((-demand[places, 0], loss[places]))[0]])
        return place, *pool[place].cut(size)


class _Out:
    """Rows of a batch."""

    def __init__(self):
        self.rows: list[tuple] = []

    def add(self, pieces: list[Piece], sequence: int | None, part: int) -> None:
        offset = 0
        for x in pieces:
            n = len(x.ids)
            self.rows.append(
                (x.doc_id, x.start, n, x.loss, x.doc_tokens, sequence, None if sequence is None else offset,
                 x.ids.tobytes(), part)
            )
            offset += n

    def batch(self) -> pa.RecordBatch:
        columns = zip(*self.rows, strict=True) if self.rows else [[] for _ in _SCHEMA]
        self.rows = []
        return pa.record_batch(
            [pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA
        )


def _examples(batch: pa.RecordBatch, vocabulary: str, end_id: int) -> Iterator[Piece]:
    code = encoder(vocabulary)
    texts, prompts, ids = batch["text"], batch["prompt"], batch["doc_id"].to_pylist()
    for start, end in chunks(texts, AT_ONCE):
        # Prompt and answer are encoded apart, so that a cut between them is one between ids.
        flat, lengths = code.encode(texts.slice(start, end - start))
        cuts = np.cumsum(lengths)
        flat = np.insert(flat, cuts, end_id).astype("<u4")
        cuts = np.concatenate([[0], cuts + np.arange(1, len(cuts) + 1)])
        first, before = code.encode(prompts.slice(start, end - start))
        befores = np.concatenate([[0], np.cumsum(before)])
        for n in range(end - start):
            # Copies: a view of one text would hold those of all.
            found = np.concatenate([first[befores[n] : befores[n + 1]], flat[cuts[n] : cuts[n + 1]]])
            yield Piece(ids[start + n], 0, found, int(before[n]), len(found))


def _first_round(vocabulary: str, end_id: int, limits: Limits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        packer, out, pool, sequence = Packer(limits), _Out(), [], part << 32
        for batch in batches:
            for example in _examples(batch, vocabulary, end_id):
                full, rest = whole_sequences(example, limits)
                for piece in full:
                    out.add([piece], sequence, part)
                    sequence += 1
                if rest is not None:
                    pool.append(rest)
                if len(pool) >= POOL:
                    done, pool = packer.pack(pool, final=False)
                    for pieces in done:
                        out.add(pieces, sequence, part)
                        sequence += 1
                if len(out.rows) >= HELD:
                    yield out.batch()
        done, pool = packer.pack(pool, final=False)
        for pieces in done:
            out.add(pieces, sequence, part)
            sequence += 1
        out.add(pool, None, part)
        yield out.batch()

    return run


def _second_round(limits: Limits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pools: dict[int, list[Piece]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], "<u4")
                piece = Piece(row["doc_id"], row["start"], ids, len(ids) - row["n_loss"], row["doc_tokens"])
                pools.setdefault(row["part"] // NEIGHBOURS, []).append(piece)
        for group, pool in sorted(pools.items()):
            out, sequence = _Out(), (1 << 62) + (group << 32)
            # The order of rows from a shuffle varies; that of the pieces must not.
            pool.sort(key=lambda x: (-len(x.ids), x.doc_id is None, x.doc_id or 0, x.start, x.ids.tobytes()))
            for pieces in Packer(limits).pack(pool, final=True)[0]:
                out.add(pieces, sequence, group)
                sequence += 1
            yield out.batch()

    return run


def pack(
    documents: DataFrame,
    vocabulary: str = "word_bpe_49k.json",
    end_id: int = 1,
    limits: Limits = Limits(),
    prompt: str | None = None,
) -> DataFrame:
    """Pieces with their ids (little-endian u32) and places; written to the shared folder.

    ``prompt`` names a text column that comes before ``text`` and bears no loss.
    """
    narrow = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        (F.col(prompt) if prompt else F.lit(None)).cast("string").alias("prompt"),
    )
    first = settle(narrow.mapInArrow(_first_round(vocabulary, end_id, limits), PIECE), "pieces")
    rest = first.filter("sequence_id IS NULL").repartition(F.floor(F.col("part") / NEIGHBOURS))
    second = settle(rest.mapInArrow(_second_round(limits), PIECE), "last-pieces")
    return first.filter("sequence_id IS NOT NULL").unionByName(second).drop("part")


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def padded(pieces: DataFrame, tokens: int = Limits().tokens, pad_id: int = 0) -> DataFrame:
    """(sequence_id, ids): the pieces of a sequence in a row, filled up; a power of two stays as it is."""
    in_order = F.sort_array(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))  # at most a sequence
    joined = pieces.groupBy("sequence_id").agg(
        F.array_join(F.transform(in_order, lambda x: x["ids"]), "").alias("ids"), F.sum("length").alias("n")
    )
    pad = F.hex(F.lit(bytes(np.array([pad_id], "<u4").tobytes())))
    power = F.bit_count("n") == 1
    filled = F.when(power, F.col("ids")).otherwise(F.concat("ids", F.repeat(pad, (tokens - F.col("n")).cast("int"))))
    return joined.select("sequence_id", F.unhex(filled).alias("ids"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pack(table(spark, sf_dir, "documents")))
