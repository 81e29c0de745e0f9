"""Near-duplicate embeddings by iterative quantisation and multi-index Hamming tables.

A rotation is learned on a bounded sample so that the signs of the rotated
(unit, centred) vectors are balanced codes with little quantisation error.
Codes are cut into substrings; a table for each of them holds the vectors of a
label under their substring. The length of a substring is set for small
buckets, and the number of tables for a wanted recall: at least what bits that
differ with probability angle / pi ask for, and as many as bring the wanted
share of near pairs together that are made from the sample at the limit and
coded by the learned rotations (a common component of the vectors widens the
angle around their mean). Substrings become shorter if that takes too many
tables; more bits than dimensions come from further rotations. What meets in a bucket is reranked by
the cosine of the original vectors in double precision. A pair that meets in
several tables counts in the first of them.

Equal vectors of a label are one member with a number of copies. Buckets above
``UNIT`` members are cut into slices that meet pairwise. Pairs stay inside the
task: it passes on counts of links and links enough to connect the unit.

Defined results: vectors that are null, zero, or hold null or non-finite
components, and rows without label, have no links and are their own component;
vectors of different length do not link; a null vec_id counts as a vector but
never names a component (``kept`` is false for it); repeated rows link with
each other; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgauge.llm.shared import components, groups_of, settle, smallest_root, table, unit_rows, width

LIMIT = 0.98
RECALL = 0.999
TRAIN_VECTORS = 20_000
UNIT = 2048
MOST_TABLES = 64  # more only if substrings of one bit need them
TEST_PAIRS = 20_000  # near pairs the recall is measured on, at least


@dataclass(frozen=True)
class Plan:
    tables: int
    bits: int  # of a substring
    rotations: dict[int, tuple[np.ndarray, list[np.ndarray]]]  # by dimension: mean, rotations

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """Substrings of the codes, one column a table."""
        size = vectors.shape[1]
        need = math.ceil(self.tables * self.bits / size)
        mean, found = self.rotations.get(size) or (np.zeros(size), [_random_rotation(size, i) for i in range(need)])
        code = np.concatenate([(vectors - mean) @ r > 0 for r in found], axis=1)[:, : self.tables * self.bits]
        parts = code.reshape(len(vectors), self.tables, self.bits).astype(np.int64)
        return parts @ (1 << np.arange(self.bits, dtype=np.int64))


def _random_rotation(size: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng([size, seed]).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def iterative_quantisation(vectors: np.ndarray, seed: int, rounds: int = 40) -> np.ndarray:
    """Rotation that brings centred vectors closest to the corners of a cube."""
    rotation = _random_rotation(vectors.shape[1], seed)
    for _ in range(rounds):
        corners = np.where(vectors @ rotation > 0, 1.0, -1.0)
        u, _, v = np.linalg.svd(vectors.T @ corners)
        rotation = u @ v
    return rotation


def near_pairs(vectors: np.ndarray, limit: float, most: int = TEST_PAIRS) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors, and others at the cosine ``limit`` to them in random directions."""
    rng = np.random.default_rng(11)
    some = vectors[rng.permutation(len(vectors))[:most]]
    some = np.repeat(some, math.ceil(most / len(some)), axis=0)
    aside = rng.standard_normal(some.shape)
    aside -= (aside * some).sum(1, keepdims=True) * some
    length = np.sqrt((aside * aside).sum(1, keepdims=True))
    if not length.all() or some.shape[1] < 2:
        return some, some
    return some, limit * some + math.sqrt(max(0.0, 1 - limit * limit)) * aside / length


class _Codes:
    """Rotations of one dimension, learned as they are needed, and where the codes of near pairs agree."""

    def __init__(self, vectors: np.ndarray, limit: float):
        # Rotations keep the vectors they are learned from away from their borders: a fifth is for the pairs alone.
        order = np.random.default_rng(13).permutation(len(vectors))
        cut = len(vectors) // 5 if len(vectors) >= 100 else 0
        learned, asked = vectors[order[cut:]], vectors[order[:cut] if cut else order]
        self.mean = learned.mean(0)
        self.centred = learned - self.mean
        self.pairs = [x - self.mean for x in near_pairs(asked, limit)]
        self.rotations: list[np.ndarray] = []
        self.agree = np.zeros((len(self.pairs[0]), 0), bool)

    def need(self, bits: int) -> None:
        while self.agree.shape[1] < bits:
            found = iterative_quantisation(self.centred, len(self.rotations))
            self.rotations.append(found)
            a, b = (x @ found > 0 for x in self.pairs)
            self.agree = np.concatenate([self.agree, a == b], axis=1)

    def tables(self, bits: int, recall: float, most: int) -> int | None:
        """Tables that bring the wanted share of the pairs together; None if ``most`` do not."""
        apart = np.ones(len(self.agree), bool)
        for t in range(most):
            self.need((t + 1) * bits)
            apart &= ~self.agree[:, t * bits : (t + 1) * bits].all(1)
            if apart.mean() <= 1 - recall:
                return t + 1
        return None


def unit_vectors(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places and unit vectors in double precision, for each dimension that occurs."""
    lengths = np.asarray(pa.compute.list_value_length(column), np.int64)
    flat = np.asarray(column.flatten(), np.float64)
    starts = np.cumsum(lengths) - lengths
    found = []
    for size in np.unique(lengths):
        at = np.flatnonzero(lengths == size)
        some = flat[starts[at][:, None] + np.arange(size)]
        some = some / np.abs(some).max(1, keepdims=True)
        found.append((at, some / np.sqrt((some * some).sum(1, keepdims=True))))
    return found


def plan(members: DataFrame, limit: float = LIMIT, recall: float = RECALL, sample: int = TRAIN_VECTORS) -> Plan:
    """Rotations learned on about ``sample`` vectors, and tables for the largest label."""
    sizes = members.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("n"))
    row = sizes.first()
    most, n = row["most"] or 1, row["n"] or 1
    bits = min(24, max(6, round(math.log2(most / 128) if most > 128 else 0)))
    draw = F.pmod(F.col("h1"), F.lit(1_000_000)) < min(1.0, sample / n) * 1_000_000
    drawn = members.filter(draw).select("embedding").limit(2 * sample).toArrow()["embedding"].combine_chunks()
    codes = {v.shape[1]: _Codes(v, limit) for _, v in unit_vectors(drawn)} if len(drawn) else {}
    bits, tables = tables_for(list(codes.values()), bits, limit, recall)
    for code in codes.values():
        code.need(tables * bits)
    return Plan(
        tables, bits, {n: (x.mean, x.rotations[: math.ceil(tables * bits / n)]) for n, x in codes.items()}
    )


def tables_for(codes: list[_Codes], bits: int, limit: float, recall: float) -> tuple[int, int]:
    """Bits of a substring, ``bits`` at most, and tables for the wanted recall."""
    while True:
        meet = (1 - math.acos(limit) / math.pi) ** bits
        least = max(1, math.ceil(math.log(1 - recall) / math.log(1 - meet)))
        most = max(least, MOST_TABLES if bits > 1 else 4096)
        found = []
        for code in codes:
            found.append(code.tables(bits, recall, most))
            if found[-1] is None:
                break
        if None not in found:
            return bits, max([least, *found])
        if bits == 1:
            raise ValueError(f"{most} tables do not reach a recall of {recall}")
        bits -= 1


def _buckets(how: Plan):
    schema = pa.schema([
        ("node", pa.int64()), ("copies", pa.int64()), ("label", pa.int64()), ("size", pa.int32()),
        ("embedding", pa.list_(pa.float64())), ("t", pa.int32()), ("key", pa.int64()), ("keys", pa.list_(pa.int64())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, vectors in unit_vectors(batch["embedding"]) if batch.num_rows else ():
                keys = how.keys(vectors)
                some = batch.take(pa.array(at))
                unit = pa.array(vectors.tolist(), pa.list_(pa.float64()))
                every = pa.array(keys.tolist(), pa.list_(pa.int64()))
                n, size = len(at), vectors.shape[1]
                for t in range(how.tables):
                    yield pa.record_batch(
                        [some["node"], some["copies"], some["label"].cast(pa.int64()), pa.array(np.full(n, size), pa.int32()),
                         unit, pa.array(np.full(n, t), pa.int32()), pa.array(keys[:, t]), every],
                        schema=schema,
                    )

    return run


def _links(limit: float):
    schema = pa.schema([("node", pa.int64()), ("root", pa.int64()), ("n", pa.int64())])

    def one(vectors, copies, keys, t: int, side, one_slice: bool) -> tuple[np.ndarray, np.ndarray]:
        """Links of each member of a unit, and the smallest place it is connected to."""
        n = len(vectors)
        counts, root = np.zeros(n, np.int64), np.arange(n)
        for start in range(0, n, 512):
            end = min(n, start + 512)
            close = vectors[start:end] @ vectors.T >= limit
            for before in range(t):  # counted there already
                close &= keys[start:end, before, None] != keys[None, :, before]
            if not one_slice:
                close &= side[start:end, None] != side[None]
            close[np.arange(end - start), np.arange(start, end)] = False
            counts[start:end] = close @ copies
            a, b = np.nonzero(close)
            mine = np.flatnonzero(root != np.arange(n))
            root = smallest_root(n, np.concatenate([start + a, mine]), np.concatenate([b, root[mine]]))
        return counts, root

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups_of(batches, "unit", 20_000):
            unit, node = rows["unit"].to_numpy(), rows["node"].to_numpy()
            copies, t, side = rows["copies"].to_numpy(), rows["t"].to_numpy(), rows["side"].to_numpy()
            one_slice = rows["one_slice"].to_numpy(zero_copy_only=False)
            cuts = np.concatenate([[0], np.flatnonzero(unit[1:] != unit[:-1]) + 1, [len(unit)]])
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                n, part = end - start, slice(start, end)
                some = rows.slice(start, n).combine_chunks()
                vectors = np.asarray(some["embedding"].combine_chunks().flatten(), np.float64).reshape(n, -1)
                keys = np.asarray(some["keys"].combine_chunks().flatten(), np.int64).reshape(n, -1)
                counts, root = one(vectors, copies[part], keys, int(t[start]), side[part], bool(one_slice[start]))
                linked = np.flatnonzero(counts)
                if len(linked):
                    mine = node[part]
                    yield pa.record_batch([mine[linked], mine[root[linked]], counts[linked]], schema=schema)

    return run


def near_duplicates(vectors: DataFrame, limit: float = LIMIT, recall: float = RECALL, unit: int = UNIT) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row."""
    n = width(vectors.sparkSession)
    positive = F.transform("embedding", lambda x: x + F.lit(0).cast("double"))  # no negative zero
    plain = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    ).withColumn("embedding", positive)
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = F.col("label").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    plain = plain.withColumn("usable", F.coalesce(usable, F.lit(False)))
    hashed = plain.withColumn("h1", F.xxhash64("label", "embedding")).withColumn(
        "h2", F.xxhash64(F.lit(1), "embedding", "label")
    )
    members = settle(
        hashed.filter("usable")
        .groupBy("h1", "h2", "label", "embedding")
        .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
        .withColumn("node", F.monotonically_increasing_id()),  # written, so it is the same in every job
        "vectors",
    )
    how = plan(members, limit, recall)
    bucketed = members.select("node", "copies", "label", "embedding").mapInArrow(
        _buckets(how),
        "node long, copies long, label long, size int, embedding array<double>, t int, key long, keys array<long>",
    )
    bucketed = bucketed.withColumn("bucket", F.xxhash64("label", "size", "t", "key"))
    spread = F.xxhash64("node").bitwiseAND(F.lit(2**62 - 1))
    units = unit_rows(bucketed, "bucket", spread, unit).select(
        "unit", "node", "copies", "embedding", "t", "keys", "side", "one_slice"
    )
    found = settle(
        units.repartition(n, "unit").sortWithinPartitions("unit", "node").mapInArrow(
            _links(limit), "node long, root long, n long"
        ),
        "vector-links",
    )
    joined = settle(components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))), "vector-components")
    counted = found.groupBy("node").agg(F.sum("n").alias("links"))
    labelled = (
        members.select("node", "h1", "h2", "least", "copies")
        .join(joined, "node", "left")
        .join(counted, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .withColumn("links", F.coalesce("links", F.lit(0)) + F.col("copies") - 1)
    )
    smallest = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    known = settle(labelled.join(smallest, "component").select("h1", "h2", "links", "component_id"), "vector-groups")
    rows = hashed.select("vec_id", "usable", "h1", "h2")
    result = (
        rows.filter("usable").join(known, ["h1", "h2"]).select("vec_id", F.col("links").alias("n_links"), "component_id")
    ).unionByName(
        rows.filter("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    )
    return result.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
