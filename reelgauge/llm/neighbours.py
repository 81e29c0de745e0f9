"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector by ``bits`` Gaussian projections, each cut into cells of
equal width at a random offset. A query looks into its own bucket and into
perturbed ones, one cell up or down in some projections, in the order of their
estimated success: the sum of squared distances to the borders that are
crossed. What the tables bring together is merged and ranked by the exact
distance of the original vectors in double precision.

Projections, cell width, tables and probes come from a grid, as the choice that
visits least of a sample of at most ``SAMPLE`` vectors (plus the queries tried)
while it finds ``RECALL`` of the true neighbours inside that sample. Neighbours
are farther apart in a sample than in the whole, so the whole is not harder.

Vectors are indexed once a table, in shards: ranges of bucket keys with borders
from the sample; a bucket that spans several borders is dealt to all of them by
a hash. A query goes to the shards of its probes, with the keys it asks there,
and to all shards of a bucket. A shard holds its queries, ``BLOCK`` at most at a
time, and lets the vectors stream by; every query of it keeps its best ones.
Candidate pairs never become rows. More queries in a shard mean more blocks,
each of which reads the shard's vectors: no bucket, probe or candidate is left
out.

Of equal vectors the ``k`` + 1 smallest ids stand for all (no result has room
for more); queries with equal vectors are answered once.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components take no part, as query or candidate; vectors of another length are
no candidates; a null vec_id is a candidate (its id comes after all others at
equal distance) and no query; of repeated rows each is a query, and the others
are its candidates; fewer candidates than k give all of them; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelgauge.llm.shared import settle, table, width

K = 10
EVERY = 100  # each such vec_id is a query
RECALL = 0.95  # on the sample
SAMPLE = 20_000
SAMPLED_VALUES = 4_000_000  # components of the sample: long vectors are sampled less often
TRIED = 100  # queries of the sample that choose the plan
VISITED = 4000  # vectors of the sample that tell how much a plan visits
MOST_TABLES = 8
PROBES = (16, 64, 256, 512)
BLOCK = 4096
SHARD = 65_536
LEAST_SHARDS = 32
MOST_SHARDS = 100_000


def probe_sets(bits: int, most: int) -> np.ndarray:
    """The ``most`` likeliest sets of borders to cross, as rows of 0/1 over 2 x bits ranks of border distance.

    The squares of sorted distances are taken at their expected values. Ranks j
    and 2 x bits - 1 - j are the two borders of one cell, so not both.
    """
    j = np.arange(1, bits + 1)
    near = j * (j + 1) / (4 * (bits + 1) * (bits + 2))
    far = 1 - j / (bits + 1) + near
    score = np.concatenate([near, far[::-1]])
    found, heap = [()], [(score[0], (0,))]
    while heap and len(found) < most:
        total, ranks = heapq.heappop(heap)
        if all(2 * bits - 1 - x not in ranks for x in ranks):
            found.append(ranks)
        last = ranks[-1]
        if last + 1 < 2 * bits:
            heapq.heappush(heap, (total - score[last] + score[last + 1], (*ranks[:-1], last + 1)))
            heapq.heappush(heap, (total + score[last + 1], (*ranks, last + 1)))
    sets = np.zeros((len(found), 2 * bits), np.int64)
    for row, ranks in enumerate(found):
        sets[row, list(ranks)] = 1
    return sets


@dataclass(frozen=True)
class Table:
    """Projections of one dimension. A key holds the cells in order, so neighbouring keys share leading cells."""

    lines: np.ndarray  # dimension x bits
    shift: np.ndarray
    cell: float

    def at(self, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.lines / self.cell + self.shift

    def keys(self, cells: np.ndarray) -> np.ndarray:
        """Cells (last axis) side by side in 62 bits; cells beyond the room of a projection count as its outermost."""
        bits = cells.shape[-1]
        room = 62 // bits
        half = 1 << (room - 1)
        places = (np.clip(cells, -half, half - 1) + half).astype(np.int64)
        return places @ (1 << (room * np.arange(bits - 1, -1, -1, dtype=np.int64)))

    def bucket(self, vectors: np.ndarray) -> np.ndarray:
        return self.keys(np.floor(self.at(vectors)))

    def probes(self, vectors: np.ndarray, sets: np.ndarray, most: int) -> np.ndarray:
        """Keys of the ``most`` likeliest buckets of each vector, in that order."""
        place = self.at(vectors)
        cell = np.floor(place)
        low = place - cell
        n, bits = low.shape
        square = np.concatenate([low, 1 - low], axis=1) ** 2
        order = np.argsort(square, axis=1)
        ranked = np.take_along_axis(square, order, 1)
        # ``sets`` are likely ones in general; here they are weighed by the query's own distances.
        best = np.argsort(ranked @ sets.T, axis=1, kind="stable")[:, :most]
        step = np.where(order < bits, -1, 1)
        moves = np.zeros((n, best.shape[1], bits), np.int64)
        rows = np.arange(n)
        for rank in range(2 * bits):
            moves[rows, :, order[:, rank] % bits] += sets[best, rank] * step[:, rank, None]
        return self.keys(cell[:, None, :] + moves)


@dataclass(frozen=True)
class Plan:
    tables: dict[int, list[Table]]  # by dimension
    probes: dict[int, int]
    borders: dict[tuple[int, int], np.ndarray]  # by dimension and table: sorted keys that begin a shard
    first: dict[tuple[int, int], int]  # number of the first shard
    shards: int

    def sets(self, size: int) -> np.ndarray:
        return probe_sets(self.tables[size][0].lines.shape[1], 2 * self.probes[size])

    def span(self, size: int, t: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last shard of keys."""
        borders, first = self.borders[size, t], self.first[size, t]
        return first + np.searchsorted(borders, keys, side="left"), first + np.searchsorted(borders, keys, side="right")


def tables_of(sample: np.ndarray, bits: int, cell: float, count: int) -> list[Table]:
    """Random tables, their cells counted from the middle of the sample."""
    rng = np.random.default_rng([sample.shape[1], bits, 7])
    found = []
    for _ in range(count):
        lines = rng.standard_normal((sample.shape[1], bits))
        middle = np.floor(np.median(sample[:1000] @ lines / cell, axis=0))
        found.append(Table(lines, rng.random(bits) - middle, cell))
    return found


def true_neighbours(asked: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    apart = (asked * asked).sum(1)[:, None] + (vectors * vectors).sum(1)[None] - 2 * asked @ vectors.T
    near = np.argpartition(apart, k - 1, axis=1)[:, :k]
    return near, np.sqrt(np.maximum(np.take_along_axis(apart, near, 1), 0))


def choose(sample: np.ndarray, recall: float = RECALL, k: int = K) -> tuple[list[Table], int]:
    """Tables and probes that visit least of the sample for the wanted recall."""
    held = sample[TRIED:] if len(sample) > 2 * TRIED else sample
    asked = sample[: min(TRIED, len(sample))]
    near, distance = true_neighbours(asked, held, min(k, len(held)))
    some = held[:VISITED]
    positive = distance[distance > 0]
    spread = [float(x) for x in np.quantile(positive, (0.5, 0.9, 1.0))] if len(positive) else [1.0]
    # Pairs much wider apart than most need cells of their own width.
    wide = [spread[0], *(x for x in spread[1:] if x > 1.3 * spread[0])]
    best = None
    for bits in (1, 2, 4, 6, 8, 10, 12, 16):
        sets = probe_sets(bits, 2 * PROBES[-1])
        for cell in (x * times for x in wide for times in (0.5, 1.0, 1.5, 2.0, 3.0)):
            first_near = np.full(near.shape, PROBES[-1])
            first_some = np.full((len(asked), len(some)), PROBES[-1], np.int32)
            for count, one in enumerate(tables_of(held, bits, cell, MOST_TABLES), 1):
                buckets, at_some = np.unique(one.bucket(some), return_inverse=True)
                of_near = one.bucket(held[near.ravel()]).reshape(near.shape)
                for row, keys in enumerate(one.probes(asked, sets, PROBES[-1])):
                    keys, order = np.unique(keys, return_index=True)  # the place in probing order, first of equal ones
                    for wanted, first in ((buckets, None), (of_near[row], first_near)):
                        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                        place = np.where(keys[at] == wanted, order[at], PROBES[-1])
                        if first is None:
                            np.minimum(first_some[row], place[at_some], out=first_some[row])
                        else:
                            first[row] = np.minimum(first[row], place)
                reached = [probes for probes in PROBES if (first_near < probes).mean() >= recall]
                if reached:
                    # A table also costs its copy of the vectors.
                    cost = (first_some < reached[0]).mean() + 0.01 * count
                    if best is None or cost < best[0]:
                        best = cost, one.cell, bits, count, reached[0]
                    break
                if (first_near < PROBES[-1]).mean() * MOST_TABLES < recall * count:
                    break  # cells too narrow for any number of tables
    if best:
        _, cell, bits, count, probes = best
        return tables_of(held, bits, cell, count), probes
    return tables_of(held, 1, 1e6 * (float(np.abs(held).max()) or 1.0), 1), PROBES[0]  # one bucket: all pairs


def plan(members: DataFrame, recall: float = RECALL, k: int = K, sample: int = SAMPLE, shard: int = SHARD) -> Plan:
    """Tables and shards for every dimension, from samples of their vectors."""
    sizes = {x["size"]: x["n"] for x in members.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}  # dimensions
    tables, probes, borders, first, shards = {}, {}, {}, {}, 0
    for size, n in sorted(sizes.items()):
        most = max(10 * TRIED, min(sample, SAMPLED_VALUES // size))
        draw = F.pmod(F.col("h1"), F.lit(1_000_000)) < min(1.0, most / n) * 1_000_000
        drawn = members.filter((F.col("size") == size) & draw).select("embedding", "h1").limit(2 * most).toArrow().sort_by("h1")
        some = np.asarray(drawn["embedding"].combine_chunks().flatten(), np.float64).reshape(-1, size)
        some = some[np.random.default_rng(3).permutation(len(some))]
        if not len(some):  # few vectors, none of them drawn
            some = np.ones((1, size))
        tables[size], probes[size] = choose(some, recall, k)
        wanted = min(MOST_SHARDS, max(LEAST_SHARDS, math.ceil(n * len(tables[size]) / shard)))
        each = max(1, wanted // len(tables[size]))
        for t, one in enumerate(tables[size]):
            keys = np.sort(one.bucket(some))
            borders[size, t] = keys[(np.arange(1, each) * len(keys)) // each]
            first[size, t] = shards
            shards += each
    return Plan(tables, probes, borders, first, shards)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, size)


def _by_size(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    for batch in batches:
        sizes = batch["size"].to_numpy()
        for size in np.unique(sizes):
            yield int(size), batch.filter(pa.array(sizes == size))


def _row(kind: str) -> tuple[str, pa.Schema]:
    """Rows of a shard: queries (kind 0) with the keys they ask there, vectors (kind 1) with their key."""
    element = {"float": pa.float32(), "double": pa.float64()}[kind]
    schema = pa.schema([
        ("shard", pa.int64()), ("block", pa.int32()), ("kind", pa.int32()), ("key", pa.int64()), ("id", pa.int64()),
        ("vec_id", pa.int64()), ("size", pa.int32()), ("keys", pa.list_(pa.int64())), ("embedding", pa.list_(element)),
    ])
    return (
        "shard long, block int, kind int, key long, id long, vec_id long, size int, keys array<long>, "
        f"embedding array<{kind}>"
    ), schema


def _asked(how: Plan, schema: pa.Schema):
    """A row for each query and shard, with the keys it asks there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for size, batch in _by_size(batches):
            vectors, sets = _matrix(batch["embedding"], size), how.sets(size)
            shard, keys, row = [], [], []
            for t, one in enumerate(how.tables[size]):
                for i, found in enumerate(one.probes(vectors, sets, how.probes[size])):
                    mine = np.unique(found)
                    low, high = how.span(size, t, mine)
                    for s in range(int(low[0]), int(high[-1]) + 1):
                        some = mine[np.searchsorted(high, s, "left") : np.searchsorted(low, s, "right")]
                        if len(some):
                            shard.append(s)
                            keys.append(some)
                            row.append(i)
            n, some = len(row), batch.take(pa.array(row, pa.int64()))
            zero = pa.array(np.zeros(n, np.int32))
            yield pa.record_batch(
                [pa.array(shard, pa.int64()), zero, zero, zero.cast(pa.int64()), some["id"], some["vec_id"],
                 pa.array(np.full(n, size, np.int32)), pa.array(keys, pa.list_(pa.int64())), some["embedding"]],
                schema=schema,
            )

    return run


def _mixed(ids: np.ndarray) -> np.ndarray:
    return ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)


def _blocked(blocks: np.ndarray, schema: pa.Schema):
    """Queries of a shard dealt to its blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = _mixed(batch["id"].to_numpy()) % blocks[batch["shard"].to_numpy()]
            yield pa.record_batch([batch[0], pa.array(block.astype(np.int32)), *batch.columns[2:]], schema=schema)

    return run


def _held(how: Plan, blocks: np.ndarray, schema: pa.Schema):
    """A row for each vector, table and block of queries of its shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for size, batch in _by_size(batches):
            vectors, spread = _matrix(batch["embedding"], size), _mixed(batch["id"].to_numpy())
            for t, one in enumerate(how.tables[size]):
                key = one.bucket(vectors)
                low, high = how.span(size, t, key)
                shard = low + spread % (high - low + 1)  # a bucket over several shards is dealt to them
                count = blocks[shard]
                row = np.repeat(np.arange(len(key)), count)
                n, some = len(row), batch.take(pa.array(row))
                block = np.arange(n) - np.repeat(np.cumsum(count) - count, count)
                none = pa.ListArray.from_arrays(pa.array(np.zeros(n + 1, np.int32)), pa.array([], pa.int64()))
                yield pa.record_batch(
                    [pa.array(shard[row]), pa.array(block.astype(np.int32)), pa.array(np.ones(n, np.int32)), pa.array(key[row]),
                     some["id"], some["vec_id"], pa.array(np.full(n, size, np.int32)), none, some["embedding"]],
                    schema=schema,
                )

    return run


class _Nearest:
    """The queries of a block, and the best candidates each has met: by distance, then vec_id."""

    def __init__(self, ids: np.ndarray, keys: list[np.ndarray], vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.norms = (vectors * vectors).sum(1)
        query = np.repeat(np.arange(len(keys)), np.fromiter(map(len, keys), np.int64, len(keys)))
        flat = np.concatenate(keys)
        order = np.argsort(flat, kind="stable")
        self.keys, self.query = flat[order], query[order]
        self.best = np.full((len(ids), k), np.inf)
        self.best_id = np.full((len(ids), k), -1, np.int64)
        self.best_name = np.full((len(ids), k), np.iinfo(np.int64).max)

    def meet(self, ids: np.ndarray, names: np.ndarray, keys: np.ndarray, vectors: np.ndarray) -> None:
        """Vectors sorted by key."""
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1), len(keys)]
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            low, high = np.searchsorted(self.keys, keys[start]), np.searchsorted(self.keys, keys[start], "right")
            for at in range(low, high, 1024):
                self._rank(self.query[at : min(high, at + 1024)], ids[start:end], names[start:end], vectors[start:end])

    def _rank(self, queries: np.ndarray, ids: np.ndarray, names: np.ndarray, vectors: np.ndarray) -> None:
        # A product tells which pairs may be among the best; those are measured exactly.
        norms = (vectors * vectors).sum(1)
        rough = self.norms[queries, None] + norms[None] - 2 * self.vectors[queries] @ vectors.T
        slack = 1e-9 * (self.norms[queries, None] + norms[None])
        limit = (self.best[queries, -1] ** 2 * (1 + 1e-12))[:, None]
        if len(ids) > self.k:
            limit = np.minimum(limit, np.partition(rough + slack, self.k - 1, axis=1)[:, self.k - 1 : self.k])
        row, column = np.nonzero(~(rough - slack > limit))  # what overflows stays in
        if not len(row):
            return
        apart = self.vectors[queries[row]] - vectors[column]
        exact = np.sqrt((apart * apart).sum(1))
        touched, place = np.unique(row, return_inverse=True)
        some = queries[touched]
        query = np.concatenate([np.repeat(np.arange(len(some)), self.k), place])
        columns = [
            np.concatenate([known[some].ravel(), new])
            for known, new in ((self.best, exact), (self.best_name, names[column]), (self.best_id, ids[column]))
        ]
        # A free place (id -1) comes after a candidate without vec_id at an overflown distance.
        order = np.lexsort([columns[2], columns[2] < 0, columns[1], columns[0], query])
        query = query[order]
        rank = np.arange(len(query)) - np.searchsorted(query, np.arange(len(some)))[query]
        kept = rank < self.k
        for known, new in zip((self.best, self.best_name, self.best_id), columns, strict=True):
            known[some[query[kept]], rank[kept]] = new[order][kept]

    def found(self) -> list[np.ndarray]:
        row, column = np.nonzero(self.best_id >= 0)
        return [self.ids[row], self.best_id[row, column], self.best_name[row, column], self.best[row, column]]


def _meet(k: int):
    schema = pa.schema([("query", pa.int64()), ("id", pa.int64()), ("name", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, waiting, nearest = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            shard, block, kind = (batch[x].to_numpy() for x in ("shard", "block", "kind"))
            change = (shard[1:] != shard[:-1]) | (block[1:] != block[:-1]) | (kind[1:] != kind[:-1])
            cuts = [0, *(np.flatnonzero(change) + 1), batch.num_rows]
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                if (shard[start], block[start]) != unit:
                    if nearest:
                        yield pa.record_batch(nearest.found(), schema=schema)
                    unit, waiting, nearest = (shard[start], block[start]), [], None
                part, size = batch.slice(start, end - start), int(batch["size"][start].as_py())
                ids, vectors = part["id"].to_numpy(), _matrix(part["embedding"], size)
                if kind[start] == 0:
                    waiting.append((ids, list(part["keys"].to_numpy(zero_copy_only=False)), vectors))
                    continue
                if not waiting:
                    continue  # the hash left this block without a query
                if nearest is None:
                    names, keys, rows = zip(*waiting, strict=True)
                    nearest = _Nearest(np.concatenate(names), sum(keys, []), np.concatenate(rows), k)
                nearest.meet(ids, part["vec_id"].to_numpy(), part["key"].to_numpy(), vectors)
        if nearest:
            yield pa.record_batch(nearest.found(), schema=schema)

    return run


def nearest(
    vectors: DataFrame, asks: Column, k: int = K, recall: float = RECALL, sample: int = SAMPLE, block: int = BLOCK, shard: int = SHARD
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for every row where ``asks`` holds."""
    n = width(vectors.sparkSession)
    kind = "float" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    schema, arrow = _row(kind)
    plain = F.transform(F.col("embedding").cast(f"array<{kind}>"), lambda x: x + F.lit(0).cast(kind))  # no negative zero
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), plain.alias("embedding"), F.coalesce(asks, F.lit(False)).alias("asks")
    ).filter(F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False)))
    rows = settle(
        usable.withColumns({
            "h1": F.xxhash64("embedding"),
            "h2": F.xxhash64(F.lit(1), "embedding"),
            "size": F.size("embedding"),
            "row": F.monotonically_increasing_id(),  # written, so it is the same in every job
        }),
        "vectors",
    )
    last = F.coalesce("vec_id", F.lit(2**63 - 1).cast("long"))
    # The first of equal vectors, by id, stands for them.
    repeated = settle(
        rows.groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col("vec_id").isNull(), "vec_id", "row")).alias("first"))
        .filter("n > 1")
        .select("h1", "h2", F.col("first.row").alias("first")),
        "repeated",
    )
    members = rows.join(repeated, ["h1", "h2"], "left").filter("first IS NULL OR first = row").select(
        F.col("row").alias("id"), last.alias("vec_id"), "h1", "size", "embedding"
    )
    how = plan(members, recall, k, sample, shard)

    asking = rows.filter("asks AND vec_id IS NOT NULL")
    one = settle(asking.groupBy("h1", "h2").agg(F.min("row").alias("query")), "queries")
    questions = settle(
        asking.join(one.select(F.col("query").alias("row")), "row", "left_semi")
        .select(F.col("row").alias("id"), "vec_id", "size", "embedding")
        .mapInArrow(_asked(how, arrow), schema),
        "questions",
    )
    blocks = np.zeros(how.shards, np.int64)
    for x in questions.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect():  # a number a shard
        blocks[x["shard"]] = -(-x["n"] // block)
    held = members.select("id", "vec_id", "size", "embedding").mapInArrow(_held(how, blocks, arrow), schema)
    met = settle(
        questions.mapInArrow(_blocked(blocks, arrow), schema)
        .unionByName(held)
        .repartition(n, "shard", "block")
        .sortWithinPartitions("shard", "block", "kind", "key")
        .mapInArrow(_meet(k + 1), "query long, id long, name long, score double"),
        "met",
    )
    # Of k + 1 vectors each has a row before what follows them: they hold the k + 1 nearest rows.
    by_vector = Window.partitionBy("query").orderBy("score", "name", "id")
    answers = met.distinct().withColumn("place", F.row_number().over(by_vector)).filter(F.col("place") <= k + 1)

    named = rows.select("h1", "h2", "vec_id", "row").join(repeated, ["h1", "h2"], "left")
    copies = Window.partitionBy("first").orderBy(F.col("vec_id").asc_nulls_last(), "row")
    several = named.filter("first IS NOT NULL").withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= k + 1)
    single = named.filter("first IS NULL").select(F.col("row").alias("id"), "vec_id", "row")
    known = single.unionByName(several.select(F.col("first").alias("id"), "vec_id", "row"))
    order = ["score", F.col("vec_id").asc_nulls_last(), "row"]
    by_row = Window.partitionBy("query").orderBy(*order)
    nearby = settle(
        answers.select("query", "id", "score")
        .join(known, "id")
        .withColumn("place", F.row_number().over(by_row))
        .filter(F.col("place") <= k + 1)
        .select("query", "vec_id", "row", "score"),
        "answers",
    )
    each = asking.select(F.col("vec_id").alias("query_id"), F.col("row").alias("own"), "h1", "h2").join(one, ["h1", "h2"])
    mine = Window.partitionBy("own").orderBy(*order)
    return (
        each.join(nearby, "query")
        .filter("row <> own")
        .withColumn("rank", F.row_number().over(mine))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)
