"""SimHash near duplicates through a Gray-ordered hierarchical index.

Fingerprints within ``REACH`` = 3 differing bits agree on at least one of four
16-bit quarters, so each distinct fingerprint goes to four buckets, one for a
quarter, and every bucket of two or more is a tree of the task's index. There
fingerprints are sorted by Gray rank, which puts values of few differences side
by side. Groups of neighbours keep the bits all their members share in one node
(mask and pattern), groups of groups likewise, and a child only holds the bits
its parent has not. A query goes down the tree of its bucket, adds up the
differences and leaves a whole group as soon as they exceed the reach; all
queries of a task go down together, level by level. Buckets above ``UNIT``
members are cut into slices that meet pairwise, so no tree holds more than a
slice and no link is lost.

Defined results: very long texts are read whole, their hashes summed in parts; null and empty texts have fingerprint 0 and link like others;
a component takes its smallest non-null doc_id (null if it has none); repeated
rows are members like others; an empty table gives no rows; further columns of
any name pass through ``one_of_each_group`` and are ignored elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgauge.llm.shared import components, groups_of, settle, smallest_root, table, unit_rows, width

WORDS = 3
REACH = 3
SEED = 42
UNIT = 4096
LEAF, FAN = 4, 4
AT_ONCE = 250_000  # members of the trees asked by one block of queries, and links held before they are united


def fingerprint(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """Majority of the bits of the hashes of all word shingles."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    if len(found) < words:
        found = [b" ".join(found)]
    else:
        found = [b" ".join(x) for x in zip(*(found[i:] for i in range(words)), strict=False)]
    hashes = np.array([xxhash.xxh64_intdigest(x, seed) for x in found], "<u8")
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 65536):
        some = hashes[start : start + 65536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(some, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, kept = batch[0], 1
            if pa.types.is_struct(texts.type):  # the text of a whole row
                texts, kept = texts.field("text").cast(pa.string()), 0
            found = np.fromiter((fingerprint(x.as_py(), words) for x in texts), np.uint64, batch.num_rows)
            names = [*batch.schema.names[kept:], "fp"]
            yield pa.record_batch([*batch.columns[kept:], pa.array(found.view(np.int64))], names=names)

    return run


def with_fingerprint(documents: DataFrame, words: int = WORDS, whole: bool = False) -> DataFrame:
    """(id, fp), or (row, number, id, fp) with the whole row as a struct; written to the shared folder."""
    number = F.monotonically_increasing_id().alias("number")
    first = [F.struct("*").alias("row"), number] if whole else [F.col("text").cast("string").alias("_text")]
    narrow = documents.select(*first, F.col("doc_id").cast("long").alias("id"))
    schema = narrow.drop("_text").schema.add("fp", "long")
    return settle(narrow.mapInArrow(_fingerprints(words), schema), "fingerprints")


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Place of a value in the reflected Gray order."""
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each range, one range after the other."""
    before = np.cumsum(count) - count
    return np.repeat(first - before, count) + np.arange(int(count.sum()))


class GrayIndex:
    """Trees over values in Gray order, one for each of ``trees``; level 0 holds the leaves."""

    def __init__(self, values: np.ndarray, trees: np.ndarray | None = None):
        trees = np.zeros(len(values), np.int64) if trees is None else trees
        self.order = np.lexsort((gray_rank(values), trees))
        self.values, tree = values[self.order], trees[self.order]
        low = high = self.values
        self.first: list[np.ndarray] = []  # of each node, its first child a level below and how many it has
        self.count: list[np.ndarray] = []
        self.pattern: list[np.ndarray] = []  # ones that all members share
        self.residual: list[np.ndarray] = []  # bits on which all members agree and the parent's do not
        while len(tree) and (not self.first or (tree[1:] == tree[:-1]).any()):
            begins = np.flatnonzero(np.append(True, tree[1:] != tree[:-1]))
            place = np.arange(len(tree)) - np.repeat(begins, np.diff(np.append(begins, len(tree))))
            starts = np.flatnonzero(place % (FAN if self.first else LEAF) == 0)
            low, high = np.bitwise_and.reduceat(low, starts), np.bitwise_or.reduceat(high, starts)
            tree = tree[starts]
            self.first.append(starts)
            self.count.append(np.diff(np.append(starts, len(place))))
            self.pattern.append(low)
            self.residual.append(low | ~high)
        for height in range(len(self.first) - 1):
            self.residual[height] &= ~np.repeat(self.residual[height + 1], self.count[height + 1])
        self.tree = tree  # one node of the top level for each tree
        self.compared = 0  # members compared with a query, of all there are in its tree

    def near(self, queries: np.ndarray, reach: int, trees: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(query, member) places of all pairs within ``reach`` of a query and its tree."""
        trees = np.zeros(len(queries), np.int64) if trees is None else trees
        node = np.searchsorted(self.tree, trees)
        query = np.flatnonzero(node < len(self.tree))
        query = query[self.tree[node[query]] == trees[query]]
        node, apart = node[query], np.zeros(len(query), np.int64)
        for height in range(len(self.first) - 1, -1, -1):
            apart = apart + np.bitwise_count((queries[query] ^ self.pattern[height][node]) & self.residual[height][node])
            close = apart <= reach
            query, node, apart = query[close], node[close], apart[close]
            first, count = self.first[height][node], self.count[height][node]
            query, apart, node = np.repeat(query, count), np.repeat(apart, count), _ranges(first, count)
        self.compared += len(query)
        close = np.bitwise_count(queries[query] ^ self.values[node]) <= reach
        return query[close], self.order[node[close]]


def _blocks(sizes: np.ndarray) -> Iterator[slice]:
    """Runs of queries whose trees have about ``AT_ONCE`` members together."""
    part = np.cumsum(sizes) // AT_ONCE
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(sizes)]])
    return (slice(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if a < b)


def link_places(values: np.ndarray, unit: np.ndarray, side: np.ndarray, one: np.ndarray, reach: int):
    """Places (a, b) of links that connect, in each unit, all that are within ``reach``; ``unit`` is sorted.

    Members of side 0 are the trees. In a unit of one slice they are the queries
    too, in the others those of side 1 are.
    """
    n = len(values)
    starts = np.append(True, unit[1:] != unit[:-1])
    tree = np.cumsum(starts) - 1
    stored, asking = np.flatnonzero(side == 0), np.flatnonzero(one | (side == 1))
    index = GrayIndex(values[stored], tree[stored])
    sizes = np.bincount(tree[stored], minlength=int(tree[-1]) + 1)[tree[asking]]
    a = b = np.zeros(0, np.int64)
    for block in _blocks(sizes):
        some = asking[block]
        query, member = index.near(values[some], reach, tree[some])
        query, member = some[query], stored[member]
        other = (query != member) & (~one[query] | (query < member))
        a, b = np.concatenate([a, query[other]]), np.concatenate([b, member[other]])
        if len(a) > AT_ONCE:
            root = smallest_root(n, a, b)
            a = np.flatnonzero(root != np.arange(n))
            b = root[a]
    return a, b


def _links(reach: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups_of(batches, "unit"):
            values = rows["fp"].to_numpy().view(np.uint64)
            one = rows["one_slice"].to_numpy(zero_copy_only=False)
            a, b = link_places(values, rows["unit"].to_numpy(), rows["side"].to_numpy(), one, reach)
            yield pa.record_batch([pa.array(values[a].view(np.int64)), pa.array(values[b].view(np.int64))], schema=schema)

    return run


def link_units(fingerprints: DataFrame, reach: int = REACH, unit: int = UNIT) -> DataFrame:
    """Fingerprints of each unit, in a row; links are to be found inside it."""
    if reach > 3:
        raise ValueError("four quarters find at most three differing bits")
    quarter = F.expr("shiftrightunsigned(fp, q * 16) & 65535")
    members = fingerprints.select("fp", F.explode(F.array(*map(F.lit, range(4)))).alias("q")).select(
        "fp", (F.col("q") * 65536 + quarter).alias("bucket")
    )
    spread = F.xxhash64("fp").bitwiseAND(F.lit(2**62 - 1))
    units = unit_rows(members, "bucket", spread, unit).select("unit", "fp", "side", "one_slice")
    return units.repartition(width(fingerprints.sparkSession), "unit").sortWithinPartitions("unit")


def links(fingerprints: DataFrame, reach: int = REACH, unit: int = UNIT) -> DataFrame:
    """Links (a, b) that connect what is within ``reach``; not all pairs of a dense group."""
    return link_units(fingerprints, reach, unit).mapInArrow(_links(reach), "a long, b long")


def groups(found: DataFrame, reach: int = REACH, unit: int = UNIT) -> DataFrame:
    """(fp, label, component_id) for each distinct fingerprint of ``found`` (id, fp)."""
    distinct = settle(found.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    joined = components(link_units(distinct.select("fp"), reach, unit), made=_links(reach))
    labelled = distinct.join(joined, distinct["fp"] == joined["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("label")
    )
    smallest = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    return settle(labelled.select("fp", "label").join(smallest, "label"), "groups")


def near_duplicates(documents: DataFrame, words: int = WORDS, reach: int = REACH, unit: int = UNIT) -> DataFrame:
    """(doc_id, fingerprint, component_id), a row for each document."""
    found = with_fingerprint(documents, words)
    return found.join(groups(found, reach, unit), "fp").select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_of_each_group(documents: DataFrame, words: int = WORDS, reach: int = REACH) -> DataFrame:
    """The rows of ``documents`` without near duplicates.

    Of each group the row with the smallest doc_id stays (nulls last); among
    rows of that id one of them.
    """
    numbered = with_fingerprint(documents, words, whole=True)  # the number of a row is written with it
    groups_found = groups(numbered.select("id", "fp"), reach)
    first = (
        numbered.select("number", "id", "fp")
        .join(groups_found.select("fp", "label"), "fp")
        .groupBy("label")
        .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "number")).alias("first"))
    )
    staying = settle(first.select("first.number"), "staying")
    # Shuffled at every size: the decisions of a whole corpus never fit a broadcast.
    return numbered.join(staying.hint("merge"), "number", "left_semi").select("row.*")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
