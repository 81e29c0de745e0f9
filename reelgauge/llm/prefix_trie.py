"""Conversation prefix trie by whole-sequence collapse.

Identical conversations become one weighted sequence with the list of those
that end there; only one representative of each is ever expanded. A sequence
whose key is also a proper prefix of another one is dropped by an anti-join;
what stays are the leaves. Weighted prefixes are then aggregated to nodes.

A prefix is known by its depth and two 64-bit words: the exclusive or of the
hashes of its turns, each hashed with its position (two different prefixes
would have to agree in 128 bits). Such keys need no order of work: a whole
conversation is one hash aggregation, and running keys are made in blocks of
``BLOCK`` turns with offsets, so a conversation that holds a third of all turns
is never sorted or scanned by one task. Turns are numbered inside range
partitions of (conversation, turn) and moved up by what earlier partitions hold
of the same conversation.

What a node saves is summed over its subtree without walking it: every node is
owned by the smallest leaf below it, and each leaf hands the rest of what it
owns to the nodes on its path.

The SHA-256 of an end list takes its ids in order, as that hash must: ranges of
the sorted ids become strings of ``SEGMENT`` ids in parallel, which one task a
node feeds to the hash as they stream by.

Defined results: rows without conv_id take no part; a null role or text is an
empty one; a null turn comes first; turns of one conversation with equal
numbers, repeated rows among them, all count and stand in the order of a hash
of role and text; texts of any length are hashed whole; an empty table has no
nodes, not even a root; further columns are ignored. conv_id % 20 has the sign
of conv_id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelgauge.llm.shared import settle, table, width

WORD = r"[^\x20\x09-\x0D]+"
SPAN = 20  # conversations that share a head
HEADS = 4  # one to three turns of it, or none
BLOCK = 4096
SEGMENT = 65_536
KEY = ["depth", "k1", "k2"]
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with their number inside the conversation, as far as this partition holds it."""
    part, last, seen, first = TaskContext.get().partitionId(), None, 0, True
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        conv = batch["conv_id"].to_numpy()
        starts = np.concatenate([[0], np.flatnonzero(conv[1:] != conv[:-1]) + 1])
        at = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
        carried = seen if last is not None and conv[0] == last else 0
        at[: starts[1] if len(starts) > 1 else n] += carried
        last, seen = conv[-1], int(at[-1]) + 1
        edge = np.zeros(n, bool)
        edge[0], first = first, False
        yield pa.record_batch(
            [*(batch[x] for x in ("conv_id", "a", "b", "words")), pa.array(at), pa.array(np.full(n, part, np.int32)), pa.array(edge)],
            names=["conv_id", "a", "b", "words", "at", "part", "edge"],
        )


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, a, b, words): place from 0, two hashes of role and text, words of the text."""
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("role", "text"))
    rows = settle(
        conversations.filter(F.col("conv_id").isNotNull()).select(
            F.col("conv_id").cast("long").alias("conv_id"),
            "turn",
            F.xxhash64(F.lit(1), role, text).alias("a"),
            F.xxhash64(F.lit(2), text, role).alias("b"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
        ),
        "turn-hashes",
    )
    n = width(conversations.sparkSession)
    found = settle(
        rows.repartitionByRange(n, "conv_id", "turn")
        .sortWithinPartitions("conv_id", "turn", "a", "b")
        .mapInArrow(_numbered, "conv_id long, a long, b long, words long, at long, part int, edge boolean"),
        "turns",
    )
    # Only the conversation a partition starts with can have begun in an earlier one: one a partition.
    cut = found.filter("edge").select("conv_id").distinct()
    pieces = found.join(settle(cut, "cut"), "conv_id").groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = settle(pieces.withColumn("before", F.sum("n").over(earlier)).filter("before > 0").drop("n"), "before")
    place = F.col("at") + F.coalesce("before", F.lit(0))
    return found.join(before, ["conv_id", "part"], "left").select("conv_id", place.alias("place"), "a", "b", "words")


def _hashed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"g1": F.xxhash64("place", "a", "b"), "g2": F.xxhash64("b", "a", "place", F.lit(3))})


def rebuilt(conversations: DataFrame, span: int = SPAN, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """Conversations with the head of the one whose id is the next lower multiple of ``span``.

    Conversation c takes the first h = crc32(c) % ``heads`` turns there and its
    own after the first h. Returns the turns (conv_id, place, words, g1, g2) and
    the ids, those without any turn left included.
    """
    turns = numbered_turns(conversations)
    h = F.crc32(F.col("conv_id").cast("string")) % heads
    first = (
        turns.filter((F.col("conv_id") % span == 0) & (F.col("place") < heads - 1))
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "a", "b", "words"))).alias("first"))  # heads - 1 at most
    )
    ids = turns.filter("place = 0").select("conv_id", (F.col("conv_id") - F.col("conv_id") % span).alias("base"))
    head = F.coalesce(F.slice("first", F.lit(1), h.cast("int")), F.array())
    taken = settle(ids.join(first, "base", "left").select("conv_id", head.alias("head")), "heads")
    own = (
        turns.filter(F.col("place") >= h)
        .join(taken.select("conv_id", F.size("head").alias("k")), "conv_id")
        .withColumn("place", F.col("place") - h + F.col("k"))
        .drop("k")
    )
    given = taken.select("conv_id", F.inline("head")).select("conv_id", "place", "a", "b", "words")
    rows = _hashed(own.select(given.columns).unionByName(given)).drop("a", "b")
    return settle(rows, "rebuilt"), taken.select("conv_id")


def running(rows: DataFrame, key: str, place: str, columns: dict[str, str], how: str = "sum") -> DataFrame:
    """Add running values (``new name``: column) along ``place`` of each ``key``: ``sum`` or ``bit_xor``.

    Blocks of ``BLOCK`` places run side by side; the offsets of later blocks are
    few and joined back.
    """
    fold = {"sum": F.sum, "bit_xor": F.bit_xor}[how]

    def joined(x: Column, y: Column) -> Column:
        return x + y if how == "sum" else x.bitwiseXOR(y)

    blocked = rows.withColumn("block", F.floor(F.col(place) / BLOCK))
    inside = Window.partitionBy(key, "block").orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    long = blocked.filter("block > 0").select(key).distinct()
    totals = (
        blocked.join(long, key, "left_semi").groupBy(key, "block").agg(*[fold(c).alias(f"{n}_all") for n, c in columns.items()])
    )
    before = settle(
        totals.select(key, "block", *[fold(f"{n}_all").over(earlier).alias(f"{n}_before") for n in columns]).filter("block > 0"),
        "blocks",
    )
    local = blocked.withColumns({n: fold(c).over(inside) for n, c in columns.items()})
    whole = {n: joined(F.col(n), F.coalesce(f"{n}_before", F.lit(0).cast("long"))) for n in columns}
    return local.join(before, [key, "block"], "left").withColumns(whole).drop("block", *[f"{n}_before" for n in columns])


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids sorted by node and id, as strings of up to ``SEGMENT`` ids."""
    names = [*KEY, "first", "ids"]
    for batch in batches:  # of a bounded number of rows
        if not batch.num_rows:
            continue
        depth, k1, k2, ids = (batch[x].to_numpy() for x in (*KEY, "conv_id"))
        new = (depth[1:] != depth[:-1]) | (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
        starts = np.concatenate([[0], np.flatnonzero(new) + 1, [batch.num_rows]])
        texts = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(starts[:-1], starts[1:], strict=True)]
        some = starts[:-1]
        yield pa.record_batch([depth[some], k1[some], k2[some], ids[some], pa.array(texts)], names=names)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, node, state, done = [*KEY, "ends_sha256"], None, None, []

    def table_of(rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        return pa.record_batch([*(pa.array(x, pa.int64()) for x in columns[:3]), pa.array(columns[3])], names=names)

    for batch in batches:
        for *key, text in zip(*(batch[x].to_pylist() for x in (*KEY, "ids")), strict=True):
            if key != node:
                if state is not None:
                    done.append((*node, state.hexdigest()))
                node, state = key, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        if len(done) > 10_000:
            yield table_of(done)
            done = []
    if state is not None:
        done.append((*node, state.hexdigest()))
    if done:
        yield table_of(done)


def end_digests(ends: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256) of the sorted, comma-joined ids of each node (depth, k1, k2, conv_id)."""
    spark = ends.sparkSession
    n, order = width(spark), ["k1", "k2", "depth"]
    key = "depth long, k1 long, k2 long"
    segments = (
        ends.repartitionByRange(n, *order, "conv_id")
        .sortWithinPartitions(*order, "conv_id")
        .mapInArrow(_segments, f"{key}, first long, ids string")
    )
    return (
        segments.repartition(n, *order)
        .sortWithinPartitions(*order, "first")
        .mapInArrow(_digests, f"{key}, ends_sha256 string")
    )


def prefix_trie(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """A row for each node over ``turns`` (conv_id, place, words, g1, g2) of the conversations ``ids``."""
    none = F.lit(0).cast("long")
    ends = settle(
        turns.select("conv_id", F.lit(1).cast("long").alias("n"), "g1", "g2")
        .unionByName(ids.select("conv_id", none.alias("n"), none.alias("g1"), none.alias("g2")))
        .groupBy("conv_id")
        .agg(F.sum("n").alias("depth"), F.bit_xor("g1").alias("k1"), F.bit_xor("g2").alias("k2")),
        "ends",
    )
    sequences = settle(
        ends.groupBy(*KEY).agg(F.count(F.lit(1)).alias("weight"), F.min("conv_id").alias("rep")), "sequences"
    )
    chosen = sequences.select("rep", "weight", F.col("depth").alias("length"))
    steps = turns.join(chosen, turns["conv_id"] == chosen["rep"]).drop("conv_id")
    steps = running(steps, "rep", "place", {"k1": "g1", "k2": "g2"}, "bit_xor").select(
        "rep", "weight", "length", (F.col("place") + 1).alias("depth"), "k1", "k2",
        F.col("k1").bitwiseXOR(F.col("g1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("g2")).alias("p2"), "words",
    )
    roots = chosen.select(
        "rep", "weight", "length", none.alias("depth"), none.alias("k1"), none.alias("k2"),
        none.alias("p1"), none.alias("p2"), none.alias("words"),
    )
    paths = settle(steps.unionByName(roots), "paths")

    proper = paths.filter("depth < length").select(*KEY).distinct()
    leaves = settle(sequences.join(proper, KEY, "left_anti").select("rep", F.lit(True).alias("leaf")), "leaves")
    marked = settle(paths.join(leaves, "rep", "left"), "marked")
    nodes = settle(
        marked.groupBy(*KEY).agg(
            F.sum("weight").alias("n_convs"),
            F.min("rep").alias("conv_id"),
            F.min("p1").alias("p1"),
            F.min("p2").alias("p2"),
            F.min("words").alias("words"),
            F.count("leaf").alias("n_leaves"),
            F.min(F.when(F.col("leaf"), F.col("rep"))).alias("owner"),
        ),
        "nodes",
    )
    saving = nodes.select(F.col("owner").alias("rep"), "depth", ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    owned = settle(
        marked.filter("leaf").select("rep", *KEY).join(saving, ["rep", "depth"], "left").fillna(0, ["saved"]), "owned"
    )
    whole = owned.groupBy("rep").agg(F.sum("saved").alias("all"))
    rest = running(owned, "rep", "depth", {"upto": "saved"}).join(whole, "rep")
    below = rest.groupBy(*KEY).agg(F.sum(F.col("all") - F.col("upto") + F.col("saved")).alias("saved_tokens"))

    children = nodes.filter("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")
    ).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    return (
        nodes.join(below, KEY)
        .join(children, KEY, "left")
        .join(settle(end_digests(ends.select(*KEY, "conv_id")), "digests"), KEY, "left")
        .join(parents, ["depth", "p1", "p2"], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", none).alias("n_children"),
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
        )
    )


def trie_of(conversations: DataFrame) -> DataFrame:
    """The trie over conversations as they are."""
    turns = settle(_hashed(numbered_turns(conversations)).drop("a", "b"), "as-they-are")
    return prefix_trie(turns, turns.filter("place = 0").select("conv_id"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(*rebuilt(table(spark, sf_dir, "conversations")))
