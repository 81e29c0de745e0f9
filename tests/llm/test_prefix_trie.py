import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from oracle.compare import connect
from reelgauge.llm import prefix_trie as P
from reelgauge.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, depth int, k1 string, place long, words string"


def plain_rebuilt(rows):
    """Conversations (conv_id, turn, role, text) rebuilt by the contract; turns are distinct in number."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in turns.items()}
    made = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = turns.get(c - c % 20, [])[:h] + own[h:]
    return made


def plain_trie(conversations):
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(node[:-1] for node in members if node)
    rows = []
    for node, convs in members.items():
        below = [x for x in members if x[: len(node)] == node]
        ends = ",".join(map(str, sorted(c for c in convs if len(conversations[c]) == len(node))))
        rows.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), children[node],
            sum(not children[x] for x in below),
            sum((len(members[x]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", x[-1][1])) for x in below if x),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(rows, key=str)


NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def got(frame):
    assert frame.columns == NAMES
    return sorted(map(tuple, frame.collect()), key=str)


def wide(spark, rows):
    return spark.createDataFrame([(*x, 1, "k", 5, "w") for x in rows], SCHEMA).repartition(3)


def test_query_equals_plain_version(spark, sf_dir):
    rows = connect(sf_dir).execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    assert got(QUERIES["op11_prefix_trie"](spark, sf_dir)) == plain_trie(plain_rebuilt(rows))


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(P, "BLOCK", 3)


def test_odd_rows_and_shared_heads(spark, small_blocks):
    long = "many words " * 200_000
    rows = [
        (20, 0, "user", "a b"), (20, 1, "assistant", "c"), (20, 2, "user", "d e f"), (20, 3, "user", "g"),
        (21, 0, "user", "own first"), (22, 5, "user", "x"), (22, None, None, None), (22, 6, "", ""),
        (23, 0, "user", "a b"), (23, 1, "assistant", "c"), (40, 0, "user", "short base"), (41, 0, "user", "z"),
        (42, 0, "a", "bc"), (42, 1, "ab", "c"), (42, 2, "user", "t"), (42, 3, "user", "u"), (65, 0, "user", long),
        (None, 0, "user", "no id"), (None, 1, None, None), (-5, 0, "user", "below"), (66, 0, "user", "a b"),
        *[(c, t, "user", f"turn {t} of a long one") for c in (101, 102, 103) for t in range(11)],
        *[(104, t, "user", f"turn {t} of a long one") for t in range(7)],
    ]
    made = plain_rebuilt([x for x in rows if x[0] != -5])
    made[-5] = [("user", "below")][zlib.crc32(b"-5") % 4 :]  # -5 - (-5 % 20) is 0, which is absent
    frame = wide(spark, rows)
    assert got(P.prefix_trie(*P.rebuilt(frame))) == plain_trie(made)
    as_they_are = defaultdict(list)
    for c, t, role, text in sorted((x for x in rows if x[0] is not None), key=lambda x: (x[0], x[1] is not None, x[1] or 0)):
        as_they_are[c].append((role or "", text or ""))
    assert got(P.trie_of(frame)) == plain_trie(as_they_are)


def test_ties_and_repeated_rows_all_count(spark):
    rows = [(1, 0, "user", "p"), (1, 0, "user", "p"), (1, 0, "user", "q"), (2, 0, "user", "q"), (2, 0, "user", "p"), (2, 0, "user", "p")]
    found = P.trie_of(wide(spark, rows)).collect()
    assert sorted((x.depth, x.n_convs) for x in found) == [(0, 2), (1, 2), (2, 2), (3, 2)]


def test_empty_table(spark):
    assert P.prefix_trie(*P.rebuilt(spark.createDataFrame([], SCHEMA))).collect() == []


def test_one_conversation_with_most_turns_is_shared_out(spark, small_blocks):
    rows = [(7, t, "user", f"t{t}") for t in range(3000)] + [(c, 0, "user", "x") for c in range(100, 120)]
    turns = P.numbered_turns(wide(spark, rows))
    assert sorted(x.place for x in turns.filter("conv_id = 7").collect()) == list(range(3000))
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    parts = (
        frame.repartitionByRange(8, "conv_id", "turn").groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count"))
    )
    assert parts.first()[0] < 1000
    deepest = P.trie_of(wide(spark, rows)).agg(F.max("depth"), F.count("*"), F.sum("n_convs")).first()
    assert tuple(deepest) == (3000, 3002, 21 + 3000 + 20)


def test_end_digests_of_many_ids(spark):
    ids = spark.range(100_000).select(F.lit(2).cast("long").alias("depth"), F.lit(5).cast("long").alias("k1"),
                                      F.lit(-6).cast("long").alias("k2"), F.col("id").alias("conv_id"))
    row = P.end_digests(ids.repartition(5)).collect()
    assert [x.ends_sha256 for x in row] == [hashlib.sha256(",".join(map(str, range(100_000))).encode()).hexdigest()]
