"""Spelling variants by search schemes over a bidirectional FM-index of the vocabulary.

One error lies in one half of a word, so the other half stands unchanged: the
scheme "left half" matches it from the delimiter before a word, extends across
the right half with at most one inserted, deleted or replaced code point and
ends at the delimiter behind; the scheme "right half" does the same from the
other side. An index is a pair: the transform of the words serves extension to
the left, that of the reversed words extension to the right. What has been
matched is an interval of suffix ranks of the delimited vocabulary, for many
words side by side as arrays.

The vocabulary is cut into shards for either side, in the order of the words or
of the reversed words, so the words with a given half stand in one shard or in
neighbours. A word asks only the shards whose range its unchanged half meets;
the ranges (two short strings a shard) are all that is sent to every task.
A half that many words share is spread over many shards by the order itself.

Near pairs are aggregated to a count and the best neighbour of each word, and
forms are followed by pointer doubling; n at least doubles from a word to its
form, so seven rounds always do.

Defined results: a null text has no words and a null doc_id is written as
nothing before the colon; texts and words of any length are taken whole; words
of equal n are taken in code-point order; repeated rows count again; an empty
table has no words; further columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgauge.llm.shared import settle, table, width

LEAST_LENGTH = 5
LEAST_COUNT = 3
SLIPS = 97
SHARD_CHARS = 2_000_000
PREFIX = 64  # code points of a word that decide its shard
QUERIES = 2048  # words searched side by side
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def vocabulary(
    documents: DataFrame, length: int = LEAST_LENGTH, count: int = LEAST_COUNT, slips: int = SLIPS
) -> DataFrame:
    """(word, n): runs of letters, lower-cased in A-Z; one in ``slips`` loses a code point by a hash of document and run."""
    lowered = F.translate(F.col("text").cast("string"), CAPITALS, CAPITALS.lower())
    # Runs only get shorter: those below the length cannot become a word.
    runs = F.regexp_extract_all(lowered, F.lit(f"[a-zÀ-ÿ]{{{length},}}"), F.lit(0))
    found = documents.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run"))
    at = F.expr("cast(h % length(run) AS int)")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    word = F.when(F.col("h") % slips == 0, cut).otherwise(F.col("run"))
    words = found.withColumn("h", h).select(word.alias("word")).filter(F.length("word") >= length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= count)


class SuffixRanks:
    """FM-index of words, extended at their left end; row intervals are suffix ranks.

    Every word has a delimiter behind it, equal ones ordered by word. ``ranks``
    holds the transform as sorted numbers symbol * rows + row: the place of
    symbol * rows + i in it is the first row of suffixes that start with the
    symbol followed by what stands at row i.
    """

    def __init__(self, words: list[str]):
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        points = np.frombuffer("\0".join([*words, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
        self.letters = np.unique(np.delete(points, ends))
        code = np.searchsorted(self.letters, points) + 1
        code[ends] = 0
        self.rows, self.symbols = len(code), len(self.letters) + 1
        rank = code + len(words) - 1
        rank[ends] = np.arange(len(words))
        step, longest = 1, int(lengths.max(initial=0)) + 1
        order = np.argsort(rank, kind="stable")
        while step < longest:
            # A suffix that ends within the step is ranked by its delimiter already.
            behind = np.zeros_like(rank)
            behind[:-step] = rank[step:]
            both = rank * (self.rows + len(self.letters) + 1) + behind
            order = np.argsort(both, kind="stable")
            fresh = np.concatenate([[0], np.cumsum(both[order][1:] != both[order][:-1])])
            rank = np.empty_like(rank)
            rank[order] = fresh
            step *= 2
        before = np.where(order > 0, code[order - 1], 0)
        self.before = before
        self.ranks = np.sort(before * self.rows + np.arange(self.rows))
        first = np.flatnonzero(before == 0)  # rows of whole words, in row order
        self.word_at = np.searchsorted(ends, order[first])
        self.words = len(words)

    def codes(self, points: np.ndarray) -> np.ndarray:
        """Symbols of code points; -1 for what no word has."""
        if not len(self.letters):
            return np.full(len(points), -1)
        at = np.minimum(np.searchsorted(self.letters, points), len(self.letters) - 1)
        return np.where(self.letters[at] == points, at + 1, -1)

    def extend(self, code: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        base = code * self.rows
        low, high = np.searchsorted(self.ranks, base + low), np.searchsorted(self.ranks, base + high)
        return low, np.where(code > 0, high, low)

    def children(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(interval, letter) of all letters that stand before an interval's suffixes."""
        size = high - low
        narrow = np.flatnonzero(size <= 2 * self.symbols)
        length = size[narrow]
        rows = np.repeat(low[narrow] - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
        seen = np.unique(np.repeat(narrow, length) * self.symbols + self.before[rows])
        wide = np.flatnonzero(size > 2 * self.symbols)
        every = (wide[:, None] * self.symbols + np.arange(1, self.symbols)).ravel()
        both = np.concatenate([seen[seen % self.symbols > 0], every])
        return both // self.symbols, both % self.symbols

    def one_error(self, words: list[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) places of words one error away whose error is not within the last ``exact`` code points."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        code, last = self.codes(points), np.cumsum(lengths) - 1

        def symbol(query: np.ndarray, done: np.ndarray) -> np.ndarray:
            return code[last[query] - done]

        query = np.arange(len(words))
        low, high, done = np.zeros_like(query), np.full_like(query, self.words), np.zeros_like(query)
        ready: list[tuple[np.ndarray, ...]] = []
        while len(query):  # the unchanged half
            here = done >= exact[query]
            ready.append((query[here], low[here], high[here], done[here]))
            query, low, high, done = (x[~here] for x in (query, low, high, done))
            low, high = self.extend(symbol(query, done), low, high)
            query, low, high, done = (x[low < high] for x in (query, low, high, done + 1))
        query, low, high, done = map(np.concatenate, zip(*ready, strict=True))
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while len(query):  # no error so far, and one error here
            parent, letter = self.children(low, high)
            a, b = self.extend(letter, low[parent], high[parent])
            there = a < b
            parent, letter, a, b = parent[there], letter[there], a[there], b[there]
            q, d = query[parent], done[parent]
            more = d < lengths[q]
            other = more.copy()
            other[more] = symbol(q[more], d[more]) != letter[more]
            left = np.flatnonzero(done < lengths[query])
            found.append(self._finish(
                np.concatenate([q, q[other], query[left]]),
                np.concatenate([a, a[other], low[left]]),
                np.concatenate([b, b[other], high[left]]),
                np.concatenate([d, d[other] + 1, done[left] + 1]),
                lengths, symbol,
            ))
            query, low, high, done = (x[left] for x in (query, low, high, done))
            low, high = self.extend(symbol(query, done), low, high)
            query, low, high, done = (x[low < high] for x in (query, low, high, done + 1))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs = np.unique(np.concatenate([q * self.words + w for q, w in found]))
        return pairs // self.words, pairs % self.words

    def _finish(self, query, low, high, done, lengths, symbol) -> tuple[np.ndarray, np.ndarray]:
        """What is left of each query without error, up to the delimiter."""
        whole: list[tuple[np.ndarray, np.ndarray]] = []
        while len(query):
            at_end = done == lengths[query]
            a = np.searchsorted(self.ranks, low[at_end])  # the delimiter is symbol 0
            b = np.searchsorted(self.ranks, high[at_end])
            is_word = a < b  # words are distinct: one at most
            whole.append((query[at_end][is_word], self.word_at[a[is_word]]))
            query, low, high, done = (x[~at_end] for x in (query, low, high, done))
            low, high = self.extend(symbol(query, done), low, high)
            query, low, high, done = (x[low < high] for x in (query, low, high, done + 1))
        if not whole:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(map(np.concatenate, zip(*whole, strict=True)))


def _halves(batches: Iterator[pa.RecordBatch], bounds: dict[int, list[tuple[str, str, int]]]) -> Iterator[pa.RecordBatch]:
    """Each word to the shards that can hold its unchanged half, for either side."""
    lows = {side: [x[0] for x in found] for side, found in bounds.items()}
    highs = {side: [x[1] for x in found] for side, found in bounds.items()}
    names = ["unit", "kind", "t", "m"]
    for batch in batches:
        unit, text, exact = [], [], []
        for word in batch["word"].to_pylist():
            for side, t, size in ((0, word, len(word) // 2), (1, word[::-1], len(word) - len(word) // 2)):
                half = t[: min(size, PREFIX)]
                for i in range(bisect_left(highs[side], half), bisect_right(lows[side], half + chr(0x10FFFF))):
                    unit.append(bounds[side][i][2] * 2 + side)
                    text.append(t)
                    exact.append(size)
        kind = np.ones(len(unit), np.int32)
        yield pa.record_batch([pa.array(unit, pa.int64()), pa.array(kind), pa.array(text, pa.string()), pa.array(exact, pa.int64())], names=names)


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a unit: its words (kind 0, m their n), then the words that ask (kind 1, m code points of the unchanged half)."""
    schema = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])
    unit, words, counts, index = None, [], [], None
    for batch in batches:
        of, kind = batch["unit"].to_numpy(), batch["kind"].to_numpy()
        texts, m = batch["t"].to_pylist(), batch["m"].to_numpy()
        change = np.flatnonzero((of[1:] != of[:-1]) | (kind[1:] != kind[:-1])) + 1
        for start, end in zip([0, *change], [*change, len(of)], strict=True):
            if start == end:
                continue
            if of[start] != unit:
                unit, words, counts, index = of[start], [], [], None
            if kind[start] == 0:
                words.extend(texts[start:end])
                counts.append(m[start:end])
                continue
            if index is None:
                # Matching goes from the start of t: the index holds its mirror image and extends that to the left.
                index, n = SuffixRanks([x[::-1] for x in words]), np.concatenate(counts)
            for some in range(start, end, QUERIES):
                asked = texts[some : min(end, some + QUERIES)]
                query, near = index.one_error([x[::-1] for x in asked], m[some : some + len(asked)])
                turn = -1 if unit % 2 else 1  # side 1 holds reversed words
                pairs = [(asked[q][::turn], words[w][::turn]) for q, w in zip(query.tolist(), near.tolist(), strict=True)]
                if pairs:
                    a, b = zip(*pairs, strict=True)
                    yield pa.record_batch([pa.array(a), pa.array(b), pa.array(n[near])], schema=schema)


def near_pairs(words: DataFrame, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """(word, near, near_n) of all words one error apart; a pair may come from both sides. ``words``: settled (word, n)."""
    n = width(words.sparkSession)
    total = words.agg(F.sum(F.length("word"))).first()[0] or 0
    shards = max(n, 2 * -(-total // shard_chars))
    sides = F.explode(F.array(*[
        F.struct(F.lit(side).alias("side"), t.alias("t")) for side, t in enumerate((F.col("word"), F.reverse("word")))
    ]))
    head = F.substring("t", 1, PREFIX)
    placed = settle(
        words.select(sides.alias("x"), "n")
        .select("x.*", "n")
        .withColumn("head", head)
        .repartitionByRange(shards, "side", "head")
        .withColumn("shard", F.spark_partition_id().cast("long")),
        "shards",
    )
    # Two strings of at most PREFIX code points a shard and side.
    ranges = placed.groupBy("side", "shard").agg(F.min("head").alias("low"), F.max("head").alias("high")).collect()
    bounds = {side: sorted((x.low, x.high, x.shard) for x in ranges if x.side == side) for side in (0, 1)}
    asking = words.select("word").mapInArrow(lambda x: _halves(x, bounds), "unit long, kind int, t string, m long")
    held = placed.select((F.col("shard") * 2 + F.col("side")).alias("unit"), F.lit(0).alias("kind"), "t", F.col("n").alias("m"))
    return (
        held.unionByName(asking)
        .repartition(shards, "unit")
        .sortWithinPartitions("unit", "kind")
        .mapInArrow(_search, "word string, near string, near_n long")
    )


def followed(links: DataFrame) -> DataFrame:
    """(word, root): the last word reached from ``word`` by (word, form) links, which hold no cycle."""
    links = settle(links.select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if links.join(onward, "root", "left_semi").isEmpty():
            return links
        links = settle(
            links.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots"
        )


def variants(words: DataFrame, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a vocabulary (word, n) of distinct words."""
    words = settle(words.select("word", "n"), "vocabulary")
    pairs = near_pairs(words, shard_chars).groupBy("word", "near").agg(F.max("near_n").alias("near_n"))
    nearest = pairs.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    good = -F.col("best.less") >= 2 * F.col("n")
    forms = settle(
        words.join(nearest, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(good, F.col("best.near")).alias("form"),
            F.when(good, -F.col("best.less")).alias("form_n"),
        ),
        "nearest",
    )
    roots = followed(forms.filter("form IS NOT NULL"))
    return forms.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(vocabulary(table(spark, sf_dir, "documents")))
