"""Mixing sources to target weights with soft membership.

A naive Bayes classifier over hashed words, fitted on a labelled table (rows
whose source is known), gives every document a posterior over the sources. A
row with a known source has that source with probability ``TRUST``, and the
classifier shares out the rest; a row without one has the classifier's answer.
Rates (expected numbers of copies) r >= 0 are then fitted so that the expected
tokens of every source, sum of r * tokens * posterior, match the targets, by
projected gradient steps on the rates of all documents (``descend``). A round
is one aggregation over the documents that returns a number for each source;
rates stay beside their documents. Rounds go on until the targets are met; if
nothing more is gained, the error that is left is warned of.

Everything runs in DataFrame functions. The classifier is fitted on at most
about ``TRAIN_DOCS`` rows of each source, picked by a hash of what a row holds,
so neither the order of rows nor the files they lie in matter; its table has
``BUCKETS`` rows.

Defined results: a text that is null or has no words has no tokens and follows
the prior; a null source is predicted; without any known source all rates are
1; very long texts are read whole, and count as 50 words of evidence at most;
rows with equal or null doc_id are documents of their own, and only those equal
in doc_id, source and text have the same draws; equal posteriors give equal
rates; empty tables give no rows; further columns of any name pass through
``mixed``.
"""

from __future__ import annotations

import math
import warnings

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgauge.llm.shared import settle, table

BUCKETS = 2048
TRAIN_DOCS = 500
TRUST = 0.9
CLOSE = 1e-4  # of all tokens, the largest error of a source
PATIENCE = 25  # rounds without a hundredth of gain, after which the targets cannot be met
WRITTEN = 6  # rounds after which the rates are written
MOST_SOURCES = 256  # more than this is not a mix of sources


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def _words(text: str) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), "[ \\t-\\r]+"), lambda x: x != "")


def classifier(rows: DataFrame, sources: dict[str, int], train_docs: int) -> tuple[list[str], DataFrame]:
    """The sources in order, and a log likelihood column for each of them by bucket."""
    names = sorted(sources)
    share = F.create_map(*[x for n in names for x in (F.lit(n), F.lit(min(1.0, train_docs / sources[n])))])
    draw = _draw("row", 1_000_000)
    words = (
        rows.filter(F.col("source").isNotNull())
        .filter(draw < share[F.col("source")])
        .select("source", F.explode(_words("text")).alias("word"))
        .select("source", _bucket(F.col("word")).alias("bucket"))
    )
    counts = settle(
        words.groupBy("bucket").agg(*[F.count_if(F.col("source") == n).alias(f"c{i}") for i, n in enumerate(names)]),
        "word-counts",
    )
    totals = counts.agg(*[F.coalesce(F.sum(f"c{i}"), F.lit(0)).alias(f"c{i}") for i in range(len(names))]).first()
    every = rows.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    likelihood = every.join(counts, "bucket", "left").select(
        "bucket",
        *[
            F.log((F.coalesce(f"c{i}", F.lit(0)) + 1) / (totals[f"c{i}"] + BUCKETS)).alias(f"w{i}")
            for i in range(len(names))
        ],
    )
    return names, settle(likelihood, "likelihoods")


def _identity(source: str) -> list[Column]:
    """What a row's copies follow from: its id, its source and two hashes of its text."""
    text = F.col("text").cast("string")
    return [
        F.col("doc_id").cast("long").alias("id"),
        F.col(source).cast("string").alias("source"),
        F.xxhash64(text).alias("h1"),
        F.xxhash64(F.lit(1), text).alias("h2"),
    ]


def _draw(kind: str, steps: int) -> Column:
    """An even draw from 0 up to 1 that follows from what a row is."""
    return F.pmod(F.xxhash64(F.lit(kind), "id", "source", "h1", "h2"), F.lit(steps)) / steps


def memberships(documents: DataFrame, source: str = "source", train_docs: int = TRAIN_DOCS, trust: float = TRUST):
    """(row, id, source, h1, h2, n_tokens, p) written to the shared folder, and the sources p is over."""
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"),  # tells rows apart in one job; never matched in another
        *_identity(source),
        F.col("text").cast("string").alias("text"),
    )
    found = rows.filter(F.col("source").isNotNull()).groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    sizes = {x["source"]: x["n"] for x in found.limit(MOST_SOURCES + 1).collect()}
    if len(sizes) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    if not sizes:
        plain = rows.select("row", "id", "source", "h1", "h2", F.size(_words("text")).cast("long").alias("n_tokens"))
        return settle(plain.withColumn("p", F.array().cast("array<double>")), "memberships"), []
    names, likelihood = classifier(rows, sizes, train_docs)
    every = sum(sizes.values())
    # BUCKETS rows of MOST_SOURCES doubles at most: 4 MB.
    scored = (
        rows.select("row", "id", "source", "h1", "h2", F.explode_outer(_words("text")).alias("word"))
        .select("row", "id", "source", "h1", "h2", F.when(F.col("word").isNotNull(), _bucket(F.col("word"))).alias("bucket"))
        .join(F.broadcast(likelihood), "bucket", "left")
        .groupBy("row", "id", "source", "h1", "h2")
        .agg(F.count("bucket").alias("n_tokens"), *[F.sum(f"w{i}").alias(f"w{i}") for i in range(len(names))])
    )
    # Words of a text are not independent: a text counts as 50 of them at most.
    weight = F.least(F.lit(1.0), F.lit(50.0) / F.greatest("n_tokens", F.lit(1)))
    logs = [F.log(F.lit(sizes[n] / every)) + weight * F.coalesce(f"w{i}", F.lit(0.0)) for i, n in enumerate(names)]
    scored = scored.select("row", "id", "source", "h1", "h2", "n_tokens", F.array(*logs).alias("logs"))
    top = F.array_max("logs")
    scored = scored.withColumn("e", F.transform("logs", lambda x: F.exp(x - top)))
    total = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    scored = scored.withColumn("e", F.transform("e", lambda x: x / total))
    place = F.array_position(F.array(*map(F.lit, names)), F.col("source")) - 1
    known = F.transform("e", lambda x, i: x * (1 - trust) + F.when(i == place, trust).otherwise(0.0))
    p = F.when(F.col("source").isNull(), F.col("e")).otherwise(known)
    return settle(scored.select("row", "id", "source", "h1", "h2", "n_tokens", p.alias("p")), "memberships"), names


def _stepped(state: DataFrame, gradient: np.ndarray, ahead: float) -> DataFrame:
    """One projected step from ``lead``, and the next ``lead`` beyond the new rate."""
    slope = F.lit(0.0)
    for i, x in enumerate(gradient.tolist()):
        slope = slope + F.get("p", i) * x
    rest = [x for x in state.columns if x not in ("rate", "lead")]
    moved = state.select(*rest, F.col("rate").alias("last"), F.greatest(F.lit(0.0), F.col("lead") - slope).alias("rate"))
    return moved.select(*rest, "rate", (F.col("rate") + ahead * (F.col("rate") - F.col("last"))).alias("lead"))


def _held(state: DataFrame, sources: int) -> np.ndarray:
    """Expected tokens of every source."""
    held = state.select((F.col("rate") * F.col("n_tokens")).alias("held"), "p")
    return np.array(held.agg(*[F.coalesce(F.sum(F.col("held") * F.get("p", i)), F.lit(0.0)) for i in range(sources)]).first())


def descend(members: DataFrame, start: np.ndarray, target: np.ndarray, close: float) -> tuple[DataFrame, float, int]:
    """``members`` with the ``rate`` that comes closest to ``target``, the largest error left, and the rounds taken.

    Least squares of (expected - target), each source weighted by 1 / its
    tokens at rate 1 (``start``), over rates >= 0, from rate 1 on. Rates are
    measured by their tokens, so a document's slope is the sum of posterior *
    error / start. As posteriors add up to 1, the curvature in that measure is
    1 at most, and a step of the slope itself never overshoots. Steps start a
    little beyond the last rate (Nesterov), anew from it whenever the sum of
    squares grew. Expected tokens are linear in the rates, so those of the
    point beyond need no aggregation. Rates of a few rounds are one chain of
    projections in a job; every ``WRITTEN`` rounds they are written.
    """
    state = members.withColumn("rate", F.lit(1.0)).withColumn("lead", F.lit(1.0))
    share = np.divide(1.0, start, out=np.zeros(len(start)), where=start > 0)
    now, lead, pace = start, start, 1.0
    error = least = float(np.abs(now - target).max())
    rounds = waited = 0
    while error > close and waited < PATIENCE:
        following = (1 + math.sqrt(1 + 4 * pace * pace)) / 2
        ahead = (pace - 1) / following
        state = _stepped(state, (lead - target) * share, ahead)
        rounds += 1
        if rounds % WRITTEN == 0:
            state = settle(state, "rates")
        before, now = now, _held(state, len(start))
        lead = now + ahead * (now - before)
        grew = ((now - target) ** 2 * share).sum() > ((before - target) ** 2 * share).sum()
        pace = 1.0 if grew else following
        if grew:
            state, lead = state.withColumn("lead", F.col("rate")), now
        error = float(np.abs(now - target).max())
        waited = 0 if error < 0.99 * least else waited + 1
        least = min(least, error)
    return settle(state.drop("lead"), "rates"), error, rounds


def rates(members: DataFrame, names: list[str], weights: dict[str, float] | None = None, tokens: float | None = None) -> DataFrame:
    """``members`` with ``rate``; ``weights`` are shares of ``tokens`` (all tokens by default).

    Targets that no rates meet are warned of, with the error that is left.
    """
    if not names:
        return members.withColumn("rate", F.lit(1.0))
    wanted = {n: 1.0 for n in names} if weights is None else weights
    whole = sum(wanted.get(n, 0.0) for n in names)
    if whole <= 0:
        raise ValueError("no source has a weight")
    start = _held(members.withColumn("rate", F.lit(1.0)), len(names))
    budget = float(start.sum()) if tokens is None else tokens
    target = np.array([budget * wanted.get(n, 0.0) / whole for n in names])
    close = CLOSE * max(budget, 1.0)
    found, error, _ = descend(members, start, target, close)
    if error > close:
        warnings.warn(f"the targets cannot be met: a source is off by {error / max(budget, 1.0):.2%} of all tokens", stacklevel=2)
    return found


def copies() -> Column:
    """Whole copies, and one more with the chance of the fraction, drawn by a hash of what the row is."""
    draw = _draw("copies", 1 << 30)
    return (F.floor("rate") + F.when(draw < F.col("rate") - F.floor("rate"), 1).otherwise(0)).cast("long")


def mix(documents: DataFrame, weights: dict[str, float] | None = None, **options) -> DataFrame:
    """(row, id, source, h1, h2, n_tokens, p, rate, copies) for every row of ``documents``."""
    members, names = memberships(documents, **options)
    return rates(members, names, weights).withColumn("copies", copies())


def mixed(documents: DataFrame, weights: dict[str, float] | None = None, **options) -> DataFrame:
    """The rows of ``documents``, each as often as its copies say.

    Rows that are equal in id, source and text have equal copies, so the join
    is on these and needs no number of a row from another job.
    """
    key = ["id", "source", "h1", "h2"]
    found = mix(documents, weights, **options).select(*key, "copies")
    chosen = settle(found.groupBy(*key).agg(F.max("copies").alias("copies")).filter("copies > 0"), "copies")
    whole = documents.select(F.struct(*_identity(options.get("source", "source"))).alias("key"), F.struct("*").alias("whole"))
    chosen = chosen.select(F.struct(*key).alias("key"), "copies")
    same = whole["key"] == chosen["key"]  # fields that are null in both are equal inside a struct
    often = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    # Shuffled at every size, as the copies of a whole corpus never fit a broadcast.
    return whole.join(chosen.hint("merge"), same).select("whole", often.alias("copy")).select("whole.*")


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "source", "n_tokens", F.round("rate", 6).alias("rate"), "copies"
    )
