"""Mergeable summaries: quantiles of any span of months, and channels that niches share.

A sketch a month is made in one pass and kept; a question about a span or a set
of niches merges sketches instead of reading the videos of it again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelgauge.operators.grouped import NICHE, By, join_groups
from reelgauge.session import settle

#: Size of a KLL sketch; its ranks are off by about 1.65 / K, hardly ever by more than WIDE / K.
K = 4096
WIDE = 4.0
#: Size of a theta sketch is 2 ** LG_NOMINAL; its counts are off by about 1 / sqrt of that.
LG_NOMINAL = 14


def _month(year: str = "ano", month: str = "mes"):
    return (F.col(year) * 12 + F.col(month) - 1).alias("month_no")


def month_sketches(videos: DataFrame, by: By = NICHE, value: str = "view_count", k: int = K) -> DataFrame:
    """Settled (by, month_no, n, sketch): a KLL sketch of a whole-number measure for each month."""
    known = videos.filter(F.col(value).isNotNull() & F.col("ano").isNotNull())
    return settle(
        known.groupBy(*by, _month()).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_bigint(value, F.lit(k)).alias("sketch")),
        "month-sketches",
    )


def quantiles_by_span(
    videos: DataFrame,
    spans: Sequence[tuple[str, tuple[int, int], tuple[int, int]]],
    wanted: Sequence[float],
    by: By = NICHE,
    value: str = "view_count",
    sketches: DataFrame | None = None,
    k: int = K,
    wide: float = WIDE,
) -> DataFrame:
    """(by, span, probability, n, quantile), exact, for spans (name, (year, month) from, (year, month) to).

    The merged sketches of a span bracket the wanted rank; one pass counts what
    lies below the bracket and the values inside it, a share of about
    2 * ``wide`` / ``k`` of the rows, and takes the rank from these. A bracket
    that proves to miss its rank (the bound of a sketch holds with high
    probability, not always) is asked again four times as wide.
    """
    sketches = month_sketches(videos, by, value, k) if sketches is None else sketches
    listed = F.array(*[
        F.struct(F.lit(name).alias("span"), F.lit(a[0] * 12 + a[1] - 1).alias("first"), F.lit(b[0] * 12 + b[1] - 1).alias("last"))
        for name, a, b in spans
    ])
    keys = [*by, "span"]
    ranks = F.explode(F.array(*[F.lit(float(p)) for p in wanted]))
    merged = settle(
        sketches.select("*", F.explode(F.filter(listed, _holds)).alias("asked"))
        .select(*by, "asked.*", "n", "sketch")
        .groupBy(*keys, "first", "last")
        .agg(F.sum("n").alias("n"), F.kll_merge_agg_bigint("sketch", F.lit(k)).alias("sketch"))
        .withColumn("probability", ranks),
        "spans",
    )
    rows = videos.filter(F.col(value).isNotNull() & F.col("ano").isNotNull()).select(*by, _month(), F.col(value).alias("value"))
    done, eps = [], wide / k
    while True:
        brackets = settle(
            merged.select(
                *keys, "first", "last", "probability", "n",
                _bound({p: p - eps for p in wanted}).alias("low"), _bound({p: p + eps for p in wanted}).alias("high"),
            ),
            "brackets",
        )
        found = settle(_inside(rows, brackets, by, keys), "span-quantiles")
        done.append(found.filter("quantile IS NOT NULL"))
        missed = found.filter("quantile IS NULL").select(*keys, "probability")
        if missed.isEmpty():
            break
        merged, eps = settle(merged.join(missed, [*keys, "probability"], "left_semi"), "spans"), 4 * eps
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result


def _bound(ranks: dict[float, float]) -> Column:
    """The sketch's value at the rank of a row's probability; none beyond both ends."""
    inside = {p: rank for p, rank in ranks.items() if 0 < rank < 1}
    found = [F.when(F.col("probability") == p, F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(r)))) for p, r in inside.items()]
    return F.coalesce(*found, F.lit(None).cast("long"))


def _holds(span: Column) -> Column:
    return (F.col("month_no") >= span["first"]) & (F.col("month_no") <= span["last"])


def _inside(rows: DataFrame, brackets: DataFrame, by: By, keys: list[str]) -> DataFrame:
    """The quantile of every bracket, NULL where the bracket misses it.

    The brackets of a group, one for each span and probability asked, are
    attached as an array; a row goes on once for each that it is not above.
    """
    asked = [*keys, "probability", "n"]
    fields = [name for name in brackets.columns if name not in by]
    listed = settle(brackets.groupBy(*by).agg(F.collect_list(F.struct(*fields)).alias("brackets")), "bracket-lists")
    not_above = F.filter("brackets", lambda b: _holds(b) & (b["high"].isNull() | (F.col("value") <= b["high"])))
    below = F.col("value") < F.col("low")
    counted = (
        join_groups(rows, listed, by)
        .withColumn("bracket", F.explode(not_above))
        .select(*by, "bracket.*", "value")
        .groupBy(*asked, F.when(~F.coalesce(below, F.lit(False)), F.col("value")).alias("value"))  # NULL: below
        .agg(F.count(F.lit(1)).alias("m"))
    )
    running = Window.partitionBy(*asked).orderBy(F.col("value").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    position = F.col("probability") * (F.col("n") - 1)
    upto = counted.withColumn("upto", F.sum("m").over(running))

    def at(rank):
        reaches = F.col("value").isNotNull() & (F.col("upto") > rank) & (F.col("upto") - F.col("m") <= rank)
        return F.max(F.when(reaches, F.col("value")))

    low, high = at(F.floor(position)), at(F.ceil(position))
    share = F.max(position - F.floor(position))
    return upto.groupBy(*asked).agg((low + (high - low) * share).alias("quantile"))


def channel_sketches(videos: DataFrame, by: By = NICHE, item: str = "channel_id", lg: int = LG_NOMINAL) -> DataFrame:
    """Settled (by, month_no, sketch): a theta sketch of the channels of each month."""
    known = videos.filter(F.col("ano").isNotNull())
    return settle(known.groupBy(*by, _month()).agg(F.theta_sketch_agg(item, F.lit(lg)).alias("sketch")), "theta")


def shared_channels(
    sketches: DataFrame, pairs: Sequence[tuple[str, str]], by: str = "niche", lg: int = LG_NOMINAL
) -> DataFrame:
    """(first, second, in_both, in_either, only_first, only_second) for the ``pairs`` of groups, estimated.

    Estimates are exact while a group has fewer than 2 ** ``lg`` channels;
    beyond that each is off by a few times in_either / sqrt(2 ** ``lg``) at most.
    """
    whole = settle(sketches.groupBy(by).agg(F.theta_union_agg("sketch", F.lit(lg)).alias("sketch")), "theta-groups")
    a = whole.select(F.col(by).alias("first"), F.col("sketch").alias("a"))
    b = whole.select(F.col(by).alias("second"), F.col("sketch").alias("b"))

    def size(sketch):
        return F.theta_sketch_estimate(sketch).cast("long")

    asked = sketches.sparkSession.createDataFrame(list(pairs), "first string, second string")
    return asked.join(a, "first").join(b, "second").select(
        "first",
        "second",
        size(F.theta_intersection("a", "b")).alias("in_both"),
        size(F.theta_union("a", "b", F.lit(lg))).alias("in_either"),
        size(F.theta_difference("a", "b")).alias("only_first"),
        size(F.theta_difference("b", "a")).alias("only_second"),
    )
