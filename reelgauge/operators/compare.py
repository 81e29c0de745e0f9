"""Long against short videos."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelgauge import fixed_values as fixed
from reelgauge.functions.columns import log10_views
from reelgauge.operators import measures as M
from reelgauge.operators.grouped import NICHE, By, join_groups
from reelgauge.operators.quantiles import quantiles
from reelgauge.operators.significance import with_welch
from reelgauge.session import settle

CLASSES = ["long", "short"]
COMPARED = {
    "avg_views": "view_count",
    "avg_likes": "like_count",
    "avg_comments": "comment_count",
    "avg_engagement": "engagement_rate",
}


def stats(videos: DataFrame, by: By = NICHE) -> DataFrame:
    return (
        videos.filter(F.col("length_class").isNotNull())
        .groupBy(*by, "length_class")
        .agg(
            M.rows(videos).alias("count"),
            *[M.average(videos, column).alias(name) for name, column in COMPARED.items()],
            M.highest(videos, "view_count").alias("max_views"),
            M.highest(videos, "engagement_rate").alias("max_engagement"),
        )
    )


def metric_table(videos: DataFrame, by: By = NICHE) -> DataFrame:
    """The averages with one row per metric and one column per class."""
    return (
        stats(videos, by)
        .unpivot([*by, "length_class"], list(COMPARED), "metric", "value")
        .groupBy(*by, "metric")
        .pivot("length_class", CLASSES)
        .agg(F.max("value"))
    )


def ratio(videos: DataFrame, by: By = NICHE) -> DataFrame:
    """Short over long: views and engagement, and whether shorts pay off."""
    def of(name: str):
        column = COMPARED[name]
        short, long = (M.average(videos, column, F.col("length_class") == c) for c in ("short", "long"))
        return F.when(long != 0, short / long)

    return (
        videos.groupBy(*by)
        .agg(of("avg_views").alias("view_ratio"), of("avg_engagement").alias("engagement_ratio"))
        .withColumn(
            "favour_shorts",
            F.coalesce(
                (F.col("view_ratio") > fixed.SHORTS_VIEW_RATIO)
                & (F.col("engagement_ratio") > fixed.SHORTS_ENGAGEMENT_RATIO),
                F.lit(False),
            ),
        )
    )


def welch(videos: DataFrame, by: By = NICHE) -> DataFrame:
    """Welch's t test of long against short, one row per metric.

    All metrics and both classes come from one aggregation without a join.
    """
    parts = []
    for metric, column in COMPARED.items():
        for name in CLASSES:
            parts += M.sample(videos, column, f"{metric}_{name}", F.col("length_class") == name)
    sized = ["n", "mean", "var"]
    tests = F.array(*[
        F.struct(
            F.lit(metric).alias("metric"),
            *[F.col(f"{s}_{metric}_{c}").alias(f"{s}_{c}") for c in CLASSES for s in sized],
        )
        for metric in COMPARED
    ])
    rows = videos.groupBy(*by).agg(*parts).select(*by, F.inline(tests))
    return with_welch(rows, "long", "short").drop("var_long", "var_short")


def _valued(videos: DataFrame, value: str | Column) -> tuple[DataFrame, str]:
    """The value of a box plot by name; an expression is named "value"."""
    return (videos, value) if isinstance(value, str) else (videos.withColumn("value", value), "value")


def box_summary(videos: DataFrame, by: By = NICHE, value: str | Column = "view_count") -> DataFrame:
    """Settled quartiles, minimum and maximum; ``box`` and ``outliers`` can share them."""
    videos, value = _valued(videos, value)
    timed = videos.filter(F.col("length_class").isNotNull())
    quarters = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}
    wanted = {name: (F.col(value), p) for name, p in quarters.items()}
    return settle(quantiles(timed, [*by, "length_class"], wanted), "box")


def _box(videos: DataFrame, by: By, value: str, summary: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    timed = videos.filter(F.col("length_class").isNotNull())
    keys = [*by, "length_class"]
    summary = box_summary(videos, by, value) if summary is None else summary
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    limits = summary.withColumns({"low_limit": F.col("q1") - reach, "high_limit": F.col("q3") + reach})
    return join_groups(timed, limits, keys), limits


def box(
    videos: DataFrame, by: By = NICHE, value: str | Column = "view_count", summary: DataFrame | None = None
) -> DataFrame:
    """Box-plot summary; fences are the last values within 1.5 IQR."""
    videos, value = _valued(videos, value)
    marked, limits = _box(videos, by, value, summary)
    keys = [*by, "length_class"]
    inside = F.col(value).between(F.col("low_limit"), F.col("high_limit"))
    whiskers = marked.groupBy(*keys).agg(
        F.min(F.when(inside, F.col(value))).alias("lower_fence"),
        F.max(F.when(inside, F.col(value))).alias("upper_fence"),
        F.count(F.when(~inside, 1)).alias("n_outliers"),
    )
    return join_groups(whiskers, limits.drop("low_limit", "high_limit"), keys)


def outliers(
    videos: DataFrame, by: By = NICHE, value: str | Column = "view_count", summary: DataFrame | None = None
) -> DataFrame:
    """The videos drawn as single points beyond the fences."""
    videos, value = _valued(videos, value)
    marked, _ = _box(videos, by, value, summary)
    beyond = ~F.col(value).between(F.col("low_limit"), F.col("high_limit"))
    return marked.filter(beyond).select(*by, "length_class", "video_id", value)


def density(
    videos: DataFrame, by: By = NICHE, bins_per_decade: int = 10, bandwidth: float | None = None
) -> DataFrame:
    """Distribution of log10 views: share per bin and a Gaussian-kernel density.

    The kernel runs over the bins of a group (a bigint has at most 19 decades),
    never over its rows. ``bandwidth`` defaults to Silverman's rule.
    """
    keys = [*by, "length_class"]
    whole = Window.partitionBy(*keys)
    logged = videos.filter(F.col("length_class").isNotNull()).select(
        *keys, log10_views(F.col("view_count")).alias("log_views")
    )
    bins = (
        logged.groupBy(*keys, F.floor(F.col("log_views") * bins_per_decade).alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("log_views").alias("total"),
            F.sum(F.col("log_views") * F.col("log_views")).alias("squares"),
        )
        .withColumn("bin_start", F.col("bin") / bins_per_decade)
        .withColumn("n_class", F.sum("n").over(whole))
        .withColumn("share", F.col("n") / F.col("n_class"))
    )
    if bandwidth is None:
        total, n = F.sum("total").over(whole), F.col("n_class")
        variance = F.when(n > 1, (F.sum("squares").over(whole) - total * total / n) / (n - 1))
        width = 1.059 * F.sqrt(F.greatest(variance, F.lit(0.0))) * F.pow(n.cast("double"), F.lit(-0.2))
    else:
        width = F.lit(float(bandwidth))
    half = 0.5 / bins_per_decade
    peers = F.collect_list(F.struct((F.col("bin_start") + half).alias("at"), "share")).over(whole)

    def kernel(total, peer):
        z = (F.col("bin_start") + half - peer["at"]) / F.col("width")
        return total + peer["share"] * F.exp(-z * z / 2) / (F.col("width") * 2.5066282746310002)

    smooth = F.when(F.col("width") > 0, F.aggregate(F.col("peers"), F.lit(0.0), kernel))
    return (
        bins.withColumn("width", width)
        .withColumn("peers", peers)
        .withColumn("density", smooth)
        .select(*keys, "bin", "bin_start", "n", "share", "density")
    )
