"""Duration of long videos against their views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelgauge import fixed_values as fixed
from reelgauge.functions.columns import correlation_label
from reelgauge.operators import measures as M
from reelgauge.operators.grouped import NICHE, By, join_groups
from reelgauge.operators.quantiles import quantiles
from reelgauge.session import settle

LINE_POINTS = 100


def _long(videos: DataFrame) -> DataFrame:
    return videos.filter(F.col("length_class") == "long").withColumn(
        "duration_minutes", F.col("duration") / 60
    )


def correlation(videos: DataFrame, by: By = NICHE) -> DataFrame:
    n, r = M.correlation(videos, "view_count", "duration")
    return (
        videos.filter(F.col("length_class") == "long")
        .groupBy(*by)
        .agg(n.alias("n"), r.alias("r"))
        .withColumn("correlation", correlation_label(F.col("r")))
    )


def view_quantiles(videos: DataFrame, by: By = NICHE) -> DataFrame:
    """Popularity threshold of all videos and trim limits of the long ones."""
    is_long = F.col("length_class") == "long"
    return quantiles(
        videos,
        by,
        {
            "popular_views": (F.col("view_count"), fixed.POPULAR_QUANTILE),
            "long_views_limit": (F.when(is_long, F.col("view_count")), fixed.TRIM_QUANTILE),
            "long_minutes_limit": (F.when(is_long, F.col("duration") / 60), fixed.TRIM_QUANTILE),
        },
    )


def scatter(
    videos: DataFrame, by: By = NICHE, quantile: float = fixed.TRIM_QUANTILE, limits: DataFrame | None = None
) -> DataFrame:
    """Long videos below the limit in minutes and in views at once.

    ``limits`` may hold settled ``view_quantiles``, whose trim limits then count.
    """
    long = _long(videos)
    if limits is None:
        wanted = {
            "minutes_limit": (F.col("duration_minutes"), quantile),
            "views_limit": (F.col("view_count"), quantile),
        }
        limits = settle(quantiles(long, by, wanted), "scatter")
    else:
        limits = limits.select(
            *by, F.col("long_minutes_limit").alias("minutes_limit"), F.col("long_views_limit").alias("views_limit")
        )
    return (
        join_groups(long, limits, by)
        .filter(
            (F.col("duration_minutes") < F.col("minutes_limit"))
            & (F.col("view_count") < F.col("views_limit"))
        )
        .select(*by, "video_id", "title", "channel_name", "duration_minutes", "view_count")
    )


def fit(
    videos: DataFrame, by: By = NICHE, points: int = LINE_POINTS, trimmed: DataFrame | None = None
) -> DataFrame:
    """Least-squares line of views on minutes over the trimmed set, drawn by points.

    ``trimmed`` may hold the settled ``scatter``.
    """
    x, y = F.col("duration_minutes"), F.col("view_count")
    step = (F.col("x_max") - F.col("x_min")) / (points - 1)
    return (
        (scatter(videos, by) if trimmed is None else trimmed)
        .groupBy(*by)
        .agg(
            F.regr_slope(y, x).alias("slope"),
            F.regr_intercept(y, x).alias("intercept"),
            F.min(x).alias("x_min"),
            F.max(x).alias("x_max"),
        )
        .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .withColumn("x", F.col("x_min") + F.col("point") * step)
        .withColumn("y", F.col("intercept") + F.col("slope") * F.col("x"))
        .select(*by, "slope", "intercept", "point", "x", "y")
    )
