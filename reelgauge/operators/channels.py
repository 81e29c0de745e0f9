"""Channels compared month by month across years."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelgauge import fixed_values as fixed
from reelgauge.functions.columns import per_view
from reelgauge.operators import cube
from reelgauge.operators import measures as M
from reelgauge.operators.grouped import NICHE, By


def _measures(videos: DataFrame) -> dict[str, Column]:
    interactions = M.total(videos, "interactions") if M.are_cells(videos) else F.sum(cube.interactions())
    return {
        "total_views": M.total(videos, "view_count"),
        "total_likes": M.total(videos, "like_count"),
        "total_comments": M.total(videos, "comment_count"),
        "avg_engagement_rate": M.average(videos, "engagement_rate"),
        "weighted_engagement_rate": per_view(interactions, M.total(videos, "view_count")),
    }


def channel_year(videos: DataFrame, year: int, by: By = NICHE) -> DataFrame:
    """Per channel: the measures of one year, suffixed with it."""
    return (
        videos.filter(F.col("ano") == year)
        .groupBy(*by, "channel_name")
        .agg(*[measure.alias(f"{name}_{year}") for name, measure in _measures(videos).items()])
    )


def month_compare(
    videos: DataFrame, years: list[int] | None = None, by: By = NICHE
) -> DataFrame:
    """Per length class, month and channel: the measures of every year.

    One shuffle: the year filter runs first, so a channel without a video in
    that month of any of the years has no row, and the years become columns.
    """
    years = fixed.COMPARED_YEARS if years is None else years
    measures = _measures(videos)
    wide = (
        videos.filter(F.col("ano").isin(years) & F.col("length_class").isNotNull())
        .groupBy(*by, "length_class", "mes", "channel_name")
        .pivot("ano", years)
        .agg(*[measure.alias(name) for name, measure in measures.items()])
    )
    named = {f"{year}_{name}": f"{name}_{year}" for year in years for name in measures}
    return wide.withColumnsRenamed(named).withColumn(
        "month_name", F.date_format(F.make_date(F.lit(2000), "mes", F.lit(1)), "MMMM")
    )


def year_compare_by_join(videos: DataFrame, years: list[int], by: By = NICHE) -> DataFrame:
    """The same idea without months as a chain of full outer joins."""
    frames = [channel_year(videos, year, by) for year in years]
    return reduce(lambda left, right: left.join(right, [*by, "channel_name"], "full_outer"), frames)
