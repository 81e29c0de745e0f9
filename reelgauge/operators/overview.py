"""Overview: totals and monthly series by length class."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelgauge.functions.columns import dotted_thousands
from reelgauge.operators import measures as M
from reelgauge.operators.grouped import NICHE, By
from reelgauge.plans.niches import keep_channels


def _published(videos: DataFrame, channels: list[str] | None) -> DataFrame:
    return keep_channels(videos, channels).filter(F.col("length_class").isNotNull())


def totals(videos: DataFrame, by: By = NICHE, channels: list[str] | None = None) -> DataFrame:
    return (
        _published(videos, channels)
        .groupBy(*by, "length_class")
        .agg(M.rows(videos).alias("n_videos"), M.total(videos, "view_count").alias("total_views"))
        .withColumn("total_views_text", dotted_thousands(F.col("total_views")))
    )


def monthly(videos: DataFrame, by: By = NICHE, channels: list[str] | None = None) -> DataFrame:
    return (
        _published(videos, channels)
        .groupBy(*by, "length_class", "ano_mes_publish")
        .agg(M.count(videos, "video_id").alias("n_videos"), M.total(videos, "view_count").alias("total_views"))
    )


def channel_list(videos: DataFrame, by: By = NICHE) -> DataFrame:
    return videos.select(*by, "channel_name").distinct()
