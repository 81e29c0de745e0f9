"""Weekday effects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelgauge.functions.columns import weekday_label_pt, weekday_number
from reelgauge.operators import measures as M
from reelgauge.operators.grouped import NICHE, By, best, within
from reelgauge.operators.significance import with_anova


def stats(videos: DataFrame, by: By = NICHE) -> DataFrame:
    number = weekday_number(F.col("day_of_week"))
    return (
        videos.groupBy(*by, F.col("dia_semana").alias("day_of_week"))
        .agg(
            M.average(videos, "view_count").alias("media_views"),
            M.total(videos, "view_count").alias("total_views"),
            M.count(videos, "video_id").alias("count_videos"),
            M.average(videos, "engagement_rate").alias("media_engagement"),
        )
        .withColumn("day_number", number)
        .withColumn("day_of_week_pt", weekday_label_pt(F.col("day_number")))
        .orderBy(*by, "day_number")
    )


def popularity(videos: DataFrame, by: By = NICHE) -> DataFrame:
    """Days with most and fewest videos; ties go to the earlier weekday."""
    counts = (
        videos.groupBy(*by, "dia_semana")
        .agg(M.rows(videos).alias("n"))
        .withColumn("day", F.struct(weekday_number(F.col("dia_semana")).alias("no"), "dia_semana"))
    )
    return (
        counts.groupBy(*by)
        .agg(best("n", "day").alias("most"), best("n", "day", lowest=True).alias("least"))
        .select(
            *by,
            F.col("most.day.dia_semana").alias("most_popular_day"),
            F.col("most.n").alias("most_popular_videos"),
            F.col("least.day.dia_semana").alias("least_popular_day"),
            F.col("least.n").alias("least_popular_videos"),
        )
    )


def best_worst(videos: DataFrame, by: By = NICHE) -> DataFrame:
    """Best and worst day by mean views, and the gap in percent."""
    days = (
        videos.groupBy(*by, "dia_semana")
        .agg(M.average(videos, "view_count").alias("media_views"))
        .withColumn("day_number", weekday_number(F.col("dia_semana")))
    )
    gap = (F.col("best_media_views") - F.col("worst_media_views")) / F.col("worst_media_views")
    return (
        days.groupBy(*by)
        .agg(
            best("media_views", "day_number").alias("top"),
            best("media_views", "day_number", lowest=True).alias("low"),
        )
        .select(
            *by,
            weekday_label_pt(F.col("top.day_number")).alias("best_day_pt"),
            F.col("top.media_views").alias("best_media_views"),
            weekday_label_pt(F.col("low.day_number")).alias("worst_day_pt"),
            F.col("low.media_views").alias("worst_media_views"),
        )
        .withColumn("diff_pct", F.when(F.col("worst_media_views") != 0, gap * 100))
    )


def anova(videos: DataFrame, by: By = NICHE) -> DataFrame:
    """One-way analysis of variance of views over the weekdays that occur."""
    days = (
        videos.filter(F.col("dia_semana").isNotNull())
        .groupBy(*by, "dia_semana")
        .agg(*M.sample(videos, "view_count", "day"))
        .filter(F.col("n_day") > 0)
    )
    grand = F.sum(F.col("n_day") * F.col("mean_day")).over(within(by)) / F.sum("n_day").over(within(by))
    off = F.col("mean_day") - F.col("grand")
    sums = (
        days.withColumn("grand", grand)
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("n_groups"),
            F.sum("n_day").alias("n"),
            F.sum(F.col("n_day") * off * off).alias("between"),
            F.sum((F.col("n_day") - 1) * F.coalesce("var_day", F.lit(0.0))).alias("inside"),
        )
    )
    return with_anova(sums, "n_groups", "n", "between", "inside").drop("between", "inside")
