"""Monthly seasonality and linear trends."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelgauge.operators import measures as M
from reelgauge.operators.grouped import NICHE, By

METRICS = ["num_videos", "media_views", "total_views", "media_engagement", "media_likes"]


def monthly(videos: DataFrame, by: By = NICHE) -> DataFrame:
    return _monthly(videos, by).orderBy(*by, "date")


def _monthly(videos: DataFrame, by: By) -> DataFrame:
    return (
        videos.groupBy(*by, "ano", "mes")
        .agg(
            M.count(videos, "video_id").alias("num_videos"),
            M.average(videos, "view_count").alias("media_views"),
            M.total(videos, "view_count").alias("total_views"),
            M.average(videos, "engagement_rate").alias("media_engagement"),
            M.average(videos, "like_count").alias("media_likes"),
        )
        .withColumn("date", F.make_date("ano", "mes", F.lit(1)))
    )


def trend(videos: DataFrame, by: By = NICHE, calendar: bool = False) -> DataFrame:
    """Least-squares line of every metric over the months that occur.

    Months are numbered without gaps; ``calendar`` leaves room for absent ones.
    The windows run over the monthly rows, a few hundred per group at most.
    """
    series = Window.partitionBy(*by)
    if calendar:
        month = F.col("ano") * 12 + F.col("mes")
        index = month - F.min(month).over(series)
    else:
        index = F.row_number().over(series.orderBy("ano", "mes")) - 1
    line = Window.partitionBy(*by, "metric")
    x, y = F.col("month_index"), F.col("value")
    return (
        _monthly(videos, by)
        .withColumn("month_index", index)
        .withColumns({name: F.col(name).cast("double") for name in METRICS})
        .unpivot([*by, "date", "month_index"], METRICS, "metric", "value")
        .withColumn("slope", F.regr_slope(y, x).over(line))
        .withColumn("intercept", F.regr_intercept(y, x).over(line))
        .withColumn("fitted", F.col("intercept") + F.col("slope") * x)
    )
