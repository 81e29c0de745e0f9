"""One table of mergeable statistics that many analyses draw on.

A cell is a niche, channel, month, weekday, length class, title class and emoji
flag with the counts, sums, extremes and moments of its videos. Any coarser
group is a merge of cells (``measures``), exact but for the last bits of a
double, so the fact table is read once for all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelgauge.functions import text as X
from reelgauge.operators.grouped import NICHE, By, join_groups
from reelgauge.operators.measures import ROWS
from reelgauge.session import settle

KEYS = (
    "channel_name", "ano", "mes", "ano_mes_publish", "dia_semana", "length_class", "bin_no", "has_emoji",
)
#: Measures with moments, and those with counts, sums and extremes alone.
MEASURED = ("view_count", "like_count", "comment_count", "engagement_rate")
SUMMED = ("title_length", "duration", "interactions")
PAIRS = (("title_length", "view_count"), ("title_length", "engagement_rate"), ("view_count", "duration"))
#: What the analyses of numbers need of a video.
NARROW = (
    "video_id", "published_at", "duration", "view_count", "like_count", "comment_count", "engagement_rate", *KEYS[:-2],
)


def interactions() -> Column:
    """Likes and comments of a video that has views."""
    return F.when(F.col("view_count") > 0, F.col("like_count") + F.col("comment_count"))


def narrow(videos: DataFrame, by: By = NICHE) -> DataFrame:
    """The view without its texts; of the title its length, class and emoji flag stay."""
    length = X.title_length(F.col("title"))
    return videos.select(
        *by,
        *NARROW,
        length.alias("title_length"),
        X.length_bin(length).alias("bin_no"),
        X.has_emoji(F.col("title")).alias("has_emoji"),
    )


def cells(numbers: DataFrame, by: By = NICHE) -> DataFrame:
    """Settled cells of a ``narrow`` view."""
    rows = numbers.withColumn("interactions", interactions())
    parts = [
        F.count(F.lit(1)).alias(ROWS),
        F.count("video_id").alias("n_video_id"),
        F.min("published_at").alias("min_published_at"),
    ]
    for name in (*MEASURED, *SUMMED):
        parts += [F.count(name).alias(f"n_{name}"), F.sum(name).alias(f"sum_{name}"), F.max(name).alias(f"max_{name}")]
    for name in MEASURED:
        parts += [F.avg(name).alias(f"mean_{name}"), (F.var_pop(name) * F.count(name)).alias(f"squares_{name}")]
    for a, b in PAIRS:
        pair, x, y = f"{a}_{b}", F.when(F.col(b).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col(b))
        n = F.count(F.when(F.col(b).isNotNull(), F.col(a)))
        parts += [
            n.alias(f"pairs_{pair}"),
            F.avg(x).alias(f"x_mean_{pair}"),
            F.avg(y).alias(f"y_mean_{pair}"),
            (F.var_pop(x) * n).alias(f"x_squares_{pair}"),
            (F.var_pop(y) * n).alias(f"y_squares_{pair}"),
            (F.covar_pop(a, b) * n).alias(f"products_{pair}"),
        ]
    found = settle(rows.groupBy(*by, *KEYS).agg(*parts), "cells-raw")
    weights = {f"mean_{name}": f"n_{name}" for name in MEASURED}
    weights |= {f"{side}_mean_{a}_{b}": f"pairs_{a}_{b}" for a, b in PAIRS for side in "xy"}
    n = {mean: F.sum(weight) for mean, weight in weights.items()}
    centres = settle(
        found.groupBy(*by).agg(*[
            F.when(n[mean] > 0, F.sum(F.col(mean) * F.col(weight)) / n[mean]).alias(f"_{mean}")
            for mean, weight in weights.items()
        ]),
        "centres",
    )
    apart = {mean.replace("mean", "apart"): F.col(mean) - F.col(f"_{mean}") for mean in weights}
    return settle(
        join_groups(found, centres, by).withColumns(apart).drop(*weights, *[f"_{mean}" for mean in weights]), "cells"
    )


def of(videos: DataFrame, by: By = NICHE) -> DataFrame:
    """Cells of a niche view."""
    return cells(narrow(videos, by), by)
