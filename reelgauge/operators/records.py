"""Record holders: the rows with the largest or smallest value of a group."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelgauge.functions import columns as C
from reelgauge.operators import measures as M
from reelgauge.operators.grouped import NICHE, By, any_of, best, join_groups
from reelgauge.session import settle


@dataclass(frozen=True)
class Record:
    """``value`` to maximise (or minimise) and the columns to show, by prefix."""

    name: str
    value: Column
    shown: tuple[str, ...] = ("title", "channel_name")
    lowest: bool = False


def record_holders(
    df: DataFrame, by: By, records: list[Record], key: str = "video_id", extremes: DataFrame | None = None
) -> DataFrame:
    """One row per group: for each record its value and the row that holds it.

    The first pass only takes ``max`` and ``min`` of numbers, which hash
    aggregation handles without sorting the table. The second pass reads the
    text columns of rows that reach a record and settles ties by ``key``.
    ``extremes`` may hold the settled result of the first pass.
    """
    if extremes is None:
        extremes = settle(
            df.groupBy(*by).agg(*[(F.min if r.lowest else F.max)(r.value).alias(r.name) for r in records]),
            "records",
        )
    hits = [(r, r.value == F.col(f"best_{r.name}")) for r in records]
    marked = join_groups(
        df, extremes.withColumnsRenamed({r.name: f"best_{r.name}" for r in records}), by
    ).filter(any_of([hit for _, hit in hits]))
    holders = [
        F.min_by(
            F.when(hit, F.struct(F.col(f"best_{r.name}").alias("value"), *r.shown)),
            F.when(hit, F.col(key)),
        ).alias(r.name)
        for r, hit in hits
    ]
    return marked.groupBy(*by).agg(*holders)


def _extremes(cells: DataFrame, by: By) -> DataFrame:
    return settle(
        cells.groupBy(*by).agg(
            M.lowest(cells, "published_at").alias("first"),
            M.highest(cells, "view_count").alias("views"),
            M.highest(cells, "view_count", F.col("length_class") == "long").alias("long_views"),
            M.highest(cells, "like_count").alias("likes"),
            M.highest(cells, "comment_count").alias("comments"),
            M.highest(cells, "duration").alias("longest"),
            M.highest(cells, "engagement_rate").alias("engagement"),
        ),
        "records",
    )


def catalogue_records(videos: DataFrame, by: By = NICHE, cells: DataFrame | None = None) -> DataFrame:
    """The record board of a niche, one row each.

    With ``cells`` the videos are read once, for the texts of the holders.
    """
    is_long = F.col("length_class") == "long"
    holders = record_holders(
        videos,
        by,
        [
            Record("first", F.col("published_at"), lowest=True),
            Record("views", F.col("view_count")),
            Record("long_views", F.when(is_long, F.col("view_count"))),
            Record("likes", F.col("like_count")),
            Record("comments", F.col("comment_count")),
            Record("longest", F.col("duration")),
            Record("engagement", F.col("engagement_rate")),
        ],
        extremes=None if cells is None else _extremes(cells, by),
    )
    counted = videos if cells is None else cells
    per_channel_month = counted.groupBy(*by, "channel_name", "ano_mes_publish").agg(M.rows(counted).alias("n"))
    months = per_channel_month.groupBy(*by).agg(
        F.count_distinct("ano_mes_publish").alias("n_months")
    )
    busiest = (
        per_channel_month.groupBy(*by, "channel_name")
        .agg(F.sum("n").alias("n_videos"))
        .groupBy(*by)
        .agg(best("n_videos", "channel_name").alias("busiest"))
    )
    board = join_groups(join_groups(holders, busiest, by), months, by)
    return board.select(
        *by,
        F.col("busiest.channel_name").alias("most_videos_channel"),
        F.col("busiest.n_videos").alias("most_videos"),
        F.col("busiest.channel_name").alias("most_per_month_channel"),
        (F.col("busiest.n_videos") / F.col("n_months")).alias("most_per_month"),
        F.col("first.title").alias("first_title"),
        F.col("first.channel_name").alias("first_channel"),
        C.day_month_year(F.col("first.value")).alias("first_date"),
        F.col("views.title").alias("views_title"),
        F.col("views.channel_name").alias("views_channel"),
        F.col("views.value").alias("views"),
        F.col("long_views.title").alias("long_views_title"),
        F.col("long_views.channel_name").alias("long_views_channel"),
        F.col("long_views.value").alias("long_views"),
        F.col("likes.title").alias("likes_title"),
        F.col("likes.channel_name").alias("likes_channel"),
        F.col("likes.value").alias("likes"),
        F.col("comments.title").alias("comments_title"),
        F.col("comments.channel_name").alias("comments_channel"),
        F.col("comments.value").alias("comments"),
        F.col("longest.title").alias("longest_title"),
        F.col("longest.channel_name").alias("longest_channel"),
        C.hours_minutes_seconds(F.col("longest.value")).alias("longest_duration"),
        F.col("engagement.title").alias("engagement_title"),
        F.col("engagement.channel_name").alias("engagement_channel"),
        F.col("engagement.value").alias("engagement_rate"),
    )
