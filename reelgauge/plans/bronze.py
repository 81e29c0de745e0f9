"""Raw JSON rows to bronze tables: flat, typed, nothing dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelgauge.functions.columns import count_from_text, duration_seconds, instant
from reelgauge.sources.readers import CORRUPT


def bronze_channels(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("channel_id"),
        F.col("snippet.title").alias("channel_name"),
        F.col("snippet.customUrl").alias("custom_url"),
        instant(F.col("snippet.publishedAt")).alias("dt_published"),
        F.col("snippet.country").alias("country"),
        count_from_text(F.col("statistics.viewCount")).alias("total_view"),
        count_from_text(F.col("statistics.subscriberCount")).alias("total_subscriber"),
        count_from_text(F.col("statistics.videoCount")).alias("total_video"),
        F.col("contentDetails.relatedPlaylists.uploads").alias("playlist"),
    )


def bronze_videos(raw: DataFrame) -> DataFrame:
    """The two flags tell a missing count from a real zero."""
    likes, comments = F.col("statistics.likeCount"), F.col("statistics.commentCount")
    return raw.select(
        F.col("id").alias("video_id"),
        F.col("snippet.title").alias("title"),
        F.col("snippet.channelId").alias("channel_id"),
        F.col("snippet.channelTitle").alias("channel_name"),
        instant(F.col("snippet.publishedAt")).alias("published_at"),
        F.col("contentDetails.duration").alias("duration"),
        F.col("contentDetails.definition").alias("definition"),
        count_from_text(F.col("statistics.viewCount")).alias("view_count"),
        count_from_text(likes).alias("like_count"),
        count_from_text(comments).alias("comment_count"),
        F.col("snippet.thumbnails.high.url").alias("thumbnail_url"),
        F.col("extraction_date"),
        likes.isNull().alias("like_count_missing"),
        comments.isNull().alias("comment_count_missing"),
    )


def usable(raw: DataFrame) -> DataFrame:
    """Rows of a checked scan that can be read and have an id."""
    return raw.filter(F.col(CORRUPT).isNull() & F.col("id").isNotNull()).drop(CORRUPT, "source_file")


def video_rejects(raw: DataFrame) -> DataFrame:
    """(reason, video_id, source_file, record) for what is wrong in a checked scan, a row for each reason.

    ``unreadable`` and ``no id`` rows are not in bronze; an instant or a
    duration that cannot be read is NULL there.
    """
    at, length = F.col("snippet.publishedAt"), F.col("contentDetails.duration")
    readable = F.col(CORRUPT).isNull()
    reasons = F.array_compact(
        F.array(
            F.when(~readable, "unreadable"),
            F.when(readable & F.col("id").isNull(), "no id"),
            F.when(readable & at.isNotNull() & instant(at).isNull(), "published_at"),
            F.when(readable & length.isNotNull() & duration_seconds(length).isNull(), "duration"),
        )
    )
    whole = F.to_json(F.struct(*[name for name in raw.columns if name not in (CORRUPT, "source_file")]))
    return raw.select(
        F.explode(reasons).alias("reason"),
        F.col("id").alias("video_id"),
        "source_file",
        F.coalesce(CORRUPT, whole).alias("record"),
    )
