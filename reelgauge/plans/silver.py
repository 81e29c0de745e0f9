"""Bronze to silver: durations in seconds, calendar parts, rates per view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelgauge.functions import columns as C

REQUIRED = ("published_at", "duration", "view_count", "like_count", "comment_count")


def require(df: DataFrame, names) -> DataFrame:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {', '.join(missing)}")
    return df


def silver_videos(bronze: DataFrame) -> DataFrame:
    require(bronze, REQUIRED)
    views = F.col("view_count")
    at = F.col("published_at")
    return bronze.withColumns({"published_at": at.cast("timestamp")}).withColumns({
        "duration": C.duration_seconds(F.col("duration")),
        "dia_semana": C.weekday_name(at),
        "hora_publicacao": F.hour(at),
        "mes": F.month(at),
        "ano": F.year(at),
        "dia": F.dayofmonth(at),
        "semana_do_ano": F.weekofyear(at),
        "ano_da_semana": F.extract(F.lit("YEAROFWEEK"), at),
        "ano_mes_publish": C.month_label(at),
        "engagement_rate": C.per_view(F.col("like_count") + F.col("comment_count"), views),
        "like_ratio": C.per_view(F.col("like_count"), views),
        "comment_ratio": C.per_view(F.col("comment_count"), views),
    })


def duration_rejects(bronze: DataFrame) -> DataFrame:
    """Rows whose duration text cannot be read."""
    return bronze.filter(
        F.col("duration").isNotNull() & C.duration_seconds(F.col("duration")).isNull()
    )
