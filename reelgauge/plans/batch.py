"""The batch job: landed JSON to bronze to silver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelgauge import schemas
from reelgauge.plans.bronze import bronze_channels, bronze_videos, usable, video_rejects
from reelgauge.plans.silver import silver_videos
from reelgauge.sources.harvest import one_landing
from reelgauge.sources.readers import read_json, read_json_checked, read_parquet
from reelgauge.sources.sinks import save, save_table


def run_channels(spark: SparkSession, raw: str, bronze: str, array_files: bool = False) -> bool:
    return save(bronze_channels(read_json(spark, raw, schemas.RAW_CHANNEL, array_files)), bronze)


def run_videos(
    spark: SparkSession,
    raw: str,
    bronze: str,
    silver: str,
    array_files: bool = False,
    rejects: str | None = None,
) -> DataFrame:
    """Build both video layers; returns the silver table as read from disk.

    Of a video landed on several dates the newest row counts. What cannot be
    read is listed in the table ``rejects``, if named.
    """
    checked = read_json_checked(spark, raw, schemas.RAW_VIDEO, array_files)
    if rejects is not None:
        save(video_rejects(checked), rejects)
    landed = usable(checked)
    save(one_landing(bronze_videos(landed), keep="last"), bronze, source=landed)
    rows = silver_videos(read_parquet(spark, bronze, schemas.BRONZE_VIDEO, missing_ok=True))
    save_table(rows, silver, ["ano"], ["channel_id"])
    return read_parquet(spark, silver, schemas.SILVER_VIDEO)
