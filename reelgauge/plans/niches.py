"""Niche membership and the long/short split."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgauge import fixed_values as fixed


def niche_bridge(spark: SparkSession, channels: Mapping[str, list[str]] | None = None) -> DataFrame:
    """(niche, channel_id) pairs; a local relation, whose size Catalyst knows."""
    lists = fixed.NICHE_CHANNELS if channels is None else channels
    pairs = [(niche, channel) for niche, ids in lists.items() for channel in dict.fromkeys(ids)]
    return spark.createDataFrame(pairs, "niche string, channel_id string")


def harvested_channels(spark: SparkSession) -> DataFrame:
    """Every channel to harvest: the distinct ids of all niches."""
    return niche_bridge(spark).select("channel_id").distinct()


def videos_of_niche(videos: DataFrame, niche: str, bridge: DataFrame) -> DataFrame:
    """Videos of one niche; an unknown niche has none."""
    members = bridge.filter(F.col("niche") == niche).select("channel_id")
    return videos.join(members, "channel_id", "left_semi")


def with_niche(videos: DataFrame, bridge: DataFrame) -> DataFrame:
    """One row per video and niche; a repeated pair in the bridge counts once.

    No join hint: Catalyst broadcasts a bridge below the size threshold and
    shuffles a larger one, where adaptive execution splits hot channels.
    """
    return videos.join(bridge.select("niche", "channel_id").distinct(), "channel_id")


def length_class(
    duration: Column,
    niche: Column,
    cuts: Mapping[str, int] | None = None,
    default: int = fixed.DEFAULT_CUT_SECONDS,
) -> Column:
    """"long" above the cut of the niche, "short" up to it, NULL if unknown."""
    cut = F.lit(default)
    for name, seconds in (fixed.CUT_SECONDS if cuts is None else cuts).items():
        cut = F.when(niche == name, F.lit(seconds)).otherwise(cut)
    return F.when(duration > cut, "long").when(duration <= cut, "short")


def niche_view(
    silver: DataFrame, bridge: DataFrame, cuts: Mapping[str, int] | None = None
) -> DataFrame:
    """The frame all analyses take: silver plus niche and length class."""
    split = length_class(F.col("duration"), F.col("niche"), cuts)
    return with_niche(silver, bridge).withColumn("length_class", split)


def keep_channels(videos: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Videos of the chosen channels; no choice keeps all."""
    return videos if names is None else videos.filter(F.col("channel_name").isin(names))
