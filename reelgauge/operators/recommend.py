"""Rules that turn the analyses into advice, one row per group."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelgauge.operators import compare, cube, titles, weekday
from reelgauge.operators.grouped import NICHE, By


INPUTS = {
    "long_short_ratio": compare.ratio,
    "title_length_best": titles.length_best,
    "keyword_impact": partial(titles.keyword_impact, limit=1),
    "emoji_impact": titles.emoji_impact,
    "weekday_best_worst": weekday.best_worst,
}


def recommendations(videos: DataFrame, by: By = NICHE) -> DataFrame:
    """All but the keyword's test is drawn from cells, one pass over the videos."""
    cells = cube.of(videos, by)
    frames = {"keyword_impact": videos}
    return advice({name: analysis(frames.get(name, cells), by=by) for name, analysis in INPUTS.items()}, by)


def advice(results: dict[str, DataFrame], by: By = NICHE) -> DataFrame:
    """The rules over finished analyses, each with the p-value of its own test.

    The keyword is the most frequent word of popular titles.
    """
    shorts = results["long_short_ratio"]
    length = results["title_length_best"].select(*by, "best_views_length")
    keyword = (
        results["keyword_impact"]
        .filter(F.col("rank") == 1)
        .select(*by, "keyword", F.coalesce("significant", F.lit(False)).alias("use_keyword"))
    )
    emoji = (
        results["emoji_impact"]
        .groupBy(*by)
        .agg(F.coalesce(F.bool_or("significant"), F.lit(False)).alias("use_emoji"))
    )
    day = results["weekday_best_worst"].select(*by, F.col("best_day_pt").alias("publish_on"))
    parts = [shorts, length, keyword, emoji, day]
    if not by:
        parts = [part.withColumn("all", F.lit(1)) for part in parts]
    keys = list(by) or ["all"]
    joined = reduce(lambda left, right: left.join(right, keys, "left"), parts)
    return joined if by else joined.drop("all")
