"""Building blocks shared by the analyses.

``by`` names the grouping columns of an analysis: ``("niche",)`` answers every
niche in one job, ``()`` treats the frame as one group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

By = Sequence[str]
NICHE: By = ("niche",)


def within(by: By):
    return Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))


def join_groups(df: DataFrame, summary: DataFrame, by: By) -> DataFrame:
    """Attach the summary row of each group.

    Next to a large ``df`` the summary should be a settled table, so that
    Catalyst knows its size. A single group is attached by scalar subqueries.
    """
    if by:
        return df.join(summary, list(by))
    return df.select("*", *[summary.select(c).scalar().alias(c) for c in summary.columns])


def best(value: str, key: str, *, lowest: bool = False) -> Column:
    """Struct row with the best ``value``, ties to the smallest ``key``.

    For frames of a few rows per group; fact tables go through ``records``.
    """
    rank = F.col(value) if lowest else -F.col(value)
    order = F.when(F.col(value).isNotNull(), F.struct(rank.alias("rank"), F.col(key)))
    return F.min_by(F.struct(F.col(key), F.col(value)), order)


def displayed(df: DataFrame, places: int | Mapping[str, int]) -> DataFrame:
    """Doubles rounded for display, halves to the even digit: all of them, or the named ones."""
    doubles = [field.name for field in df.schema.fields if field.dataType.simpleString() == "double"]
    wanted = dict.fromkeys(doubles, places) if isinstance(places, int) else places
    return df.withColumns({name: F.bround(name, digits) for name, digits in wanted.items()})


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda left, right: left | right, conditions)
