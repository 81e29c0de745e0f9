"""Aggregates that take rows or cells.

An analysis built on these runs on a niche view, row by row, or on the cells of
``cube.cells``, which hold counts, sums and moments of many rows each. ``when``
restricts an aggregate to rows or cells for which it holds; on cells it may use
their keys only.

Moments of cells are merged by Chan's formulas: squared deviations add up,
plus what the means of the parts lie apart. Means are kept as distances from
the mean of the whole group, so that nothing large is subtracted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelgauge.operators import significance

ROWS = "n_rows"
#: Less than this share of the squares is rounding: a constant sample.
_NOISE = 1e-12


def are_cells(df: DataFrame) -> bool:
    return ROWS in df.columns


def _if(column: Column, when: Column | None) -> Column:
    return column if when is None else F.when(when, column)


def _sum(name: str, when: Column | None) -> Column:
    return F.sum(_if(F.col(name), when))


def rows(df: DataFrame, when: Column | None = None) -> Column:
    return F.coalesce(_sum(ROWS, when), F.lit(0)) if are_cells(df) else F.count(_if(F.lit(1), when))


def count(df: DataFrame, name: str, when: Column | None = None) -> Column:
    """Rows where ``name`` is known."""
    return F.coalesce(_sum(f"n_{name}", when), F.lit(0)) if are_cells(df) else F.count(_if(F.col(name), when))


def total(df: DataFrame, name: str, when: Column | None = None) -> Column:
    return _sum(f"sum_{name}" if are_cells(df) else name, when)


def average(df: DataFrame, name: str, when: Column | None = None) -> Column:
    if not are_cells(df):
        return F.avg(_if(F.col(name), when))
    n = count(df, name, when)
    return F.when(n > 0, total(df, name, when) / n)


def highest(df: DataFrame, name: str, when: Column | None = None) -> Column:
    return F.max(_if(F.col(f"max_{name}" if are_cells(df) else name), when))


def lowest(df: DataFrame, name: str, when: Column | None = None) -> Column:
    return F.min(_if(F.col(f"min_{name}" if are_cells(df) else name), when))


def _spread(n: Column, squares: Column, x: Column, y: Column) -> Column:
    """Sum of products of deviations of all parts: sizes, own sums, distances of the means."""
    apart = F.sum(n * x * y)
    whole = F.sum(squares) + apart - F.sum(n * x) * F.sum(n * y) / F.sum(n)
    return F.when(F.abs(whole) <= _NOISE * (F.sum(F.abs(squares)) + F.abs(apart)), 0.0).otherwise(whole)


def sample(df: DataFrame, column: str, name: str, when: Column | None = None) -> list[Column]:
    """Size, mean and variance, named as ``significance.sample`` names them."""
    if not are_cells(df):
        return significance.sample(_if(F.col(column), when), name)
    n, apart = _if(F.col(f"n_{column}"), when), F.coalesce(f"apart_{column}", F.lit(0.0))
    size = F.sum(n)
    spread = _spread(n, _if(F.col(f"squares_{column}"), when), apart, apart)
    return [
        F.coalesce(size, F.lit(0)).alias(f"n_{name}"),
        average(df, column, when).alias(f"mean_{name}"),
        F.when(size > 1, spread / (size - 1)).alias(f"var_{name}"),
    ]


def correlation(df: DataFrame, x: str, y: str) -> tuple[Column, Column]:
    """Pairs and Pearson's r of two measures over rows where both are known."""
    if not are_cells(df):
        return significance.pairs(F.col(x), F.col(y)), significance.pearson(F.col(x), F.col(y))
    pair = f"{x}_{y}"
    n = F.col(f"pairs_{pair}")
    a, b = (F.coalesce(f"{side}_apart_{pair}", F.lit(0.0)) for side in "xy")
    both = _spread(n, F.col(f"x_squares_{pair}"), a, a) * _spread(n, F.col(f"y_squares_{pair}"), b, b)
    return (
        F.coalesce(F.sum(n), F.lit(0)),
        F.when(both > 0, _spread(n, F.col(f"products_{pair}"), a, b) / F.sqrt(both)),
    )
