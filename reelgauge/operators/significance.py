"""Statistical tests on sufficient statistics.

A test is one aggregation to counts, means and variances; the rest is
arithmetic on one row per test.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelgauge.functions.columns import significant
from reelgauge.functions.distributions import f_upper, t_two_sided


def sample(value: Column, name: str) -> list[Column]:
    """Size, mean and variance of ``value``; NULLs are left out."""
    return [
        F.count(value).alias(f"n_{name}"),
        F.avg(value).alias(f"mean_{name}"),
        F.var_samp(value).alias(f"var_{name}"),
    ]


def _squared_error(name: str) -> Column:
    n, var = F.col(f"n_{name}"), F.col(f"var_{name}")
    return F.when(n > 1, var / n)


def welch_t(first: str, second: str) -> Column:
    """Statistic of two samples that ``sample`` named; NULL without spread."""
    spread = _squared_error(first) + _squared_error(second)
    gap = F.col(f"mean_{first}") - F.col(f"mean_{second}")
    return F.when(spread > 0, gap / F.sqrt(spread))


def welch_df(first: str, second: str) -> Column:
    a, b = _squared_error(first), _squared_error(second)
    weight = a * a / (F.col(f"n_{first}") - 1) + b * b / (F.col(f"n_{second}") - 1)
    return F.when(weight > 0, (a + b) * (a + b) / weight)


def with_welch(df, first: str, second: str):
    """Add t_stat, df, p_value and significant."""
    return with_p_value(
        df.withColumns({"t_stat": welch_t(first, second), "df": welch_df(first, second)}),
        t_two_sided(F.col("t_stat"), F.col("df")),
    )


def pearson(x: Column, y: Column) -> Column:
    """Correlation over rows where both are known; NULL for a constant side.

    Built from covariance and variances because ``corr`` raises on a constant
    column under ANSI.
    """
    spread = F.var_pop(F.when(y.isNotNull(), x)) * F.var_pop(F.when(x.isNotNull(), y))
    return F.when(spread > 0, F.covar_pop(x, y) / F.sqrt(spread))


def pairs(x: Column, y: Column) -> Column:
    return F.count(F.when(x.isNotNull(), y))


def with_pearson(df, r: str = "r", n: str = "n"):
    """Add t_stat, p_value and significant to a correlation over ``n`` pairs."""
    rest = 1 - F.col(r) * F.col(r)
    free = F.col(n) - 2
    t = F.when((free > 0) & (rest > 0), F.col(r) * F.sqrt(free / rest))
    p = (
        F.when(F.col(r).isNotNull() & (free == 0), 1.0)
        .when(rest <= 0, 0.0)
        .otherwise(t_two_sided(F.col("t_stat"), free))
    )
    return with_p_value(df.withColumn("t_stat", t), p)


def with_anova(df, groups: str, n: str, between: str, inside: str):
    """Add f_stat, p_value and significant from the two sums of squares."""
    df1, df2 = F.col(groups) - 1, F.col(n) - F.col(groups)
    ratio = F.when(
        (df1 > 0) & (df2 > 0) & (F.col(inside) > 0), (F.col(between) / df1) / (F.col(inside) / df2)
    )
    return with_p_value(df.withColumn("f_stat", ratio), f_upper(F.col("f_stat"), df1, df2))


def with_p_value(df, p: Column):
    return df.withColumn("p_value", p).withColumn("significant", significant(F.col("p_value")))
