"""Tail probabilities of Student's t and Fisher's F as column expressions.

Both reduce to the regularised incomplete beta function. It is evaluated by its
continued fraction with ``aggregate`` over a short sequence, so the p-value of
a test stays inside the JVM. Every term is written so that it stays accurate
when the degrees of freedom run into billions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_PAIRS = 80  # the fraction settles in fewer than 60 for 1 to 1e12 degrees of freedom
_TINY = 1e-300
# Above this the distribution is its own limit to nine places, while the
# fraction would subtract nearly equal numbers.
_MOST_FREEDOM = 1e10
_SHIFT = 8


def _stirling_tail(z: Column) -> Column:
    """What ln Γ(z) has beyond (z - 1/2) ln z - z + ln(2π)/2, for z >= 8."""
    w = 1 / (z * z)
    return (1 / 12 - w * (1 / 360 - w * (1 / 1260 - w * (1 / 1680 - w / 1188)))) / z


def _rising_log(z: Column) -> Column:
    total = F.log(z)
    for step in range(1, _SHIFT):
        total = total + F.log(z + step)
    return total


def _log_gamma(z: Column) -> Column:
    s = z + _SHIFT
    return (s - 0.5) * F.log(s) - s + 0.5 * math.log(2 * math.pi) + _stirling_tail(s) - _rising_log(z)


def _log_gamma_step(a: Column, b: Column) -> Column:
    """ln Γ(a + b) - ln Γ(a) without subtracting two large numbers."""
    s = a + _SHIFT
    gap = (s - 0.5) * F.log1p(b / s) + b * F.log(s + b) - b + _stirling_tail(s + b) - _stirling_tail(s)
    rise = F.log1p(b / a)
    for step in range(1, _SHIFT):
        rise = rise + F.log1p(b / (a + step))
    return gap - rise


def _fraction(a: Column, b: Column, x: Column) -> Column:
    """Continued fraction of the incomplete beta, evaluated from its far end."""

    def term(k: Column) -> Column:
        m = F.floor(k / 2)
        even = m * (b - m) / (a + k - 1)
        odd = -(a + m) * (a + b + m) / (a + k)
        return F.when(k % 2 == 0, even).otherwise(odd) * x / (a + 2 * m)

    depth = F.sequence(F.lit(2 * _PAIRS + 1), F.lit(1))
    return F.aggregate(depth, F.lit(1.0), lambda rest, k: 1 + term(k) / rest, lambda rest: 1 / rest)


def _beta_tail(a: Column, b: Column, x: Column, y: Column) -> Column:
    """I_x(a, b), where ``y = 1 - x`` is passed to keep its digits."""
    front = F.exp(_log_gamma_step(a, b) - _log_gamma(b) + a * _log_of(x, y) + b * _log_of(y, x))
    return (
        F.when(x <= 0, 0.0)
        .when(y <= 0, 1.0)
        .when(x < (a + 1) / (a + b + 2), front * _fraction(a, b, x) / a)
        .otherwise(1 - front * _fraction(b, a, y) / b)
    )


def _log_of(x: Column, y: Column) -> Column:
    return F.when(x < 0.5, F.log(F.greatest(x, F.lit(_TINY)))).otherwise(F.log1p(-F.least(y, F.lit(0.5))))


def t_two_sided(t: Column, df: Column) -> Column:
    """Chance of a |t| at least this large."""
    t, df = t.cast("double"), F.least(df.cast("double"), F.lit(_MOST_FREEDOM))
    whole = df + t * t
    p = _beta_tail(df / 2, F.lit(0.5), df / whole, t * t / whole)
    return F.when(t.isNotNull() & (df > 0), p)


def f_upper(f: Column, df1: Column, df2: Column) -> Column:
    """Chance of an F at least this large."""
    f, df1 = f.cast("double"), df1.cast("double")
    df2 = F.least(df2.cast("double"), F.lit(_MOST_FREEDOM))
    whole = df2 + df1 * f
    p = _beta_tail(df2 / 2, df1 / 2, df2 / whole, df1 * f / whole)
    return F.when((f >= 0) & (df1 > 0) & (df2 > 0), p)


_TERMS = 4000


def binomial_at_most(k: Column, n: Column, p: float) -> Column:
    """Chance of at most ``k`` successes in ``n`` trials, for k below the mean.

    Terms are summed from the k-th down; each is a smaller share of the one
    before it, so what lies beyond the last one is bounded by a geometric
    series and added. The result is exact to rounding or a little too large,
    never too small. 1 where k is not below the mean.
    """
    k, n = k.cast("double"), n.cast("double")
    choose = _log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1)
    first = F.exp(choose + k * math.log(p) + (n - k) * math.log1p(-p))
    odds = (1 - p) / p

    def down(state: Column, j: Column) -> Column:
        term = state["term"] * j * odds / (n - j + 1)
        return F.struct(term.alias("term"), (state["total"] + term).alias("total"))

    last = F.greatest(k - _TERMS, F.lit(0.0))
    steps = F.when(k > 0, F.sequence(k.cast("long"), (last + 1).cast("long"), F.lit(-1).cast("long")))
    steps = F.coalesce(steps, F.array().cast("array<bigint>"))
    summed = F.aggregate(steps, F.struct(first.alias("term"), first.alias("total")), down)
    share = last * odds / (n - last + 1)
    rest = F.when(last > 0, summed["term"] * share / (1 - share)).otherwise(0.0)
    return F.when(k < n * p, F.least(summed["total"] + rest, F.lit(1.0))).otherwise(1.0)
