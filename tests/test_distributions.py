import pytest
from pyspark.sql import functions as F

from reelgauge.functions import distributions
from reelgauge.functions.distributions import f_upper, t_two_sided

FREEDOM = [1.0, 2.0, 3.7, 12.5, 100.0, 1e4]  # beyond, the other side loses digits
VALUES = [0.0, 0.01, 0.5, 1.0, 1.7, 2.0, 5.0, 40.0]


def test_known_values(spark):
    t, f = spark.range(1).select(
        t_two_sided(F.lit(2.0), F.lit(12.5)), f_upper(F.lit(2.19), F.lit(6), F.lit(100))
    ).first()
    assert t == pytest.approx(0.0677109, abs=1e-7)
    assert f == pytest.approx(0.0500594, abs=1e-7)


def test_t_equals_reference_distribution(spark):
    rows = [(t, df) for t in VALUES for df in FREEDOM]
    frame = spark.createDataFrame(rows, "t double, df double")
    found = frame.select("t", "df", t_two_sided(F.col("t"), F.col("df")).alias("p")).collect()
    student = spark._jvm.org.apache.commons.math3.distribution.TDistribution
    for row in found:
        expected = 2 * student(row.df).cumulativeProbability(-row.t)
        assert row.p == pytest.approx(expected, abs=1e-9), row


@pytest.mark.parametrize("df1", [1.0, 6.0, 30.0])
def test_f_equals_reference_distribution(spark, df1):
    rows = [(f, df) for f in VALUES for df in FREEDOM]
    frame = spark.createDataFrame(rows, "f double, df double")
    found = frame.select("f", "df", f_upper(F.col("f"), F.lit(df1), F.col("df")).alias("p")).collect()
    fisher = spark._jvm.org.apache.commons.math3.distribution.FDistribution
    for row in found:
        expected = 1 - fisher(df1, row.df).cumulativeProbability(row.f)
        assert row.p == pytest.approx(expected, abs=1e-9), row


def test_billions_of_degrees_approach_the_normal(spark):
    p = spark.range(1).select(t_two_sided(F.lit(1.959963984540054), F.lit(1e14))).first()[0]
    assert p == pytest.approx(0.05, abs=1e-7)


def test_undefined_statistics_give_null(spark):
    empty = F.lit(None).cast("double")
    row = spark.range(1).select(
        t_two_sided(empty, F.lit(3.0)), t_two_sided(F.lit(1.0), F.lit(0.0)), f_upper(empty, F.lit(1), F.lit(1))
    ).first()
    assert tuple(row) == (None, None, None)


def test_binomial_at_most_matches_exact_sums(spark):
    from fractions import Fraction
    from math import comb

    cases = [(0, 100), (1, 100), (3, 1000), (40, 5000), (0, 5), (70, 4000), (30, 3000), (0, 0)]
    p = 0.02
    frame = spark.createDataFrame(cases, "k long, n long")
    got = frame.select("k", "n", distributions.binomial_at_most(F.col("k"), F.col("n"), p).alias("p")).collect()
    for row in got:
        share = Fraction(p)
        exact = float(sum(comb(row.n, j) * share**j * (1 - share) ** (row.n - j) for j in range(row.k + 1)))
        if row.k < row.n * p:
            assert abs(row.p - exact) <= 1e-9 + 1e-9 * exact
        else:
            assert row.p == 1.0
