import numpy as np
import pytest
from pyspark.sql import functions as F

from reelgauge.operators.quantiles import quantiles

rng = np.random.default_rng(7)
SAMPLES = {
    "counts": [float(x) for x in rng.integers(0, 10**9, 501)],
    "mixed": [float(x) for x in np.round(rng.normal(0, 50, 400), 3)],
    "ties": [0.0] * 90 + [5.0] * 9 + [6.0],
    "tiny": [float(x) for x in rng.random(100) / 1e6],
    "two": [1.0, 2.0],
    "single": [42.0],
    "huge": [float(2**52 + k) for k in range(64)],
}
PROBABILITIES = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.mark.parametrize("most", [100_000, 8])
def test_equal_to_linear_interpolation(spark, most):
    rows = [(name, value) for name, values in SAMPLES.items() for value in values]
    frame = spark.createDataFrame(rows, "g string, x double").repartition(8)
    wanted = {f"q{i}": (F.col("x"), p) for i, p in enumerate(PROBABILITIES)}
    found = {row.g: tuple(row)[1:] for row in quantiles(frame, ["g"], wanted, most=most).collect()}
    assert set(found) == set(SAMPLES)
    for name, values in SAMPLES.items():
        assert found[name] == pytest.approx(np.quantile(values, PROBABILITIES), rel=1e-12), name


def test_several_values_nulls_and_one_group(spark):
    frame = spark.createDataFrame([(float(i), None if i % 2 else 10.0 * i) for i in range(11)], "x double, y double")
    row = quantiles(frame, [], {"x": (F.col("x"), 0.5), "y": (F.col("y"), 0.5), "y9": (F.col("y"), 0.9)}).first()
    assert row.asDict() == {"x": 5.0, "y": 50.0, "y9": 90.0}


def test_one_value_in_a_third_of_the_rows(spark):
    frame = spark.range(30000).select(
        F.lit("g").alias("g"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("x")
    )
    values = [7 if i % 3 == 0 else i for i in range(30000)]
    row = quantiles(frame, ["g"], {"a": (F.col("x"), 0.33), "b": (F.col("x"), 0.9)}).first()
    assert (row.a, row.b) == pytest.approx(tuple(np.quantile(values, [0.33, 0.9])))
