import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelgauge.operators import sketches as S

SPANS = [("all", (2020, 1), (2021, 12)), ("spring", (2020, 3), (2020, 5)), ("none", (2030, 1), (2030, 2)), ("one", (2021, 7), (2021, 7))]
ASKED = (0.0, 0.25, 0.5, 0.99, 1.0)


def build(spark, rows):
    return spark.createDataFrame(rows, "niche string, ano int, mes int, view_count long, channel_id string").repartition(4)


@pytest.mark.parametrize(("k", "wide"), [(S.K, S.WIDE), (8, 4.0), (200, 0.001)])
def test_quantiles_are_exact_with_any_sketch(spark, k, wide):
    rng = np.random.default_rng(1)
    rows = [
        ("A" if i % 3 else "B", 2020 + i % 2, 1 + i % 12, int(v) if i % 50 else None, "c")
        for i, v in enumerate(np.concatenate([rng.pareto(0.5, 1500) * 10, np.full(1500, 7), -rng.integers(0, 99, 500)]))
    ]
    found = S.quantiles_by_span(build(spark, [*rows, ("A", None, None, 5, "c")]), SPANS, ASKED, k=k, wide=wide).collect()
    values = {}
    for niche, year, month, views, _ in rows:
        for name, a, b in SPANS:
            if views is not None and a <= (year, month) <= b:
                values.setdefault((niche, name), []).append(views)
    assert {(r.niche, r.span) for r in found} == set(values) and len(found) == len(values) * len(ASKED)
    for r in found:
        assert r.n == len(values[r.niche, r.span])
        assert r.quantile == pytest.approx(np.quantile(values[r.niche, r.span], r.probability), rel=1e-12)


def test_no_group(spark):
    rows = [("A", 2020, 1, i, "c") for i in range(11)]
    found = S.quantiles_by_span(build(spark, rows), SPANS[:1], [0.5], by=()).collect()
    assert [(r.span, r.n, r.quantile) for r in found] == [("all", 11, 5.0)]


def test_shared_channels_exact_and_within_bounds(spark):
    few = [("A", 2020, 1 + i % 12, 1, f"c{i}") for i in range(300)] + [("B", 2020, 1, 1, f"c{i}") for i in range(200, 260)]
    sketches = S.channel_sketches(build(spark, [*few, *few[:50], ("C", 2020, 1, 1, None)]))
    found = {(r.first, r.second): tuple(r)[2:] for r in S.shared_channels(sketches, [("A", "B"), ("A", "C")]).collect()}
    assert found["A", "B"] == (60, 300, 240, 0) and found["A", "C"] == (0, 300, 300, 0)
    many = spark.range(60_000).select(
        F.explode(F.array(*[F.when(F.col("id") < 40_000, "A"), F.when(F.col("id") >= 30_000, "B")])).alias("niche"),
        F.lit(2020).alias("ano"), (F.col("id") % 12 + 1).cast("int").alias("mes"), F.concat(F.lit("c"), "id").alias("channel_id"),
    ).filter("niche IS NOT NULL")
    row = S.shared_channels(S.channel_sketches(many, lg=10), [("A", "B")], lg=10).first()
    bound = 4 * 60_000 / math.sqrt(2**10)
    for got, true in zip(tuple(row)[2:], (10_000, 60_000, 30_000, 20_000), strict=True):
        assert abs(got - true) < bound
