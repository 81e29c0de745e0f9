"""Analyses drawn from cells against the same analyses over rows."""

import math

import pytest
from pyspark.sql import functions as F

from oracle import catalogue
from reelgauge.operators import cube, titles
from reelgauge.operators import measures as M
from reelgauge.plans import gold


@pytest.fixture(scope="module")
def view(spark, sf_dir):
    return catalogue.view(spark, sf_dir).cache()


@pytest.fixture(scope="module")
def written(spark, view, tmp_path_factory):
    """All gold tables, and how often the view was read for them."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    folder = str(tmp_path_factory.mktemp("gold"))
    gold.write_gold(view.mapInArrow(counted, view.schema), folder)
    return folder, read.value / view.count()


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-7, abs_tol=1e-7)
    return a == b


def assert_equal(left, right):
    names = sorted(left.columns)
    assert names == sorted(right.columns)
    keys = [n for n in names if left.schema[n].dataType.simpleString() not in ("double", "array<double>")]
    a, b = (sorted(x.select(*keys, *[n for n in names if n not in keys]).collect(), key=lambda r: str(r[: len(keys)])) for x in (left, right))
    assert len(a) == len(b)
    for x, y in zip(a, b, strict=True):
        assert all(map(same, x, y)), (x, y)


def test_gold_reads_the_view_at_most_five_times(written):
    assert written[1] <= 5


@pytest.mark.parametrize("name", sorted(gold.ANALYSES))
def test_gold_equals_the_analysis_over_rows(spark, view, written, name):
    found = spark.read.parquet(f"{written[0]}/{name}")
    assert_equal(found, gold.ANALYSES[name](view))


def test_cells_of_no_group(view):
    cells = cube.of(view, ())
    rows = M.sample(view, "view_count", "x")
    merged = M.sample(cells, "view_count", "x")
    assert_equal(cells.agg(*merged), view.agg(*rows))


def test_moments_survive_large_means_and_constant_samples(spark, videos):
    far = [{"view_count": 10**12 + i % 5, "published_at": f"2024-0{1 + i % 6}-01 10:00:00"} for i in range(200)]
    constant = [{"view_count": 10**9 + 7, "niche": "Same", "published_at": f"2024-0{1 + i % 6}-01 10:00:00"} for i in range(50)]
    frame = videos(*far, *constant)
    cells = cube.of(frame)
    found = {r.niche: r for r in cells.groupBy("niche").agg(*M.sample(cells, "view_count", "x")).collect()}
    values = [10**12 + i % 5 for i in range(200)]
    mean = sum(values) / 200
    # A mean of 10**12 is known to about 10**-4.
    assert found["Fitness"].var_x == pytest.approx(sum((v - mean) ** 2 for v in values) / 199, rel=1e-5)
    assert (found["Same"].n_x, found["Same"].var_x) == (50, 0.0)
    n, r = M.correlation(cells, "title_length", "view_count")
    assert {(x.n, x.r) for x in cells.groupBy("niche").agg(n.alias("n"), r.alias("r")).collect()} == {(200, None), (50, None)}


def test_strict_emoji_needs_titles(view):
    with pytest.raises(ValueError):
        titles.emoji_impact(cube.of(view), strict=True)


def test_empty_view(spark, view):
    none = view.filter(F.lit(False))
    cells = cube.of(none)
    assert cells.collect() == [] and gold.ANALYSES["weekday_stats"](cells).collect() == []
