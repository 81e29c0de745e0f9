"""Exact quantiles of large groups.

The built-in ``percentile`` keeps every distinct value of a group in one task.
Here a first pass counts rows per logarithmic bucket, which is a small
aggregate, and finds the buckets that hold the wanted ranks. While such a
bucket holds more than ``MOST`` rows of different values, its range is cut
again into equal parts, a pass for each cut. A last pass counts the distinct
values of what is left and picks the ranks, so no task sorts more than ``MOST``
distinct values of a bucket, however the values are spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelgauge.operators.grouped import By
from reelgauge.session import settle

_BUCKETS_PER_OCTAVE = 128
_PARTS = 4096
MOST = 100_000


def _bucket(value: Column) -> Column:
    """Integer bucket that never decreases as ``value`` grows."""
    size = F.floor(F.log2(1 + F.abs(value)) * _BUCKETS_PER_OCTAVE)
    return F.when(value < 0, -size).otherwise(size)


def _running(by: list[str], order: str):
    return Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)


def quantiles(
    df: DataFrame,
    by: By,
    wanted: dict[str, tuple[Column, float]],
    label: str = "quantiles",
    most: int = MOST,
) -> DataFrame:
    """One row per group with a column per entry of ``wanted``.

    An entry maps a name to a value expression and a probability in 0..1. A
    value expression that is NULL leaves the row out. Values between two ranks
    are interpolated linearly. Settle the result before joining it to a table.
    """
    keys = list(by)
    group_keys = ["metric", *keys]
    metrics: dict[str, tuple[Column, list[float]]] = {}
    for column, probability in wanted.values():
        metrics.setdefault(str(column), (column, []))[1].append(probability)

    measured = F.array(*[
        F.struct(F.lit(number).alias("metric"), column.cast("double").alias("value"))
        for number, (column, _) in enumerate(metrics.values())
    ])
    long = (
        df.select(*keys, F.inline(measured))
        .filter(F.col("value").isNotNull())
        .select("*", _bucket(F.col("value")).alias("bucket"))
    )

    last = F.col("total") - 1
    before = F.col("upto") - F.col("n")

    def ranks(p: Column) -> Column:
        position = p * last
        both = F.array_distinct(F.array(F.floor(position), F.ceil(position)))
        return F.transform(
            both,
            lambda rank: F.struct(
                p.alias("probability"),
                (position - F.floor(position)).alias("share"),
                (rank - before).alias("inside"),
                (rank > position).alias("upper"),
            ),
        )

    probabilities = F.array(*[
        F.array(*[F.lit(float(p)) for p in dict.fromkeys(ps)]) for _, ps in metrics.values()
    ])
    wanted_ranks = F.flatten(F.transform(F.get(probabilities, F.col("metric")), ranks))
    inside = F.filter(wanted_ranks, lambda t: (t["inside"] >= 0) & (t["inside"] < F.col("n")))
    buckets = (
        long.groupBy(*group_keys, "bucket")
        .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
        .select(
            "*",
            F.sum("n").over(_running(group_keys, "bucket")).alias("upto"),
            F.sum("n").over(Window.partitionBy(*group_keys)).alias("total"),
        )
        .select(*group_keys, "bucket", "low", "high", "n", inside.alias("targets"))
        .filter(F.size("targets") > 0)
    )
    targets = settle(buckets, label)
    span = [*group_keys, "bucket", "low", "high"]
    in_span = F.col("value").between(F.col("low"), F.col("high"))
    while not (wide := targets.filter((F.col("n") > most) & (F.col("low") < F.col("high")))).isEmpty():
        targets = settle(
            _cut(long, wide, group_keys, span, in_span).unionByName(
                targets.filter(~((F.col("n") > most) & (F.col("low") < F.col("high"))))
            ),
            label,
        )

    found = (
        long.join(targets.select(*span), [*group_keys, "bucket"])
        .filter(in_span)
        .groupBy(*span, "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(_running(span, "value")))
        .join(targets.drop("n"), span)
        .select(*group_keys, "value", "n", "upto", F.inline("targets"))
        .filter(
            (F.col("inside") < F.col("upto")) & (F.col("inside") >= F.col("upto") - F.col("n"))
        )
    )
    numbers = {name: number for number, name in enumerate(metrics)}

    def picked(column: Column, probability: float) -> Column:
        mine = (F.col("metric") == numbers[str(column)]) & (F.col("probability") == float(probability))
        low = F.max(F.when(mine & ~F.col("upper"), F.col("value")))
        high = F.max(F.when(mine & F.col("upper"), F.col("value")))
        return low + F.coalesce((high - low) * F.max(F.when(mine, F.col("share"))), F.lit(0.0))

    return found.groupBy(*keys).agg(*[picked(*entry).alias(name) for name, entry in wanted.items()])


def _cut(long: DataFrame, wide: DataFrame, group_keys: list[str], span: list[str], in_span: Column) -> DataFrame:
    """The parts of wide spans that hold the wanted ranks, in the form of the spans."""
    part = F.floor((F.col("value") - F.col("low")) / (F.col("high") - F.col("low")) * _PARTS)
    parts = (
        long.join(wide.select(*span), [*group_keys, "bucket"])
        .filter(in_span)
        .groupBy(*span, part.alias("part"))
        .agg(F.count(F.lit(1)).alias("m"), F.min("value").alias("least"), F.max("value").alias("most"))
        .withColumn("before", F.sum("m").over(_running(span, "part")) - F.col("m"))
    )
    moved = F.transform("targets", lambda t: t.withField("inside", t["inside"] - F.col("before")))
    mine = F.filter(moved, lambda t: (t["inside"] >= 0) & (t["inside"] < F.col("m")))
    return (
        parts.join(wide, span)
        .select(*group_keys, "bucket", F.col("least").alias("low"), F.col("most").alias("high"),
                F.col("m").alias("n"), mine.alias("targets"))
        .filter(F.size("targets") > 0)
    )
