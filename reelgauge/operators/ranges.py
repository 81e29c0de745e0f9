"""Places in a global order, without a window over the rows.

Rows are range-partitioned and sorted, numbered inside their partition and
written with that number. The place of a row is its number plus the sizes of
the partitions before it: the only window runs over one row a partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelgauge.session import settle


def placed(df: DataFrame, order: list[str], partitions: int | None = None) -> DataFrame:
    """``df`` with ``place``, from 0, in the order of the columns ``order``.

    Rows that are equal in ``order`` meet in one partition: give an order of
    many values.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = F.monotonically_increasing_id()  # the partition in the upper bits
    numbered = settle(
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_number", number)
        .withColumn("_part", F.shiftright("_number", 33)),
        "placed",
    )
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = settle(sizes.select("_part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before")), "before")
    inside = F.col("_number").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        numbered.join(before, "_part").withColumn("place", F.col("_before") + inside).drop("_part", "_number", "_before")
    )
