"""Daily counts kept current by a stream.

A key counts once a day, with the amount it had in the first trigger that
brought it (of rows of one trigger that differ, one of them); rows without a
key count each. Which (day, key) pairs have been seen is state of the stream,
held in RocksDB on the executors, without a watermark: a late row reopens its
day however old it is, a repeated one never counts again, and how many files a
trigger takes cannot change a total. A trigger passes on what is new only, so
its work follows the rows it brings, not the rows of the days they touch.

What a trigger adds to each day is a folder of its own, a row a day; a replayed
trigger overwrites its folder. Every ``ERA`` triggers the sums so far are
written as a new base, and readers take the last base and what came after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from reelgauge import schemas
from reelgauge.plans.bronze import bronze_videos
from reelgauge.plans.silver import silver_videos
from reelgauge.sources.readers import read_parquet

#: Triggers between two bases.
ERA = 64

DAYS = T.StructType([
    T.StructField("day", T.DateType()),
    T.StructField("n", T.LongType()),
    T.StructField("total", T.DoubleType()),
])


def event_stream(spark: SparkSession, folder: str, pattern: str = "events.parquet", files: int = 1000) -> DataFrame:
    """Events with an instant ``ts``; ``files`` bounds the size of a micro-batch."""
    return (
        spark.readStream.schema(schemas.EVENT)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files)
        .parquet(folder)
        .withColumn("ts", F.col("ts").cast("timestamp"))
    )


def landed_video_stream(spark: SparkSession, folder: str, files: int = 1000) -> DataFrame:
    """Silver rows of newly landed JSON."""
    raw = (
        spark.readStream.schema(schemas.RAW_VIDEO)
        .option("maxFilesPerTrigger", files)
        .json(folder)
        .withColumn("extraction_date", F.date_format("extraction_date", "yyyy-MM-dd"))
    )
    return silver_videos(bronze_videos(raw))


def start_daily(
    stream: DataFrame, table: str, checkpoint: str, key: str, day: Column, amount: Column
) -> StreamingQuery:
    """Process what is there and stop; later runs continue from ``checkpoint``."""
    rows = stream.select(
        F.to_date(day).alias("day"), F.col(key).cast("string").alias("key"), amount.cast("double").alias("amount")
    )
    new = rows.filter("key IS NOT NULL").dropDuplicates(["day", "key"]).unionByName(rows.filter("key IS NULL"))

    def add(batch: DataFrame, batch_id: int) -> None:
        spark, era = batch.sparkSession, batch_id // ERA
        _sums(batch.select("day", F.lit(1).alias("n"), F.col("amount").alias("total"))).coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{table}/added/era={era}/batch={batch_id}")
        if batch_id % ERA == ERA - 1:
            whole = _sums(_so_far(spark, table, era))
            whole.coalesce(1).write.mode("overwrite").parquet(f"{table}/base/era={era}")

    return (
        new.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _sums(rows: DataFrame) -> DataFrame:
    """One row a day of a calendar."""
    return rows.groupBy("day").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def _so_far(spark: SparkSession, table: str, era: int) -> DataFrame:
    """What the base before ``era`` holds and what the triggers of ``era`` have added."""
    base = read_parquet(spark, f"{table}/base/era={era - 1}", DAYS, missing_ok=True)
    return base.unionByName(read_parquet(spark, f"{table}/added/era={era}", DAYS, missing_ok=True))


def daily_totals(spark: SparkSession, table: str) -> DataFrame:
    """(day, n, total); no rows before the first batch."""
    numbered = T.StructType([*DAYS.fields, T.StructField("era", T.IntegerType())])
    last = read_parquet(spark, f"{table}/base", numbered, missing_ok=True).agg(F.max("era")).first()[0]
    return _sums(_so_far(spark, table, 0 if last is None else last + 1))


def monthly_totals(spark: SparkSession, table: str) -> DataFrame:
    month = F.date_format("day", "yyyy-MM").alias("ano_mes")
    return daily_totals(spark, table).groupBy(month).agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
