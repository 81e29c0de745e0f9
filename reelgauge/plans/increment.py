"""The daily job on new files only.

A ledger lists the files taken so far. Landed files do not change as a rule; if
one has been written anew, what it held before cannot be told apart in the
tables, so that run builds them from all files. Bronze and silver lie in hash buckets of the video id, and a run
rewrites only the buckets its rows fall into, so its work follows what has
landed, not the history. Within a bucket the newest row of a video counts, as
in a full build, so any division of the files into runs gives the same tables.
Whole rows are shuffled once a run, by bucket: bronze is written from there, and
silver from the files of bronze.

The ledger is written last: a run that breaks off is simply repeated, and its
rows, being the same, change nothing the second time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelgauge import schemas
from reelgauge.plans.bronze import bronze_videos, usable, video_rejects
from reelgauge.plans.silver import silver_videos
from reelgauge.session import settle
from reelgauge.sources.harvest import one_landing
from reelgauge.sources.readers import FILES, list_files, read_json_checked, read_parquet

BUCKETS = 64
#: Bytes of landed files whose rows one task sorts.
SLICE = 128 << 20


@dataclass(frozen=True)
class Layers:
    """Where the tables are. ``buckets`` is the same for every run; a bucket is the least that is rewritten."""

    raw: str
    bronze: str
    silver: str
    ledger: str
    rejects: str | None = None
    buckets: int = BUCKETS
    array_files: bool = False

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64("video_id"), F.lit(self.buckets)).cast("int")


def _bucketed(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])


def _replace(rows: DataFrame, path: str, sort_by: list[str], whole: bool) -> None:
    """Replace the whole table or the buckets that occur in ``rows``; the others keep their files.

    Rows are written from where they lie; the rows of a bucket are to be in few tasks.
    """
    (
        rows.sortWithinPartitions("bucket", *sort_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .option("compression", "zstd")
        .partitionBy("bucket")
        .parquet(path)
    )


def _newest(rows: DataFrame, slices: int) -> DataFrame:
    """The newest row of each video; a bucket lies in ``slices`` parts at most."""
    dealt = rows.withColumn("slice", F.pmod(F.xxhash64("video_id", F.lit("slice")), F.lit(slices)))
    return one_landing(dealt.repartition("bucket", "slice"), keep="last", near=("bucket", "slice")).drop("slice")


def _buckets(rows: DataFrame) -> list[int]:
    """The buckets of new rows. The hash takes every column: what counts as unreadable depends on the columns read."""
    found = rows.groupBy("bucket").agg(F.bit_xor(F.xxhash64(*rows.columns)).alias("read"))
    return sorted(row["bucket"] for row in found.collect())  # a bounded number


def _taken(spark: SparkSession, layers: Layers) -> DataFrame:
    return read_parquet(spark, layers.ledger, FILES, missing_ok=True)


def new_files(spark: SparkSession, layers: Layers) -> DataFrame:
    return settle(list_files(spark, layers.raw).join(_taken(spark, layers), FILES.names, "left_anti"), "new-files")


def run_increment(spark: SparkSession, layers: Layers) -> list[int]:
    """Take the files landed since the last run; returns the buckets rewritten."""
    files = new_files(spark, layers)
    whole = not files.join(_taken(spark, layers).select("path"), "path", "left_semi").isEmpty()
    if whole:
        files = settle(list_files(spark, layers.raw), "all-files")
    paths = [row["path"] for row in files.select("path").collect()]  # a scan holds the names of its files anyway
    if not paths:
        return []
    mode = "overwrite" if whole else "append"
    checked = read_json_checked(spark, layers.raw, schemas.RAW_VIDEO, layers.array_files, paths)
    if layers.rejects is not None:
        video_rejects(checked).write.mode(mode).parquet(layers.rejects)
    fresh = bronze_videos(usable(checked)).withColumn("bucket", layers.bucket())
    held = read_parquet(spark, layers.bronze, _bucketed(schemas.BRONZE_VIDEO), missing_ok=True)
    first = whole or held.isEmpty()
    touched = [] if first else _buckets(fresh)
    if first or touched:
        rows = fresh if first else held.filter(F.col("bucket").isin(touched)).unionByName(fresh)
        taken = files if whole else files.unionByName(_taken(spark, layers))
        size = taken.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("size")).first()["size"]
        # Buckets that are read are replaced when all their rows are written elsewhere.
        _replace(_newest(rows, 1 + size // (layers.buckets * SLICE)), layers.bronze, ["channel_id"], whole)
        held = read_parquet(spark, layers.bronze, _bucketed(schemas.BRONZE_VIDEO), missing_ok=True)
        if first:
            touched = sorted(row["bucket"] for row in held.select("bucket").distinct().collect())
        written = held.filter(F.col("bucket").isin(touched))
        _replace(silver_videos(written), layers.silver, ["ano", "channel_id"], whole)
    files.write.mode(mode).parquet(layers.ledger)
    return touched


def bronze(spark: SparkSession, layers: Layers) -> DataFrame:
    return read_parquet(spark, layers.bronze, schemas.BRONZE_VIDEO, missing_ok=True)


def silver(spark: SparkSession, layers: Layers) -> DataFrame:
    """Files are sorted by year and channel, so filters on them skip row groups."""
    return read_parquet(spark, layers.silver, schemas.SILVER_VIDEO, missing_ok=True)
