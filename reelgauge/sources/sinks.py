"""Writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgauge import schemas
from reelgauge.session import released
from reelgauge.sources.readers import read_parquet


#: Options of each format a table may be saved in.
FORMATS = {"parquet": {}, "csv": {"header": True}}


def save(df: DataFrame, path: str, format: str = "parquet", source: DataFrame | None = None) -> bool:
    """Replace the table at ``path``; an empty frame is not written.

    ``source`` may name a frame that is empty when ``df`` is and cheaper to
    probe, so that a shuffle in ``df`` does not run twice.
    """
    filled = not (df if source is None else source).isEmpty()
    if filled:
        kind = format.lower()
        if kind not in FORMATS:
            raise ValueError(f"no sink for {format!r}; there are {', '.join(FORMATS)}")
        df.write.format(kind).mode("overwrite").save(path, **FORMATS[kind])
    return filled


def save_table(
    df: DataFrame, path: str, partition_by: list[str], sort_by: list[str], rebalance: bool = True
) -> None:
    """Write a layer partitioned by ``partition_by``, files sorted by ``sort_by``.

    The rebalance hint lets adaptive execution merge small and split large
    output partitions, so one heavy year does not end up in one task or in
    thousands of small files. Sorted files let Parquet statistics skip row
    groups of other channels. The whole table is replaced: partitions that no
    longer occur go.

    Rows that a shuffle before has dealt into tasks of even size may be written
    from where they lie, without ``rebalance``: a file for each of its
    partitions from every task, and no second shuffle of whole rows.
    """
    dealt = df.hint("rebalance", *partition_by) if rebalance else df
    with released(df.sparkSession):
        (
            dealt.sortWithinPartitions(*partition_by, *sort_by)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .option("compression", "zstd")
            .partitionBy(*partition_by)
            .parquet(path)
        )


def land_json(df: DataFrame, path: str, run_date: Column | str | None = None) -> bool:
    """Land raw rows as JSON lines, one folder per extraction date.

    Only the folders of the dates in ``df`` are replaced.
    """
    stamped = df if run_date is None else stamp_extraction_date(df, run_date)
    if stamped.isEmpty():
        return False
    (
        stamped.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("extraction_date")
        .json(path)
    )
    return True


def stamp_extraction_date(df: DataFrame, run_date: Column | str) -> DataFrame:
    day = F.to_date(F.lit(run_date)) if isinstance(run_date, str) else run_date
    return df.withColumn("extraction_date", F.date_format(day, "yyyy-MM-dd"))


def valid_suggestions(df: DataFrame) -> DataFrame:
    """A suggestion needs a channel name."""
    return df.select("channel_name", "dashboard").filter(F.length("channel_name") > 0)


def append_suggestions(df: DataFrame, path: str) -> None:
    """Add files to the log; earlier ones stay as they are."""
    valid_suggestions(df).write.mode("append").parquet(path)


def read_suggestions(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet(spark, path, schemas.SUGGESTION, missing_ok=True)
