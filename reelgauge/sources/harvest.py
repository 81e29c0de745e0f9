"""From channel ids to the request manifest and back to landed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelgauge import fixed_values as fixed
from reelgauge import schemas
from reelgauge.operators.ranges import placed
from reelgauge.sources.readers import parse_json


def id_batches(
    ids: DataFrame,
    key: str = "channel_id",
    item: str = "video_id",
    size: int = fixed.BATCH_SIZE,
    bucket_digits: int = 3,
) -> DataFrame:
    """Cut the distinct ids of every ``key`` into numbered batches of ``size``.

    Ids are ranked by their MD5. The first digits of it are evenly spread
    buckets that keep that order, so the rank is the row number inside a bucket
    plus the sizes of the buckets before it, and a key that holds a third of
    all ids is ranked by thousands of tasks.

    The NULL filter and the left join give both uses of the distinct ids the
    same plan, so their shuffle runs once.
    """
    bucketed = (
        ids.select(key, item)
        .filter(F.col(key).isNotNull() & F.col(item).isNotNull())
        .distinct()
        .withColumn("digest", F.md5(item))
        .withColumn("bucket", F.substring("digest", 1, bucket_digits))
    )
    earlier = Window.partitionBy(key).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy(key, "bucket")
        .agg(F.count(F.lit(1)).alias("in_bucket"))
        .select(key, "bucket", F.coalesce(F.sum("in_bucket").over(earlier), F.lit(0)).alias("offset"))
    )
    inside = Window.partitionBy(key, "bucket").orderBy("digest", item)
    return (
        bucketed.withColumn("rank", F.row_number().over(inside))
        .join(offsets, [key, "bucket"], "left")
        .withColumn("batch_no", F.floor((F.col("offset") + F.col("rank") - 1) / size))
        .groupBy(key, "batch_no")
        .agg(F.sort_array(F.collect_list(item)).alias("ids"))
        .withColumn("n_ids", F.size("ids"))
    )


def id_batches_global(ids: DataFrame, item: str = "video_id", size: int = fixed.BATCH_SIZE) -> DataFrame:
    """Cut the distinct ids of all channels together into batches of ``size``: as few requests as there can be.

    Places come from ``ranges.placed``, so no task ranks more than a range of
    the ids; only the last batch may be smaller.
    """
    distinct = ids.select(item).filter(F.col(item).isNotNull()).distinct()
    return (
        placed(distinct, [item])
        .groupBy(F.floor(F.col("place") / size).alias("batch_no"))
        .agg(F.sort_array(F.collect_list(item)).alias("ids"))
        .withColumn("n_ids", F.size("ids"))
    )


def playlists(raw_channels: DataFrame) -> DataFrame:
    """Uploads playlist of every channel."""
    return raw_channels.select(
        F.col("id").alias("channel_id"),
        F.col("contentDetails.relatedPlaylists.uploads").alias("playlist"),
    )


def page_ids(pages: DataFrame, text: str = "page") -> DataFrame:
    """Video ids of playlist pages held as JSON text; a page may have no items."""
    keep = [name for name in pages.columns if name != text]
    parsed = pages.withColumn("parsed", parse_json(F.col(text), schemas.PLAYLIST_PAGE))
    return parsed.select(*keep, F.explode("parsed.items").alias("item")).select(
        *keep, F.col("item.contentDetails.videoId").alias("video_id")
    )


def one_landing(
    landed: DataFrame, key: str = "video_id", order: str = "extraction_date", keep: str = "first", near: Sequence[str] = ()
) -> DataFrame:
    """One row per ``key``: that of the first or the last day, ties by the other columns.

    Whole rows are shuffled once. Spark cuts every task's rows to one per key
    before that shuffle, so a key with very many rows sends one from each task.
    Text that is no date counts as a day before all others. Rows without a key
    are not copies of each other and all stay.

    ``near`` may name columns that follow from the key; rows that lie together
    by them are not shuffled again, and the cut comes after that shuffle.
    """
    columns = [key, order, *[name for name in landed.columns if name not in (key, order)]]
    day = F.coalesce(F.unix_date(F.col(order).try_cast("date")), F.lit(-(2**31)))
    alone = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    ordered = [F.col(name).asc() if keep == "first" else F.col(name).desc() for name in ("_day", *columns[1:])]
    first = F.row_number().over(Window.partitionBy(*near, key, "_alone").orderBy(*ordered))
    places = landed.withColumns({"_day": day, "_alone": alone}).withColumn("_place", first)
    return places.filter("_place = 1").select(*columns)


def harvest_counts(found: DataFrame, details: DataFrame) -> DataFrame:
    """One row: channels, ids found, rows with details, distinct ids, last date.

    ``found`` has channel_id and video_id, ``details`` has video_id and
    extraction_date.
    """
    per_id = details.groupBy("video_id").agg(
        F.count(F.lit(1)).alias("copies"), F.max(F.to_date("extraction_date")).alias("last_date")
    )
    detail_row = per_id.agg(
        F.sum("copies").alias("videos_with_details"),
        F.count(F.lit(1)).alias("processed_video_ids"),
        F.date_format(F.max("last_date"), "yyyy-MM-dd").alias("extraction_date"),
    )
    channel_row = (
        found.groupBy("channel_id")
        .agg(F.count(F.lit(1)).alias("ids"))
        .agg(F.count(F.lit(1)).alias("channels_processed"), F.sum("ids").alias("total_videos_found"))
    )
    counts = channel_row.unionByName(detail_row, allowMissingColumns=True)
    return counts.agg(*[F.max(name).alias(name) for name in counts.columns])
