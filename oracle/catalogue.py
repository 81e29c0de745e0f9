"""A video catalogue derived from the test tables.

One order is one video, nation is the channel, region the niche, and the and the
lines of a document are shared out as titles. ``FIXTURES.md`` has the rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgauge import schemas
from reelgauge.plans.niches import niche_view
from reelgauge.plans.silver import silver_videos
from reelgauge.session import configure, fresh_path
from reelgauge.sources.readers import read_parquet
from reelgauge.sources.sinks import save_table

CUTS = {"EUROPE": 3600}
YEARS = [1998, 1999, 2000]
CHOSEN = ["FRANCE", "CHINA", "KENYA"]

_BUILT: dict[tuple[str, str], tuple[str, str]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("r_name").alias("niche"), F.concat(F.lit("c"), "n_nationkey").alias("channel_id")
    )


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows."""
    configure(spark)
    orders, customer, nation, documents = (
        table(spark, sf_dir, name) for name in ("orders", "customer", "nation", "documents")
    )
    key = F.col("o_orderkey")
    lines = documents.select("doc_id", F.split("text", "\n").alias("lines"))
    n_documents, n_orders = documents.count(), orders.count()
    # The orders of a document share out its lines: every line is in a title.
    per_document = max(1, n_orders // n_documents)
    mine = F.floor(key / n_documents).cast("bigint") % per_document
    title = F.array_join(F.filter("lines", lambda _, i: i % per_document == mine), " ")
    seconds = key * 37 % 7200
    likes, comments = key * 7919 % 5000, key * 104729 % 700
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumn("doc_id", key % n_documents)
        .join(lines, "doc_id")
        .select(
            F.concat(F.lit("v"), key).alias("video_id"),
            F.concat(title, F.when(key % 7 == 0, " 😀").otherwise("")).alias("title"),
            F.concat(F.lit("c"), "n_nationkey").alias("channel_id"),
            F.col("n_name").alias("channel_name"),
            (F.col("o_orderdate") + F.make_dt_interval(hours=(key % 24).cast("int")))
            .cast("timestamp")
            .alias("published_at"),
            F.when(
                key % 101 != 0,
                F.concat(F.lit("PT"), F.floor(seconds / 60), F.lit("M"), seconds % 60, F.lit("S")),
            ).alias("duration"),
            F.when(key % 3 == 0, "sd").otherwise("hd").alias("definition"),
            F.when(key % 50 == 0, 0)
            .when(key % 97 == 0, F.floor("o_totalprice") * 100)
            .otherwise(F.floor("o_totalprice"))
            .cast("bigint")
            .alias("view_count"),
            likes.alias("like_count"),
            comments.alias("comment_count"),
            F.concat(F.lit("https://img.example/v"), key, F.lit(".jpg")).alias("thumbnail_url"),
            F.concat(F.lit("2024-01-"), F.lpad((1 + key % 28).cast("string"), 2, "0")).alias(
                "extraction_date"
            ),
            (likes == 0).alias("like_count_missing"),
            (comments == 0).alias("comment_count_missing"),
        )
    )


def raw_video_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze rows as landed JSON objects; a count of 0 has no key."""
    def count(name: str):
        return F.when(F.col(name) != 0, F.col(name).cast("string"))

    body = F.struct(
        F.col("video_id").alias("id"),
        F.struct(
            "title",
            F.col("channel_id").alias("channelId"),
            F.col("channel_name").alias("channelTitle"),
            F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"),
            F.struct(F.struct(F.col("thumbnail_url").alias("url")).alias("high")).alias("thumbnails"),
        ).alias("snippet"),
        F.struct("duration", "definition").alias("contentDetails"),
        F.struct(
            F.col("view_count").cast("string").alias("viewCount"),
            count("like_count").alias("likeCount"),
            count("comment_count").alias("commentCount"),
        ).alias("statistics"),
        "extraction_date",
    )
    return videos(spark, sf_dir).select(F.to_json(body).alias("value"))


def damaged_video_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed videos with a few lines cut off, without id or with unreadable times."""
    value, key = F.col("value"), F.col("key")
    text = raw_video_text(spark, sf_dir).withColumn("key", F.regexp_extract("value", '"id":"v([0-9]+)"', 1).cast("bigint"))
    return text.select(
        F.when(key % 211 == 0, F.substring(value, 1, 20))
        .when(key % 223 == 0, F.regexp_replace(value, '"id":"v[0-9]+",', ""))
        .when(key % 227 == 0, F.regexp_replace(value, '"duration":"[^"]*"', '"duration":"soon"'))
        .when(key % 229 == 0, F.regexp_replace(value, '"publishedAt":"[^"]*"', '"publishedAt":"never"'))
        .otherwise(value)
        .alias("value")
    )


def raw_channel_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channels as landed JSON objects, some with missing or unreadable counts."""
    totals = (
        videos(spark, sf_dir)
        .groupBy("channel_id")
        .agg(F.sum("view_count").alias("views"), F.count(F.lit(1)).alias("n"))
    )
    number = F.col("n_nationkey")
    channels = table(spark, sf_dir, "nation").withColumn(
        "channel_id", F.concat(F.lit("c"), "n_nationkey")
    )
    body = F.struct(
        F.col("channel_id").alias("id"),
        F.struct(
            F.col("n_name").alias("title"),
            F.concat(F.lit("@"), F.lower("n_name")).alias("customUrl"),
            F.concat(
                F.lit("20"), F.lpad((number % 20).cast("string"), 2, "0"), F.lit("-03-15T10:20:30Z")
            ).alias("publishedAt"),
            F.when(number % 3 != 0, F.substring("n_name", 1, 2)).alias("country"),
        ).alias("snippet"),
        F.struct(
            F.col("views").cast("string").alias("viewCount"),
            F.when(number % 7 == 0, "hidden")
            .when(number % 5 != 0, (number * 1000).cast("string"))
            .alias("subscriberCount"),
            F.col("n").cast("string").alias("videoCount"),
        ).alias("statistics"),
        F.struct(
            F.struct(F.concat(F.lit("UU"), number).alias("uploads")).alias("relatedPlaylists")
        ).alias("contentDetails"),
    )
    return channels.join(totals, "channel_id").select(F.to_json(body).alias("value"))


def landings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A video found once per order line, on the day the line was shipped."""
    configure(spark)
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("v"), "l_orderkey").alias("video_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("extraction_date"),
        F.concat(F.lit("c"), "l_suppkey").alias("channel_id"),
        F.floor("l_extendedprice").cast("bigint").alias("view_count"),
    )


def _built(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Paths of silver and bridge, written once per application and folder."""
    key = (spark.conf.get("spark.app.id", ""), sf_dir)
    configure(spark)
    if key not in _BUILT:
        paths = fresh_path(spark, "silver"), fresh_path(spark, "bridge")
        # The join by document has dealt the titles evenly.
        save_table(silver_videos(videos(spark, sf_dir)), paths[0], ["ano"], ["channel_id"], rebalance=False)
        bridge(spark, sf_dir).write.parquet(paths[1])
        _BUILT[key] = paths
    return _BUILT[key]


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, _built(spark, sf_dir)[0], schemas.SILVER_VIDEO)


def view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every analysis takes: silver with niche and length class."""
    members = read_parquet(spark, _built(spark, sf_dir)[1], schemas.NICHE_BRIDGE)
    return niche_view(silver(spark, sf_dir), members, CUTS)
