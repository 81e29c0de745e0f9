"""Queries over the catalogue derived from the test tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oracle import catalogue, sql
from reelgauge import schemas
from reelgauge.functions.columns import log10_views
from reelgauge.operators import (
    channels,
    compare,
    cube,
    duration,
    measures,
    overview,
    recommend,
    records,
    season,
    sketches,
    titles,
    weekday,
)
from reelgauge.operators.grouped import displayed
from reelgauge.plans import increment, niches
from reelgauge.plans.bronze import bronze_channels, bronze_videos, usable, video_rejects
from reelgauge.plans.silver import silver_videos
from reelgauge.session import configure, fresh_path, move
from reelgauge.sources import drift, harvest, readers, sinks
from reelgauge.sources import pages as pages_
from reelgauge.streaming import daily

Query = Callable[[SparkSession, str], DataFrame]

try:
    from reelgauge.llm import queries as llm
except ModuleNotFoundError as error:
    # Only the absence of the subpackage or the pipeline itself is fine.
    if not (error.name or "").startswith(("reelgauge.llm", "corpus_pipeline")):
        raise
    llm = None


def _plain(df: DataFrame) -> DataFrame:
    """Doubles rounded to 6 places, instants without a zone: comparable anywhere."""
    shown = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DoubleType):
            column = F.round(column, 6)
        elif isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        shown.append(column.alias(field.name))
    return df.select(*shown)


def _analysis(function: Callable[..., DataFrame], *args, **options) -> Query:
    return lambda spark, sf: _plain(function(catalogue.view(spark, sf), *args, **options))


def _bronze_channels(spark: SparkSession, sf: str) -> DataFrame:
    text = catalogue.raw_channel_text(spark, sf)
    raw = text.select(F.inline(F.array(readers.parse_json(F.col("value"), schemas.RAW_CHANNEL))))
    return _plain(bronze_channels(raw))


def _bronze_videos(spark: SparkSession, sf: str) -> DataFrame:
    text = catalogue.raw_video_text(spark, sf)
    raw = text.select(F.inline(F.array(readers.parse_json(F.col("value"), schemas.RAW_VIDEO))))
    return _plain(bronze_videos(raw))


def _landed(spark: SparkSession, text: DataFrame) -> str:
    """JSON lines landed as files."""
    path = fresh_path(spark, "raw")
    text.select("value").write.text(path)
    return path


def _json_scan_channels(spark: SparkSession, sf: str) -> DataFrame:
    path = _landed(spark, catalogue.raw_channel_text(spark, sf))
    return _plain(bronze_channels(readers.read_json(spark, path, schemas.RAW_CHANNEL)))


def _json_scan_videos(spark: SparkSession, sf: str) -> DataFrame:
    path = _landed(spark, catalogue.raw_video_text(spark, sf))
    return _plain(bronze_videos(usable(readers.read_json_checked(spark, path, schemas.RAW_VIDEO))))


def _rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Landed lines, some of them cut off, without id, or with unreadable times."""
    path = _landed(spark, catalogue.damaged_video_text(spark, sf))
    checked = readers.read_json_checked(spark, path, schemas.RAW_VIDEO)
    return video_rejects(checked).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def _csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    rows = catalogue.silver(spark, sf).select("video_id", "channel_name", "view_count", "extraction_date")
    path = fresh_path(spark, "csv")
    sinks.save(rows, path, "csv")
    return spark.read.schema(rows.schema).option("header", True).csv(path)


def _landing_dates(spark: SparkSession, sf: str) -> DataFrame:
    rows = catalogue.silver(spark, sf).withColumnRenamed("extraction_date", "seen")
    path = fresh_path(spark, "landing")
    sinks.land_json(rows.select("video_id", "seen"), path, F.to_date("seen"))
    landed = spark.read.schema("video_id string, seen string, extraction_date string").json(path)
    return landed.groupBy("extraction_date").agg(F.count("video_id").alias("n"))


def _silver_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    """A table written twice, the second time with fewer years."""
    rows, path = catalogue.silver(spark, sf), fresh_path(spark, "rebuild")
    sinks.save_table(rows, path, ["ano"], ["channel_id"])
    sinks.save_table(rows.filter("ano > 1995"), path, ["ano"], ["channel_id"])
    again = readers.read_parquet(spark, path, schemas.SILVER_VIDEO)
    return again.groupBy("ano").agg(F.count("video_id").alias("n"))


def _bronze_increment(spark: SparkSession, sf: str) -> DataFrame:
    """Two landings taken one after the other; a third of the videos is in both, with more views in the second."""
    configure(spark)
    key = F.regexp_extract("value", '"id":"v([0-9]+)"', 1).cast("bigint")
    undated = F.regexp_replace("value", ',"extraction_date":"[^"]*"', "")
    text = catalogue.raw_video_text(spark, sf).select(undated.alias("value"), (key % 3).alias("third"))
    more = F.regexp_replace("value", '"viewCount":"', '"viewCount":"1')
    landings = F.array_compact(F.array(
        F.when(F.col("third") != 0, F.struct(F.lit("2024-02-01").alias("day"), "value")),
        F.when(F.col("third") != 1, F.struct(F.lit("2024-02-02").alias("day"), more.alias("value"))),
    ))
    staged, raw = fresh_path(spark, "increment-staged"), fresh_path(spark, "increment-raw")
    layers = increment.Layers(raw, *(fresh_path(spark, f"increment-{x}") for x in ("bronze", "silver", "ledger")))
    text.select(F.inline(landings)).write.partitionBy("day").text(staged, compression="gzip")
    for day in ("2024-02-01", "2024-02-02"):
        move(spark, f"{staged}/day={day}", f"{raw}/extraction_date={day}")
        increment.run_increment(spark, layers)
    rows = increment.silver(spark, layers)
    return _plain(rows.select("video_id", "title", "duration", "ano", "view_count", "engagement_rate", "extraction_date"))


def _id_batches_global(spark: SparkSession, sf: str) -> DataFrame:
    batches = harvest.id_batches_global(catalogue.silver(spark, sf))
    return batches.withColumn("ids", F.array_join("ids", ","))


def _silver_videos(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(catalogue.silver(spark, sf))


def _suggestions_append(spark: SparkSession, sf: str) -> DataFrame:
    configure(spark)
    names = catalogue.table(spark, sf, "customer").select(
        F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_name")).alias("channel_name"),
        F.col("c_mktsegment").alias("dashboard"),
        (F.col("c_acctbal") < 5000).alias("early"),
    )
    log = fresh_path(spark, "suggestions")
    sinks.append_suggestions(names.filter("early"), log)
    sinks.append_suggestions(names.filter("NOT early"), log)
    return sinks.read_suggestions(spark, log)


def _id_batches(spark: SparkSession, sf: str) -> DataFrame:
    batches = harvest.id_batches(catalogue.silver(spark, sf))
    return batches.withColumn("ids", F.array_join("ids", ","))


def _dedupe_videos(spark: SparkSession, sf: str) -> DataFrame:
    return harvest.one_landing(catalogue.landings(spark, sf))


def _harvest_stats(spark: SparkSession, sf: str) -> DataFrame:
    found = catalogue.landings(spark, sf)
    details = found.join(catalogue.silver(spark, sf).select("video_id"), "video_id", "left_semi")
    return harvest.harvest_counts(found, details)


def _explode_items(spark: SparkSession, sf: str) -> DataFrame:
    """Playlist pages built from the id batches; the page after the last is empty."""
    batches = harvest.id_batches(catalogue.silver(spark, sf))
    item = F.transform(
        "ids", lambda video: F.struct(F.struct(video.alias("videoId")).alias("contentDetails"))
    )
    full = F.to_json(F.struct(item.alias("items"), F.col("batch_no").cast("string").alias("nextPageToken")))
    last = F.when(F.col("batch_no") == 0, '{"kind": "empty"}')
    pages = batches.select("channel_id", F.explode(F.array_compact(F.array(full, last))).alias("page"))
    return harvest.page_ids(pages)


def _page_chains(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of five ids a channel, shuffled: some repeated, some missing, some channels running in a circle."""
    batches = harvest.id_batches(catalogue.silver(spark, sf), size=5)
    number, circle = F.col("batch_no"), F.substring("channel_id", 2, 9).cast("int") % 5 == 0
    last = number == F.max("batch_no").over(Window.partitionBy("channel_id"))

    def token(place) -> Column:
        return F.when(place > 0, F.md5(F.concat_ws("-", "channel_id", place.cast("string"))))

    following = F.when(last & circle, token(F.lit(1))).when(~last, token(number + 1))
    pages = batches.select(
        F.col("channel_id").alias("playlist"),
        token(number).alias("token"),
        F.to_json(F.struct(following.alias("nextPageToken"))).alias("page"),
        F.explode(F.sequence(F.lit(1), F.when(number % 4 == 0, 2).otherwise(1))).alias("copy"),
    ).filter(number % 11 != 7)
    return pages_.chains(pages_.next_tokens(pages.repartition(F.col("token"))))


def _niche_videos(spark: SparkSession, sf: str) -> DataFrame:
    """Every niche's videos, with a bridge that repeats pairs and shares channels."""
    bridge = catalogue.bridge(spark, sf)
    shared = bridge.filter(F.col("channel_id").endswith("7")).withColumn("niche", F.lit("ASIA"))
    repeated = bridge.unionByName(bridge).unionByName(shared)
    return niches.with_niche(catalogue.silver(spark, sf), repeated).select(
        "niche", "video_id", "channel_id"
    )


def _niche_filter(spark: SparkSession, sf: str) -> DataFrame:
    videos = niches.videos_of_niche(
        catalogue.silver(spark, sf), "EUROPE", catalogue.bridge(spark, sf)
    )
    return videos.select("video_id", "channel_id", "view_count")


def _guards(spark: SparkSession, sf: str) -> DataFrame:
    """What refuses to be written or read: the outcome, and the rows the table holds afterwards."""
    configure(spark)
    rows, path = catalogue.silver(spark, sf).select("video_id", "view_count"), fresh_path(spark, "guards")

    def refused(action: Callable[[], object]) -> str:
        try:
            return "done" if action() else "not written"
        except ValueError as error:
            return str(error).split(";")[0]

    steps = {
        "written": lambda: sinks.save(rows, path),
        "empty frame": lambda: sinks.save(rows.filter("view_count < 0"), path),
        "unknown format": lambda: sinks.save(rows, path, "xlsx"),
        "missing columns": lambda: silver_videos(rows),
        "no path": lambda: readers.read_parquet(spark, " ", rows.schema),
    }
    found = []
    for guard, action in steps.items():
        outcome = refused(action)
        held = spark.read.parquet(path).agg(F.lit(guard).alias("guard"), F.lit(outcome).alias("outcome"), F.count("*").alias("n"))
        found.append(held)
    return reduce(DataFrame.unionByName, found)


def _title_length_display(spark: SparkSession, sf: str) -> DataFrame:
    shown = {"avg_views": 0, "avg_likes": 2, "avg_engagement": 2}
    return displayed(titles.length_performance(catalogue.view(spark, sf)), shown)


def _keyword_many(spark: SparkSession, sf: str) -> DataFrame:
    """The 1,000 most frequent words of popular titles, all against every title of every niche."""
    view = catalogue.view(spark, sf)
    counts = titles.frequent_words(titles.popular_words(view), (), 1000)
    words = [row["word"] for row in counts.orderBy(F.desc("n"), "word").limit(1000).collect()]
    return _plain(titles.keyword_impact(view, words=words))


def _log_views_box(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(compare.box(catalogue.view(spark, sf), value=log10_views(F.col("view_count"))))


SPANS = [("1995", (1995, 1), (1995, 12)), ("winter", (1996, 11), (1997, 2)), ("all", (1900, 1), (2100, 12))]


def _quantiles_by_span(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(sketches.quantiles_by_span(catalogue.view(spark, sf), SPANS, (0.1, 0.5, 0.75, 0.99)))


def _shared_channels(spark: SparkSession, sf: str) -> DataFrame:
    """Niches that share every channel whose id ends with 7, as a bridge may."""
    members = catalogue.bridge(spark, sf)
    shared = members.filter(F.col("channel_id").endswith("7")).withColumn("niche", F.lit("ASIA"))
    view = niches.with_niche(catalogue.silver(spark, sf), members.unionByName(shared))
    names = sorted(row["r_name"] for row in catalogue.table(spark, sf, "region").select("r_name").collect())
    return sketches.shared_channels(sketches.channel_sketches(view), list(combinations(names, 2)))


def _drifted_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Three loads of the videos: as wanted, with narrow views and without likes, with views as text and a further column."""
    rows = catalogue.silver(spark, sf).select("video_id", "view_count", "like_count", "ano")
    loads = [
        rows.filter("ano < 1994").drop("ano"),
        rows.filter("ano BETWEEN 1994 AND 1995").select("video_id", F.col("view_count").cast("int").alias("view_count")),
        rows.filter("ano > 1995").withColumn(
            "view_count", F.when(F.col("ano") == 1997, "unknown").otherwise(F.col("view_count").cast("string"))
        ),
    ]
    folders = [fresh_path(spark, "load") for _ in loads]
    for load, folder in zip(loads, folders, strict=True):
        load.write.parquet(folder)
    return drift.reconciled_scan(spark, folders, rows.drop("ano").schema)[0]


def _gold_cube(spark: SparkSession, sf: str) -> DataFrame:
    """Cells of the view merged to years and length classes."""
    cells = cube.of(catalogue.view(spark, sf))
    n, r = measures.correlation(cells, "title_length", "view_count")
    merged = cells.groupBy("niche", "ano", "length_class").agg(
        measures.rows(cells).alias("n_videos"),
        measures.total(cells, "view_count").alias("total_views"),
        measures.highest(cells, "view_count").alias("max_views"),
        *measures.sample(cells, "view_count", "views"),
        *measures.sample(cells, "engagement_rate", "rate"),
        n.alias("n_pairs"),
        r.alias("r_title_views"),
    )
    spread = {f"sd_{name}": F.sqrt(f"var_{name}") for name in ("views", "rate")}
    return _plain(merged.withColumns(spread).drop("var_views", "var_rate"))


def _length_class(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(catalogue.view(spark, sf).select("niche", "video_id", "duration", "length_class"))


def _stream_daily(spark: SparkSession, sf: str) -> DataFrame:
    """The events as many files in hashed order, a file a trigger."""
    configure(spark)
    landed, counts = fresh_path(spark, "events"), fresh_path(spark, "daily")
    events = catalogue.table(spark, sf, "events")
    events.repartition(6, F.xxhash64("event_id")).write.parquet(landed)
    query = daily.start_daily(
        daily.event_stream(spark, landed, "*.parquet", files=1),
        counts,
        fresh_path(spark, "daily-checkpoint"),
        key="event_id",
        day=F.col("ts"),
        amount=F.col("value"),
    )
    query.awaitTermination()
    return _plain(daily.daily_totals(spark, counts))


def entry(spark: SparkSession) -> DataFrame:
    """Monthly publishing and views of every niche, long and short."""
    return queries()["overview_monthly"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return {**own_queries(), **(llm.QUERIES if llm else {})}


def oracle_sql() -> dict[str, str]:
    return {**sql.all_queries(), **(llm.ORACLE if llm else {})}


def own_queries() -> dict[str, Query]:
    """All but the operators of ``reelgauge.llm``."""
    return {
        "bronze_channels": _bronze_channels,
        "bronze_videos": _bronze_videos,
        "silver_videos": _silver_videos,
        "json_scan_channels": _json_scan_channels,
        "json_scan_videos": _json_scan_videos,
        "rejects": _rejects,
        "csv_round_trip": _csv_round_trip,
        "landing_dates": _landing_dates,
        "silver_rebuild": _silver_rebuild,
        "suggestions_append": _suggestions_append,
        "bronze_increment": _bronze_increment,
        "id_batches": _id_batches,
        "id_batches_global": _id_batches_global,
        "dedupe_videos": _dedupe_videos,
        "harvest_stats": _harvest_stats,
        "explode_items": _explode_items,
        "page_chains": _page_chains,
        "niche_videos": _niche_videos,
        "niche_filter": _niche_filter,
        "length_class": _length_class,
        "gold_cube": _gold_cube,
        "drifted_scan": _drifted_scan,
        "guards": _guards,
        "quantiles_by_span": _quantiles_by_span,
        "shared_channels": _shared_channels,
        "title_length_display": _title_length_display,
        "keyword_many": _keyword_many,
        "log_views_box": _log_views_box,
        "overview_totals": _analysis(overview.totals),
        "overview_monthly": _analysis(overview.monthly),
        "overview_chosen": _analysis(overview.monthly, channels=catalogue.CHOSEN),
        "channel_list": _analysis(overview.channel_list),
        "channel_month_compare": _analysis(channels.month_compare, catalogue.YEARS),
        "channel_year_join": _analysis(channels.year_compare_by_join, catalogue.YEARS),
        "records": _analysis(records.catalogue_records),
        "weekday_stats": _analysis(weekday.stats),
        "weekday_popularity": _analysis(weekday.popularity),
        "weekday_best_worst": _analysis(weekday.best_worst),
        "weekday_anova": _analysis(weekday.anova),
        "monthly_seasonality": _analysis(season.monthly),
        "monthly_trend": _analysis(season.trend),
        "long_short_stats": _analysis(compare.stats),
        "long_short_compare": _analysis(compare.metric_table),
        "long_short_ratio": _analysis(compare.ratio),
        "welch_long_short": _analysis(compare.welch),
        "views_box": _analysis(compare.box),
        "views_outliers": _analysis(compare.outliers),
        "rate_outliers": _analysis(compare.outliers, value="engagement_rate"),
        "views_density": _analysis(compare.density),
        "title_length_mean": _analysis(titles.length_mean),
        "title_length_perf": _analysis(titles.length_performance),
        "title_length_best": _analysis(titles.length_best),
        "title_length_corr": _analysis(titles.length_correlation),
        "top_words": _analysis(titles.top_words),
        "word_weights": _analysis(titles.word_weights),
        "keyword_impact": _analysis(titles.keyword_impact),
        "emoji_impact": _analysis(titles.emoji_impact),
        "duration_corr": _analysis(duration.correlation),
        "view_quantiles": _analysis(duration.view_quantiles),
        "duration_scatter": _analysis(duration.scatter),
        "duration_fit": _analysis(duration.fit),
        "recommendations": _analysis(recommend.recommendations),
        "stream_daily": _stream_daily,
    }
