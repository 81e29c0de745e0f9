"""Titles: length, words, keywords and emoji against performance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelgauge import fixed_values as fixed
from reelgauge.functions import text as X
from reelgauge.operators import measures as M
from reelgauge.operators.grouped import NICHE, By, best, join_groups, within
from reelgauge.operators.quantiles import quantiles
from reelgauge.operators.significance import with_pearson, with_welch
from reelgauge.session import settle

#: Hash cells words are counted in before any word is.
WORD_CELLS = 1 << 16
AVERAGES = {"avg_views": "view_count", "avg_likes": "like_count", "avg_engagement": "engagement_rate"}


def _averages(videos: DataFrame, when: Column | None = None, suffix: str = "") -> list[Column]:
    return [M.average(videos, column, when).alias(f"{name}{suffix}") for name, column in AVERAGES.items()]


def _measured(videos: DataFrame) -> DataFrame:
    """Length and class of the title, unless the frame has them: a narrow view, or cells."""
    if M.are_cells(videos) or "title_length" in videos.columns:
        return videos
    length = X.title_length(F.col("title"))
    return videos.withColumns({"title_length": length, "bin_no": X.length_bin(length)})


def length_mean(videos: DataFrame, by: By = NICHE) -> DataFrame:
    lengths = _measured(videos)
    return lengths.groupBy(*by).agg(M.average(lengths, "title_length").alias("avg_title_length"))


def length_performance(videos: DataFrame, by: By = NICHE) -> DataFrame:
    """Averages per title length class; a class without videos stays with count 0.

    The classes of a group, eight at most, are gathered into one row and looked
    up from there, so the table is read once.
    """
    found = (
        _measured(videos)
        .groupBy(*by, "bin_no")
        .agg(*_averages(videos), M.count(videos, "video_id").alias("count"))
    )
    gathered = found.groupBy(*by).agg(
        F.collect_list(F.struct("bin_no", *AVERAGES, "count")).alias("classes")
    )
    mine = F.get(F.filter("classes", lambda c: c["bin_no"] == F.col("bin_no")), F.lit(0))
    return (
        gathered.select(*by, F.inline(X.length_bins()), "classes")
        .withColumn("mine", mine)
        .select(
            *by,
            "bin_no",
            "label",
            *[F.col(f"mine.{name}").alias(name) for name in AVERAGES],
            F.coalesce("mine.count", F.lit(0)).alias("count"),
        )
    )


def length_best(videos: DataFrame, by: By = NICHE) -> DataFrame:
    """The class with the best average views and the best average engagement."""
    return (
        length_performance(videos, by)
        .withColumn("bin", F.struct("bin_no", "label"))
        .groupBy(*by)
        .agg(best("avg_views", "bin").alias("views"), best("avg_engagement", "bin").alias("engagement"))
        .select(
            *by,
            F.col("views.bin.label").alias("best_views_length"),
            F.col("views.avg_views").alias("best_avg_views"),
            F.col("engagement.bin.label").alias("best_engagement_length"),
            F.col("engagement.avg_engagement").alias("best_avg_engagement"),
        )
    )


def length_correlation(videos: DataFrame, by: By = NICHE) -> DataFrame:
    """Pearson r of title length with views and with engagement."""
    lengths = _measured(videos)
    targets = {"views": "view_count", "engagement": "engagement_rate"}
    parts = []
    for name, column in targets.items():
        n, r = M.correlation(lengths, "title_length", column)
        parts += [r.alias(f"r_{name}"), n.alias(f"n_{name}")]
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("target"), F.col(f"n_{name}").alias("n"), F.col(f"r_{name}").alias("r")
        )
        for name in targets
    ])
    return with_pearson(lengths.groupBy(*by).agg(*parts).select(*by, F.inline(rows)))


def popular(
    videos: DataFrame, by: By = NICHE, quantile: float = fixed.POPULAR_QUANTILE, limits: DataFrame | None = None
) -> DataFrame:
    """Videos at or above the views quantile of their group.

    ``limits`` may hold settled ``duration.view_quantiles``, whose limit then counts.
    """
    if limits is None:
        limits = settle(quantiles(videos, by, {"view_threshold": (F.col("view_count"), quantile)}), "popular")
    else:
        limits = limits.select(*by, F.col("popular_views").alias("view_threshold"))
    return join_groups(videos, limits, by).filter(F.col("view_count") >= F.col("view_threshold"))


def popular_words(videos: DataFrame, by: By = NICHE, limits: DataFrame | None = None) -> DataFrame:
    """A row for every word in the titles of popular videos."""
    return popular(videos, by, limits=limits).select(*by, F.explode(X.words(F.col("title"))).alias("word"))


def _counted(words: DataFrame, by: By) -> DataFrame:
    return words.groupBy(*by, "word").agg(F.count(F.lit(1)).alias("n"))


def word_counts(videos: DataFrame, by: By = NICHE, limits: DataFrame | None = None) -> DataFrame:
    """How often each word occurs in the titles of popular videos."""
    return _counted(popular_words(videos, by, limits), by)


def frequent_words(words: DataFrame, by: By, limit: int, cells: int = WORD_CELLS, tried: int = 4) -> DataFrame:
    """Settled exact counts of some words of each group, among them the ``limit`` most frequent, ties included.

    Words are first counted together in cells of their hash, so what is shuffled
    has a bound however many words there are. No word occurs more often than its
    cell. The words of the fullest cells, ``tried`` for each wanted word, are
    counted by themselves; the ``limit``-th of their counts is one the wanted
    words reach, so of the other cells only those that reach it are counted too.
    """
    hashed = words.withColumn("cell", F.pmod(F.xxhash64("word"), F.lit(cells)).cast("int"))
    sums = settle(hashed.groupBy(*by, "cell").agg(F.count(F.lit(1)).alias("held")), "word-cells")
    fullest = Window.partitionBy(*by).orderBy(F.desc("held"), "cell")
    first = settle(sums.withColumn("place", F.row_number().over(fullest)).filter(F.col("place") <= tried * limit), "full-cells")

    def within_cells(chosen: DataFrame) -> DataFrame:
        return _counted(hashed.join(chosen.select(*by, "cell"), [*by, "cell"], "left_semi"), by)

    counts = settle(within_cells(first), "frequent-words")
    ranked = counts.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n"))))
    reached = settle(ranked.filter(F.col("place") == limit).select(*by, F.col("n").alias("reached")), "reached")
    others = sums.join(first, [*by, "cell"], "left_anti")
    known = others.join(reached, list(by), "left") if by else others.join(reached, F.lit(True), "left")
    rest = settle(known.filter(F.col("held") >= F.coalesce("reached", F.lit(0))).select(*by, "cell"), "other-cells")
    return counts if rest.isEmpty() else counts.unionByName(settle(within_cells(rest), "frequent-words"))


def top_words(
    videos: DataFrame, by: By = NICHE, limit: int = fixed.TOP_WORDS, counts: DataFrame | None = None
) -> DataFrame:
    """The most frequent words; equal counts in word order.

    Spark cuts every task's rows to ``limit`` per group before the shuffle.
    ``counts`` may hold settled ``word_counts``, here and below, so that several
    analyses share them; without them only frequent words are counted one by one.
    """
    counts = frequent_words(popular_words(videos, by), by, limit) if counts is None else counts
    ordered = Window.partitionBy(*by).orderBy(F.desc("n"), "word")
    return counts.withColumn("rank", F.row_number().over(ordered)).filter(F.col("rank") <= limit)


def word_weights(videos: DataFrame, by: By = NICHE, counts: DataFrame | None = None) -> DataFrame:
    """Every word with its frequency relative to the most frequent one."""
    counts = settle(word_counts(videos, by), "word-counts") if counts is None else counts
    highest = counts.groupBy(*by).agg(F.max("n").alias("highest"))
    return (
        join_groups(counts, settle(highest, "word-highest"), by)
        .withColumn("weight", F.col("n") / F.col("highest"))
        .drop("highest")
    )


def _indexed(videos: DataFrame, words: list[str]) -> DataFrame:
    """A row for each video and keyword (a struct of rank and word) its title holds, and one of rank 0.

    An inverted index lists every word under its rarest run of three
    characters. A title looks up its own runs there and tests only the words
    it finds, each under one run, so nothing is found twice. Words without such
    a run are tested one by one. The index is broadcast at any size, as the
    driver holds the words anyway: a shuffle would write every title once for
    each of its runs.
    """
    ranked = [(rank, word.lower()) for rank, word in enumerate(words, 1)]
    grams = X.rarest_grams([word for _, word in ranked])
    listed = [(grams[word], rank, word) for rank, word in ranked if word in grams]
    index = videos.sparkSession.createDataFrame(listed, "gram string, rank int, word string")
    rest = [(0, ""), *((rank, word) for rank, word in ranked if word not in grams)]
    lowered = videos.withColumn("lowered", F.lower("title")).drop("title")
    looked_up = (
        lowered.withColumn("gram", F.explode(X.grams(F.col("lowered"))))
        .join(F.broadcast(index), "gram")
        .filter(F.contains(F.col("lowered"), F.col("word")))
        .withColumn("keyword", F.struct("rank", "word"))
        .drop("gram", "rank", "word", "lowered")
    )
    each = F.array(*[F.struct(F.lit(rank).alias("rank"), F.lit(word).alias("word")) for rank, word in rest])
    held = F.filter(each, lambda keyword: (keyword["rank"] == 0) | F.contains(F.col("lowered"), keyword["word"]))
    return looked_up.unionByName(lowered.withColumn("keyword", F.explode(held)).drop("lowered"))


def _settled_top_words(videos: DataFrame, by: By, limit: int, counts: DataFrame | None) -> DataFrame:
    """The top words of a group as one array of at most ``limit`` structs."""
    listed = F.sort_array(F.collect_list(F.struct("rank", "word"))).alias("keywords")
    return settle(top_words(videos, by, limit, counts).groupBy(*by).agg(listed), "keywords")


def keyword_impact(
    videos: DataFrame,
    by: By = NICHE,
    limit: int = fixed.TOP_WORDS,
    words: list[str] | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Videos with and without a keyword in the title, and Welch's t on views.

    One row per keyword that occurs: the chosen ``words``, or else the top ones.
    A video counts once for the whole group (rank 0) and once for each keyword
    its title holds. What lacks a keyword is the whole minus what holds it, so
    no title is paired with all keywords. Chosen words are found through
    ``_indexed``, however many they are.
    """
    narrow = videos.select(*by, "title", "view_count", "like_count", "engagement_rate")
    if words is None:
        whole = F.array(F.struct(F.lit(0).alias("rank"), F.lit("").alias("word")))
        offered = join_groups(narrow, _settled_top_words(videos, by, limit, counts), by)
        held = F.concat(whole, X.held_keywords(F.col("title"), F.col("keywords")))
        found = offered.withColumn("keyword", F.explode(held))
    else:
        found = _indexed(narrow, words)
    measured = {"views": "view_count", "likes": "like_count", "engagement": "engagement_rate"}
    sums = {
        "videos": F.count(F.lit(1)),
        **{f"n_{metric}": F.count(column) for metric, column in measured.items()},
        # A keyword whose videos have no rate at all takes nothing from the whole.
        **{f"sum_{metric}": F.coalesce(F.sum(column), F.lit(0)) for metric, column in measured.items()},
        # Views are whole numbers: decimals keep the squares exact, so that what
        # lacks a keyword is exact too, however few videos that are.
        "squares": F.coalesce(
            F.sum(F.col("view_count").cast("decimal(19,0)") * F.col("view_count").cast("decimal(19,0)")), F.lit(0)
        ),
    }
    counted = (
        found.groupBy(*by, "keyword")
        .agg(*[value.alias(f"{name}_with") for name, value in sums.items()])
    )
    is_whole = F.col("keyword.rank") == 0
    both = counted.select(
        "*",
        *[
            F.max(F.when(is_whole, F.col(f"{name}_with"))).over(within(by)).alias(f"{name}_all")
            for name in sums
        ],
    ).filter(~is_whole)

    def rest(name: str) -> Column:
        return F.col(f"{name}_all") - F.col(f"{name}_with")

    def mean(metric: str, suffix: str) -> Column:
        n, total = F.col(f"n_{metric}_{suffix}"), F.col(f"sum_{metric}_{suffix}")
        return F.when(n > 0, total / n)

    n1, n2 = F.col("n_views_with"), F.col("n_views_without")

    def variance(suffix: str) -> Column:
        n, total = F.col(f"n_views_{suffix}"), F.col(f"sum_views_{suffix}")
        # The mean's share taken out in whole steps: total = n * whole + left.
        whole, left = (total - F.pmod(total, n)) / n, F.pmod(total, n)
        exact = F.col(f"squares_{suffix}").cast("decimal(38,0)") - (
            (total + left).cast("decimal(19,0)") * whole.cast("decimal(19,0)")
        )
        return F.when(n > 1, F.greatest(exact.cast("double") - left * (left / n), F.lit(0.0)) / (n - 1))

    rows = (
        both.withColumns({
            f"{part}_without": rest(part)
            for part in ["videos", "squares", *[f"{k}_{m}" for k in ("n", "sum") for m in measured]]
        })
        .withColumns({"mean_with": mean("views", "with"), "mean_without": mean("views", "without")})
        .withColumns({
            "n_with": n1,
            "n_without": n2,
            "var_with": variance("with"),
            "var_without": variance("without"),
        })
    )
    return with_welch(rows, "with", "without").select(
        *by,
        F.col("keyword.rank").alias("rank"),
        F.col("keyword.word").alias("keyword"),
        "videos_with",
        "videos_without",
        F.col("mean_with").alias("avg_views_with"),
        F.col("mean_without").alias("avg_views_without"),
        mean("likes", "with").alias("avg_likes_with"),
        mean("likes", "without").alias("avg_likes_without"),
        mean("engagement", "with").alias("avg_engagement_with"),
        mean("engagement", "without").alias("avg_engagement_without"),
        "t_stat",
        "df",
        "p_value",
        "significant",
    )


def emoji_impact(videos: DataFrame, by: By = NICHE, strict: bool = False) -> DataFrame:
    """Averages with and without emoji, their share, and Welch's t on views."""
    sides = {"with": F.col("has_emoji"), "without": ~F.col("has_emoji")}
    if strict and M.are_cells(videos):
        raise ValueError("cells hold the flag of the whole class; the strict one needs titles")
    counted = M.are_cells(videos) or ("has_emoji" in videos.columns and not strict)
    flagged = videos if counted else videos.withColumn("has_emoji", X.has_emoji(F.col("title"), strict))
    parts = []
    for suffix, side in sides.items():
        parts += M.sample(flagged, "view_count", suffix, side)
        parts += _averages(flagged, side, f"_{suffix}")
        parts.append(M.count(flagged, "video_id", side).alias(f"count_{suffix}"))
    known = M.rows(flagged, F.col("has_emoji").isNotNull())
    share = F.when(known > 0, M.rows(flagged, F.col("has_emoji")) / known) * 100
    tested = with_welch(
        flagged.groupBy(*by).agg(*parts, share.alias("emoji_percentage")), "with", "without"
    )
    rows = F.array(*[
        F.struct(
            F.lit(fixed.EMOJI_LABELS[suffix == "with"]).alias("has_emoji"),
            *[F.col(f"{name}_{suffix}").alias(name) for name in [*AVERAGES, "count"]],
        )
        for suffix in sides
    ])
    return tested.select(
        *by, F.inline(rows), "emoji_percentage", "t_stat", "df", "p_value", "significant"
    ).filter(F.col("count") > 0)
