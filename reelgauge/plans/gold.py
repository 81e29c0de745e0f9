"""Every analysis by name, and the job that writes them as gold tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from pyspark.sql import DataFrame

from reelgauge.operators import (
    channels,
    compare,
    cube,
    duration,
    overview,
    recommend,
    records,
    season,
    titles,
    weekday,
)
from reelgauge.session import settle

ANALYSES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "overview_totals": overview.totals,
    "overview_monthly": overview.monthly,
    "channel_list": overview.channel_list,
    "channel_month_compare": channels.month_compare,
    "records": records.catalogue_records,
    "weekday_stats": weekday.stats,
    "weekday_popularity": weekday.popularity,
    "weekday_best_worst": weekday.best_worst,
    "weekday_anova": weekday.anova,
    "monthly_seasonality": season.monthly,
    "monthly_trend": season.trend,
    "long_short_stats": compare.stats,
    "long_short_compare": compare.metric_table,
    "long_short_ratio": compare.ratio,
    "welch_long_short": compare.welch,
    "views_box": compare.box,
    "views_outliers": compare.outliers,
    "views_density": compare.density,
    "title_length_mean": titles.length_mean,
    "title_length_perf": titles.length_performance,
    "title_length_best": titles.length_best,
    "title_length_corr": titles.length_correlation,
    "top_words": titles.top_words,
    "word_weights": titles.word_weights,
    "keyword_impact": titles.keyword_impact,
    "emoji_impact": titles.emoji_impact,
    "duration_corr": duration.correlation,
    "view_quantiles": duration.view_quantiles,
    "duration_scatter": duration.scatter,
    "duration_fit": duration.fit,
    "recommendations": recommend.recommendations,
}


#: Analyses drawn from the cells of ``cube``, and those that need numbers of single videos but no text.
FROM_CELLS = frozenset({
    "overview_totals", "overview_monthly", "channel_list", "channel_month_compare", "weekday_stats",
    "weekday_popularity", "weekday_best_worst", "weekday_anova", "monthly_seasonality", "monthly_trend",
    "long_short_stats", "long_short_compare", "long_short_ratio", "welch_long_short", "title_length_mean",
    "title_length_perf", "title_length_best", "title_length_corr", "emoji_impact", "duration_corr",
})
FROM_NUMBERS = frozenset({"views_box", "views_outliers", "views_density", "view_quantiles"})


def write_gold(view: DataFrame, folder: str, names: Iterable[str] | None = None) -> None:
    """Write the named analyses (default: all) of a niche view below ``folder``.

    The view is read once for its numbers, a table without texts that the cells
    and all quantiles come from, and four times for what needs texts: record
    holders, word counts, keywords and the trimmed videos. Limits, word counts,
    box summaries and the trimmed set are made once for all that use them, and
    recommendations are drawn from the tables just written.
    """
    chosen = set(ANALYSES if names is None else names)
    read = view.sparkSession.read
    made: dict[str, DataFrame] = {}

    def shared(name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if name not in made:
            made[name] = make()
        return made[name]

    def numbers() -> DataFrame:
        return shared("numbers", lambda: settle(cube.narrow(view), "numbers"))

    def cells() -> DataFrame:
        return shared("cells", lambda: cube.cells(numbers()))

    def limits() -> DataFrame:
        return shared("limits", lambda: settle(duration.view_quantiles(numbers()), "limits"))

    def counts() -> DataFrame:
        return shared("counts", lambda: settle(titles.word_counts(view, limits=limits()), "word-counts"))

    def summary() -> DataFrame:
        return shared("summary", lambda: compare.box_summary(numbers()))

    def trimmed() -> DataFrame:
        return shared("trimmed", lambda: settle(duration.scatter(view, limits=limits()), "trimmed"))

    special: dict[str, Callable[[], DataFrame]] = {
        "records": lambda: records.catalogue_records(view, cells=cells()),
        "views_box": lambda: compare.box(numbers(), summary=summary()),
        "views_outliers": lambda: compare.outliers(numbers(), summary=summary()),
        "view_quantiles": limits,
        "duration_scatter": trimmed,
        "duration_fit": lambda: duration.fit(view, trimmed=trimmed()),
        **{
            name: lambda name=name: ANALYSES[name](view, counts=counts())
            for name in ("top_words", "word_weights", "keyword_impact")
        },
    }

    def result(name: str) -> DataFrame:
        if name in special:
            return special[name]()
        if name == "recommendations":
            if set(recommend.INPUTS) <= chosen:
                return recommend.advice({table: read.parquet(f"{folder}/{table}") for table in recommend.INPUTS})
            found = {table: result(table) for table in set(recommend.INPUTS) - {"keyword_impact"}}
            return recommend.advice({**found, "keyword_impact": titles.keyword_impact(view, limit=1, counts=counts())})
        return ANALYSES[name](cells() if name in FROM_CELLS else numbers() if name in FROM_NUMBERS else view)

    for name in sorted(chosen, key=lambda n: (n == "recommendations", n)):
        result(name).write.mode("overwrite").parquet(f"{folder}/{name}")
