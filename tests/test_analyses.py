import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelgauge.operators.grouped import displayed
from reelgauge.operators import channels, compare, duration, overview, recommend, records, season, titles, weekday
from reelgauge.operators.significance import pearson, with_pearson
from reelgauge.plans.gold import ANALYSES


def only(frame):
    rows = frame.collect()
    assert len(rows) == 1
    return rows[0]


def test_records_break_ties_by_smallest_id(videos):
    frame = videos(
        {"video_id": "b", "title": "B", "view_count": 9, "like_count": 7, "published_at": "2024-02-01 00:00:00"},
        {"video_id": "a", "title": "A", "view_count": 9, "like_count": 1, "published_at": "2024-02-01 00:00:00"},
        {"video_id": "c", "title": "C", "view_count": 5, "like_count": 7, "duration": "PT30S",
         "channel_name": "two", "published_at": "2024-03-01 00:00:00"},
        {"video_id": "d", "title": "D", "view_count": 0, "duration": None, "comment_count": 4, "channel_name": "two"},
    )
    row = only(records.catalogue_records(frame))
    assert (row.views_title, row.views) == ("A", 9)
    assert (row.long_views_title, row.long_views) == ("A", 9)
    assert (row.likes_title, row.likes) == ("D", 10)
    assert (row.comments_title, row.comments) == ("D", 4)
    assert (row.first_title, row.first_date) == ("D", "01/01/2024")
    assert (row.longest_title, row.longest_duration) == ("A", "0h 10m 0s")
    assert (row.engagement_title, row.engagement_rate) == ("C", pytest.approx(160.0))
    assert (row.most_videos_channel, row.most_videos) == ("one", 2)
    assert (row.most_per_month_channel, row.most_per_month) == ("one", pytest.approx(2 / 3))


def test_no_long_video_leaves_its_record_empty(videos):
    row = only(records.catalogue_records(videos({"duration": "PT10S"}, {"duration": "PT20S"})))
    assert row.long_views is None and row.long_views_title is None and row.views == 100


def test_weekday_ties_go_to_the_earlier_day(videos):
    frame = videos(
        {"published_at": "2024-01-07 10:00:00"},
        {"published_at": "2024-01-02 10:00:00"},
        {"published_at": "2024-01-03 10:00:00"},
    )
    row = only(weekday.popularity(frame))
    assert (row.most_popular_day, row.least_popular_day) == ("Tuesday", "Tuesday")
    row = only(weekday.best_worst(frame))
    assert (row.best_day_pt, row.worst_day_pt, row.diff_pct) == ("Terça", "Terça", 0.0)


def test_gap_over_a_worst_day_without_views(videos):
    frame = videos({"view_count": 0}, {"published_at": "2024-01-02 10:00:00"})
    assert only(weekday.best_worst(frame)).diff_pct is None


def test_anova_equals_formula(spark, videos):
    rng = np.random.default_rng(3)
    rows, groups = [], {}
    for day in range(1, 6):
        for _ in range(4 + day):
            views = int(rng.integers(1, 1000)) + 60 * day
            groups.setdefault(day, []).append(views)
            rows.append({"published_at": f"2024-01-0{day} 10:00:00", "view_count": views})
    row = only(weekday.anova(videos(*rows)))
    values = np.concatenate(list(groups.values()))
    between = sum(len(g) * (np.mean(g) - values.mean()) ** 2 for g in groups.values())
    inside = sum(((np.array(g) - np.mean(g)) ** 2).sum() for g in groups.values())
    statistic = (between / 4) / (inside / (len(values) - 5))
    fisher = spark._jvm.org.apache.commons.math3.distribution.FDistribution(4.0, float(len(values) - 5))
    assert (row.n_groups, row.n) == (5, len(values))
    assert row.f_stat == pytest.approx(statistic)
    assert row.p_value == pytest.approx(1 - fisher.cumulativeProbability(float(statistic)), abs=1e-9)


def test_anova_of_one_day_is_undefined(videos):
    row = only(weekday.anova(videos({}, {"view_count": 5})))
    assert (row.n_groups, row.f_stat, row.p_value) == (1, None, None)


def test_welch_equals_formula(spark, videos):
    long, short = [10, 20, 40, 80], [5, 6, 9]
    rows = [{"view_count": n} for n in long] + [{"view_count": n, "duration": "PT9S"} for n in short]
    found = {r.metric: r for r in compare.welch(videos(*rows)).collect()}
    a, b = np.var(long, ddof=1) / 4, np.var(short, ddof=1) / 3
    t = (np.mean(long) - np.mean(short)) / math.sqrt(a + b)
    df = (a + b) ** 2 / (a * a / 3 + b * b / 2)
    student = spark._jvm.org.apache.commons.math3.distribution.TDistribution(float(df))
    row = found["avg_views"]
    assert (row.n_long, row.n_short) == (4, 3)
    assert (row.t_stat, row.df) == (pytest.approx(t), pytest.approx(df))
    assert row.p_value == pytest.approx(2 * student.cumulativeProbability(-abs(float(t))), abs=1e-9)
    assert row.significant == (row.p_value < 0.05)
    assert found["avg_likes"].t_stat is None  # no spread


def test_one_class_only(videos):
    frame = videos({}, {"view_count": 50})
    assert [r.length_class for r in compare.stats(frame).collect()] == ["long"]
    row = only(compare.ratio(frame))
    assert (row.view_ratio, row.favour_shorts) == (None, False)
    assert all(r.t_stat is None and r.n_short == 0 for r in compare.welch(frame).collect())
    assert {r.short for r in compare.metric_table(frame).collect()} == {None}


def test_box_and_outliers(videos):
    views = [10, 11, 12, 13, 14, 15, 16, 17, 18, 500]
    frame = videos(*[{"view_count": n} for n in views], {"view_count": 0, "duration": None})
    row = only(compare.box(frame))
    assert [row["min"], row.q1, row.median, row.q3, row["max"]] == pytest.approx(
        list(np.quantile(views, [0, 0.25, 0.5, 0.75, 1]))
    )
    assert (row.lower_fence, row.upper_fence, row.n_outliers) == (10, 18, 1)
    assert [r.view_count for r in compare.outliers(frame).collect()] == [500]


def test_density_adds_up(videos):
    frame = videos(*[{"view_count": n} for n in [0, 1, 9, 10, 99, 100, 1000]])
    found = compare.density(frame, bandwidth=0.2).collect()
    assert {r.bin: r.n for r in found} == {0: 2, 9: 1, 10: 1, 19: 1, 20: 1, 30: 1}
    assert sum(r.share for r in found) == pytest.approx(1.0)
    assert all(r.density > 0 for r in found)


def test_overview_parts_add_up(videos):
    frame = videos(
        {}, {"duration": "PT9S"}, {"duration": None}, {"published_at": "2024-02-01 00:00:00", "channel_name": "two"}
    )
    totals = overview.totals(frame).collect()
    monthly = overview.monthly(frame).collect()
    assert sum(r.n_videos for r in totals) == sum(r.n_videos for r in monthly) == 3
    assert sum(r.total_views for r in totals) == sum(r.total_views for r in monthly)
    assert [r.n_videos for r in overview.totals(frame, channels=["two"]).collect()] == [1]
    assert overview.channel_list(frame).count() == 2


def test_channel_in_one_year_only(videos):
    frame = videos(
        {"published_at": "2023-05-01 00:00:00", "view_count": 0},
        {"published_at": "2023-05-02 00:00:00", "view_count": 50, "like_count": 4, "comment_count": 1},
        {"published_at": "2019-05-02 00:00:00", "channel_name": "old"},
    )
    row = only(channels.month_compare(frame))
    assert (row.mes, row.month_name, row.channel_name) == (5, "May", "one")
    assert (row.total_views_2023, row.avg_engagement_rate_2023) == (50, 10.0)
    assert row.weighted_engagement_rate_2023 == 10.0
    assert row.total_views_2024 is None and row.avg_engagement_rate_2025 is None
    joined = only(channels.year_compare_by_join(frame, [2023, 2024]))
    assert (joined.total_views_2023, joined.total_views_2024) == (50, None)


def test_pivot_equals_outer_joins(videos):
    frame = videos(*[
        {"published_at": f"{2023 + i % 3}-01-0{1 + i % 5} 00:00:00", "channel_name": f"c{i % 4}", "view_count": i}
        for i in range(30)
    ])
    columns = ["channel_name", "total_views_2023", "total_likes_2024", "avg_engagement_rate_2025"]
    wide = channels.month_compare(frame).select(*columns)
    joined = channels.year_compare_by_join(frame, [2023, 2024, 2025]).select(*columns)
    assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, joined.collect()))


def test_trend_skips_absent_months_unless_calendar(videos):
    frame = videos(*[
        {"published_at": f"2024-{month:02d}-01 00:00:00", "view_count": views}
        for month, views in [(1, 10), (2, 20), (6, 30)]
    ])
    rows = season.trend(frame).filter("metric = 'media_views'").orderBy("date").collect()
    assert [r.month_index for r in rows] == [0, 1, 2]
    assert [r.fitted for r in rows] == pytest.approx([10, 20, 30])
    rows = season.trend(frame, calendar=True).filter("metric = 'media_views'").orderBy("date").collect()
    assert [r.month_index for r in rows] == [0, 1, 5]
    assert rows[0].slope == pytest.approx(np.polyfit([0, 1, 5], [10, 20, 30], 1)[0])
    assert [str(r.date) for r in season.monthly(frame).collect()] == ["2024-01-01", "2024-02-01", "2024-06-01"]


def test_trend_of_one_month_is_undefined(videos):
    assert {r.slope for r in season.trend(videos({}, {})).collect()} == {None}


def test_empty_title_classes_stay(videos):
    frame = videos({"title": "x" * 25}, {"title": "x" * 71, "view_count": 300}, {"title": "x" * 101}, {"title": ""})
    rows = titles.length_performance(frame).orderBy("bin_no").collect()
    assert [(r.label, r["count"]) for r in rows] == [
        ("< 20", 0), ("20-30", 1), ("30-40", 0), ("40-50", 0), ("50-60", 0), ("60-70", 0), ("> 70", 1)
    ]
    assert rows[0].avg_views is None
    row = only(titles.length_best(frame))
    assert (row.best_views_length, row.best_engagement_length) == ("> 70", "20-30")
    assert only(titles.length_mean(frame)).avg_title_length == pytest.approx((25 + 71 + 101) / 4)


def test_correlation_leaves_unknown_rates_out(spark, videos):
    rows = [{"title": "x" * n, "view_count": v, "like_count": 5} for n, v in [(3, 10), (9, 0), (20, 25), (30, 31)]]
    found = {r.target: r for r in titles.length_correlation(videos(*rows)).collect()}
    assert (found["views"].n, found["engagement"].n) == (4, 3)
    assert found["views"].r == pytest.approx(np.corrcoef([3, 9, 20, 30], [10, 0, 25, 31])[0, 1])
    r, n = found["views"].r, 4
    student = spark._jvm.org.apache.commons.math3.distribution.TDistribution(2.0)
    t = r * math.sqrt((n - 2) / (1 - r * r))
    assert found["views"].p_value == pytest.approx(2 * student.cumulativeProbability(-abs(t)), abs=1e-9)


def test_correlation_of_a_constant_is_unknown(spark, videos):
    assert only(duration.correlation(videos({}, {"view_count": 5}))).r is None
    line = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0)], "x double, y double")
    frame = line.agg(pearson(F.col("x"), F.col("y")).alias("r"), F.count("x").alias("n"))
    assert only(with_pearson(frame)).p_value == pytest.approx(0.0, abs=1e-6)
    assert only(with_pearson(frame.withColumn("n", F.lit(2)))).p_value == 1.0


def test_top_words_and_weights(videos):
    frame = videos(
        {"title": "treino de peito com a treino", "view_count": 90},
        {"title": "Peito costas", "view_count": 80},
        {"title": "nunca visto", "view_count": 1},
        {"title": "nunca visto", "view_count": 1},
        {"title": "nunca visto", "view_count": 1},
    )
    found = titles.top_words(frame, limit=2).orderBy("rank").collect()
    assert [(r.word, r.n, r["rank"]) for r in found] == [("peito", 2, 1), ("treino", 2, 2)]
    weights = {r.word: r.weight for r in titles.word_weights(frame).collect()}
    assert weights == {"peito": 1.0, "treino": 1.0, "costas": 0.5}


def test_keyword_complement_equals_brute_force(videos):
    rng = np.random.default_rng(5)
    words = ["party", "art", "night", "treino", "x"]
    data = [(" ".join(rng.choice(words, 3)), int(rng.integers(0, 500)), int(rng.integers(0, 50))) for _ in range(80)]
    frame = videos(*[{"title": t, "view_count": v, "like_count": k} for t, v, k in data])
    found = {r.keyword: r for r in titles.keyword_impact(frame, words=["ART", "treino", "absent"]).collect()}
    assert set(found) == {"art", "treino"}
    for word, row in found.items():
        inside = [(v, k) for t, v, k in data if word in t]
        outside = [(v, k) for t, v, k in data if word not in t]
        a, b = (np.array([v for v, _ in side], float) for side in (inside, outside))
        assert (row.videos_with, row.videos_without) == (len(inside), len(outside))
        assert row.avg_views_without == pytest.approx(b.mean())
        assert row.avg_likes_without == pytest.approx(np.mean([k for _, k in outside]))
        spread = a.var(ddof=1) / len(a) + b.var(ddof=1) / len(b)
        assert row.t_stat == pytest.approx((a.mean() - b.mean()) / math.sqrt(spread))
    all_titles = only(titles.keyword_impact(videos({"title": "abc"}, {"title": "abcd"}), words=["abc"]))
    assert (all_titles.videos_without, all_titles.avg_views_without, all_titles.t_stat) == (0, None, None)


def test_emoji_share(videos):
    rows = titles.emoji_impact(videos({"title": "a 😀"}, {"title": "b"}, {"title": "c"}, {"title": "d"})).collect()
    assert {(r.has_emoji, r["count"]) for r in rows} == {("Com Emoji", 1), ("Sem Emoji", 3)}
    assert {r.emoji_percentage for r in rows} == {25.0}
    assert only(titles.emoji_impact(videos({}))).has_emoji == "Sem Emoji"


def test_scatter_trims_strictly_and_fit_follows(videos):
    rows = [{"duration": f"PT{n}M", "view_count": 7 * n + 3} for n in range(2, 102)]
    frame = videos(*rows, {"duration": "PT9S", "view_count": 10**6})
    kept = duration.scatter(frame).collect()
    assert sorted(r.duration_minutes for r in kept) == [float(n) for n in range(2, 101)]
    line = duration.fit(frame).orderBy("point").collect()
    assert len(line) == 100
    assert (line[0].x, line[-1].x) == (2.0, 100.0)
    assert (line[0].slope, line[0].intercept) == (pytest.approx(7), pytest.approx(3))
    row = only(duration.correlation(frame))
    assert (row.n, row.correlation) == (100, "positiva")


def test_recommendations(videos):
    shorts = [{"duration": "PT9S", "view_count": 1000 + n, "like_count": 500, "title": "olá 😀 corrida"} for n in range(5)]
    longs = [{"view_count": 100 + n, "title": "aula longa"} for n in range(5)]
    row = only(recommend.recommendations(videos(*shorts, *longs)))
    assert row.favour_shorts and row.use_emoji
    assert (row.best_views_length, row.publish_on) == ("< 20", "Segunda")
    assert (row.keyword, row.use_keyword) == ("corrida", True)


SINGLE = [
    "records", "weekday_anova", "monthly_trend", "long_short_compare", "views_box", "views_density",
    "title_length_perf", "top_words", "word_weights", "keyword_impact", "duration_fit", "recommendations",
]


@pytest.mark.parametrize("name", SINGLE)
def test_analyses_work_without_niche(name, videos):
    frame = videos(
        *[{"view_count": 10 * n, "title": f"palavra {n} 😀" * (n % 2 + 1), "duration": f"PT{n}M"} for n in range(1, 9)],
        {"duration": "PT5S"},
        {"published_at": "2024-02-02 00:00:00", "duration": "PT8S", "view_count": 3},
    )
    grouped = ANALYSES[name](frame).drop("niche")
    single = ANALYSES[name](frame.drop("niche"), by=()).select(*grouped.columns)

    def bag(rows):
        return sorted(str([round(x, 6) if isinstance(x, float) else x for x in row]) for row in rows)

    assert bag(single.collect()) == bag(grouped.collect())


def test_many_keywords_equal_a_plain_search(videos):
    titles_ = ["the party starts", "Art party 😀 now", "ab", "a", None, "straße ÉCOLE art", "x😀y art😀", "party " * 3000]
    rows = [{"title": t, "view_count": 10 * (i + 1)} for i, t in enumerate(titles_)]
    words = ["art", "Party", "école", "a", "ab", "😀", "t😀", "zzz", "the party starts", "art", "ß"]
    found = titles.keyword_impact(videos(*rows), words=words)
    for row in found.collect():
        held = [10 * (i + 1) for i, t in enumerate(titles_) if t is not None and row.keyword in t.lower()]
        assert (row.keyword, row.videos_with, row.avg_views_with) == (words[row.rank - 1].lower(), len(held), sum(held) / len(held))
        assert row.videos_without == len(titles_) - len(held)
    assert found.count() == len(words) - 1


def test_a_keyword_whose_videos_have_no_rate(videos):
    frame = videos({"title": "zero", "view_count": 0}, {"title": "more", "view_count": 100}, {"title": "more", "view_count": 200})
    row = titles.keyword_impact(frame, words=["zero"]).first()
    assert (row.videos_with, row.avg_engagement_with, row.avg_engagement_without) == (1, None, pytest.approx(8.25))


def test_rounding_for_display(spark):
    frame = spark.createDataFrame([(0.125, 2.5, 7)], "a double, b double, n long")
    assert tuple(displayed(frame, {"a": 2, "b": 0}).first()) == (0.12, 2.0, 7)
    assert tuple(displayed(frame, 1).first()) == (0.1, 2.5, 7)


def test_frequent_words_have_every_tie_of_the_last_place(spark):
    from reelgauge.operators.titles import frequent_words

    counts = {"a": 9, "b": 5, "c": 5, "d": 5, "e": 4, None: 1} | {f"w{i}": 1 for i in range(200)}
    rows = [("x", word) for word, n in counts.items() for _ in range(n)] + [("y", "a"), ("y", "b")]
    words = spark.createDataFrame(rows, "niche string, word string").repartition(5)
    exact = {("x", word): n for word, n in counts.items()} | {("y", "a"): 1, ("y", "b"): 1}
    for cells, tried in ((1, 1), (7, 1), (512, 1), (1 << 16, 4)):
        found = {(x.niche, x.word): x.n for x in frequent_words(words, ("niche",), 2, cells, tried).collect()}
        assert found.items() <= exact.items()
        assert {("x", word) for word in "abcd"} | {("y", "a"), ("y", "b")} <= found.keys()
        whole = {x.word: x.n for x in frequent_words(words, (), 2, cells, tried).collect()}
        assert whole["a"] == 10 and whole["b"] == 6 and all(n == counts[word] for word, n in whole.items() if word not in ("a", "b"))
    assert len(frequent_words(words, ("niche",), 2).collect()) < 40


def test_rare_words_are_not_shuffled(spark, videos):
    from reelgauge.operators import titles

    seen = []
    settle = titles.settle
    titles.settle = lambda df, label: seen.append((label, settle(df, label))) or seen[-1][1]
    try:
        rare = [{"title": " ".join(f"rare{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + j)}" for j in range(20))} for i in range(60)]
        found = titles.top_words(videos(*rare, *[{"title": "common words"}] * 5), limit=2).collect()
    finally:
        titles.settle = settle
    assert [(x.word, x.n) for x in found] == [("common", 5), ("words", 5)]
    assert max(df.count() for label, df in seen if label == "frequent-words") < 200
