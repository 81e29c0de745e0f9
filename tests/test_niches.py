from pyspark.sql import functions as F

from reelgauge import fixed_values as fixed
from reelgauge.plans import niches


def ids(frame):
    return sorted(r.video_id for r in frame.collect())


def test_bridge_counts(spark):
    counts = {r.niche: r["count"] for r in niches.niche_bridge(spark).groupBy("niche").count().collect()}
    assert counts == {"Fitness": 34, "Financas": 29, "Podcast": 23, "Viagens": 21}
    shared = niches.niche_bridge(spark).groupBy("channel_id").count().filter("count > 1")
    assert shared.count() == 4


def test_repeated_and_shared_channels(spark, videos):
    frame = videos({"channel_id": "a"}, {"channel_id": "b"}, {"channel_id": "x"}).drop("niche")
    bridge = spark.createDataFrame(
        [("n1", "a"), ("n1", "a"), ("n2", "a"), ("n2", "b")], "niche string, channel_id string"
    )
    assert ids(niches.videos_of_niche(frame, "n1", bridge)) == ["v000"]
    assert ids(niches.videos_of_niche(frame, "n2", bridge)) == ["v000", "v001"]
    unknown = niches.videos_of_niche(frame, "n9", bridge)
    assert ids(unknown) == [] and set(unknown.columns) == set(frame.columns)
    found = sorted((r.niche, r.video_id) for r in niches.with_niche(frame, bridge).collect())
    assert found == [("n1", "v000"), ("n2", "v000"), ("n2", "v001")]


def test_length_classes_split_all_videos(spark, videos):
    rows = [
        {"niche": niche, "duration": text}
        for niche in ("Fitness", "Podcast")
        for text in ("PT90S", "PT91S", "PT1H", "PT1H1S", None)
    ]
    found = [(r.niche, r.duration, r.length_class) for r in videos(*rows).collect()]
    assert found == [
        ("Fitness", 90.0, "short"),
        ("Fitness", 91.0, "long"),
        ("Fitness", 3600.0, "long"),
        ("Fitness", 3601.0, "long"),
        ("Fitness", None, None),
        ("Podcast", 90.0, "short"),
        ("Podcast", 91.0, "short"),
        ("Podcast", 3600.0, "short"),
        ("Podcast", 3601.0, "long"),
        ("Podcast", None, None),
    ]


def test_cuts_are_a_parameter(spark):
    frame = spark.createDataFrame([("x", 50.0), ("y", 50.0)], "niche string, duration double")
    column = niches.length_class(F.col("duration"), F.col("niche"), {"x": 40}, default=60)
    assert [r[0] for r in frame.select(column).collect()] == ["long", "short"]


def test_keep_channels(videos):
    frame = videos({"channel_name": "a"}, {"channel_name": "b"})
    assert niches.keep_channels(frame).count() == 2
    assert ids(niches.keep_channels(frame, ["b"])) == ["v001"]


def test_fixed_values():
    assert len(fixed.STOPWORDS) == 41
    assert len(fixed.TITLE_LENGTH_BINS) == 7
