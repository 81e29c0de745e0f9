import hashlib

from pyspark.sql import functions as F

from reelgauge import schemas
from reelgauge.plans.niches import harvested_channels
from reelgauge.sources import harvest
from reelgauge.sources.sinks import stamp_extraction_date


def test_batches_cut_the_ranked_ids(spark):
    rows = [("hot", f"v{i}") for i in range(777)] + [("cold", "w1"), ("cold", "w2"), ("cold", "w1")]
    batches = harvest.id_batches(spark.createDataFrame(rows, "channel_id string, video_id string"))
    found = {(r.channel_id, r.batch_no): r.ids for r in batches.collect()}
    ranked = sorted({v for c, v in rows if c == "hot"}, key=lambda v: hashlib.md5(v.encode()).hexdigest())
    for number in range(16):
        assert found["hot", number] == sorted(ranked[number * 50 : number * 50 + 50])
    assert found["cold", 0] == ["w1", "w2"]
    assert len(found) == 17


def test_bucket_width_does_not_change_batches(spark):
    ids = spark.range(300).select(F.lit("c").alias("channel_id"), F.concat(F.lit("v"), "id").alias("video_id"))
    wide = harvest.id_batches(ids, size=7, bucket_digits=1)
    fine = harvest.id_batches(ids, size=7, bucket_digits=5)
    assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, fine.collect()))


def test_pages_without_items(spark):
    pages = spark.createDataFrame(
        [
            ("p1", '{"items": [{"contentDetails": {"videoId": "a"}}, {"contentDetails": {"videoId": "b"}}]}'),
            ("p2", '{"nextPageToken": "x"}'),
            ("p3", '{"items": []}'),
            ("p4", "not json"),
        ],
        "playlist string, page string",
    )
    assert sorted(map(tuple, harvest.page_ids(pages).collect())) == [("p1", "a"), ("p1", "b")]


def test_one_landing(spark):
    rows = [("v1", "2024-05-02", 5), ("v1", "2024-05-01", 9), ("v1", "2024-05-01", 7), ("v2", "2024-05-03", 1)]
    landed = spark.createDataFrame(rows, "video_id string, extraction_date string, view_count long")
    assert sorted(map(tuple, harvest.one_landing(landed).collect())) == [
        ("v1", "2024-05-01", 7), ("v2", "2024-05-03", 1)
    ]
    last = {r.video_id: r.view_count for r in harvest.one_landing(landed, keep="last").collect()}
    assert last == {"v1": 5, "v2": 1}


def test_counts(spark):
    found = spark.createDataFrame([("c1", "a"), ("c1", "a"), ("c2", "b")], "channel_id string, video_id string")
    details = spark.createDataFrame([("a", "2024-05-01"), ("a", "2024-05-02")], "video_id string, extraction_date string")
    row = harvest.harvest_counts(found, details).first().asDict()
    assert row == {
        "channels_processed": 2,
        "total_videos_found": 3,
        "videos_with_details": 2,
        "processed_video_ids": 1,
        "extraction_date": "2024-05-02",
    }


def test_playlists_and_stamp(spark):
    raw = spark.createDataFrame([("c1", None, None, (("UU1",),))], schemas.RAW_CHANNEL)
    assert tuple(harvest.playlists(raw).first()) == ("c1", "UU1")
    assert stamp_extraction_date(raw, "2024-05-01").first().extraction_date == "2024-05-01"


def test_all_harvested_channels(spark):
    assert harvested_channels(spark).count() == 103
