import json

import pytest

from reelgauge import schemas
from reelgauge.operators import recommend
from reelgauge.plans import batch, niches
from reelgauge.plans.bronze import bronze_channels, bronze_videos
from reelgauge.plans.gold import write_gold
from reelgauge.plans.silver import duration_rejects, silver_videos
from reelgauge.sources import harvest, readers, sinks

VIDEO = {
    "id": "v1",
    "snippet": {
        "title": "um vídeo",
        "channelId": "UCLPXpKv6WDc7mtapsbMyPHg",
        "channelTitle": "canal",
        "publishedAt": "2024-03-05T23:30:00Z",
        "thumbnails": {"high": {"url": "http://t/1.jpg"}},
    },
    "contentDetails": {"duration": "PT2M", "definition": "hd"},
    "statistics": {"viewCount": "200", "likeCount": "10", "commentCount": "0"},
    "extraction_date": "2024-05-01",
}
BARE = {"id": "v2"}
ODD = {
    "id": "v3",
    "snippet": {"thumbnails": {}},
    "statistics": {"viewCount": "many"},
    "contentDetails": {"duration": "soon"},
}


def write_array(folder, name, rows):
    folder.mkdir(exist_ok=True, parents=True)
    (folder / name).write_text(json.dumps(rows, indent=2, ensure_ascii=False), encoding="utf-8")
    return str(folder)


def test_bronze_videos_from_array_file(spark, tmp_path):
    path = write_array(tmp_path / "raw", "a.json", [VIDEO, BARE, ODD])
    raw = readers.read_json(spark, path, schemas.RAW_VIDEO, array_files=True)
    rows = {r.video_id: r for r in bronze_videos(raw).collect()}
    full, bare, odd = rows["v1"], rows["v2"], rows["v3"]
    assert (full.view_count, full.like_count, full.comment_count) == (200, 10, 0)
    assert (full.like_count_missing, full.comment_count_missing) == (False, False)
    assert str(full.published_at) == "2024-03-05 23:30:00"
    assert full.thumbnail_url == "http://t/1.jpg"
    assert (bare.view_count, bare.title, bare.published_at) == (0, None, None)
    assert bare.like_count_missing and bare.comment_count_missing
    assert (odd.view_count, odd.thumbnail_url) == (0, None)


def test_bronze_channels(spark, tmp_path):
    rows = [
        {"id": "c1", "snippet": {"title": "x"}, "statistics": {"viewCount": "5"},
         "contentDetails": {"relatedPlaylists": {"uploads": "UU1"}}},
        {"id": "c2"},
    ]
    path = write_array(tmp_path / "raw", "c.json", rows)
    raw = readers.read_json(spark, path, schemas.RAW_CHANNEL, array_files=True)
    found = {r.channel_id: r for r in bronze_channels(raw).collect()}
    assert (found["c1"].total_view, found["c1"].total_video, found["c1"].playlist) == (5, 0, "UU1")
    assert (found["c2"].total_subscriber, found["c2"].playlist) == (0, None)


def test_silver_needs_its_columns(spark):
    with pytest.raises(ValueError, match="published_at"):
        silver_videos(spark.createDataFrame([("v",)], "video_id string"))


def test_rejects_are_unreadable_durations(spark, tmp_path):
    path = write_array(tmp_path / "raw", "a.json", [VIDEO, BARE, ODD])
    bronze = bronze_videos(readers.read_json(spark, path, schemas.RAW_VIDEO, array_files=True))
    assert [r.video_id for r in duration_rejects(bronze).collect()] == ["v3"]


def test_reader_guards(spark, tmp_path):
    missing = str(tmp_path / "nothing")
    seen = []
    empty = readers.read_parquet(spark, missing, schemas.SUGGESTION, missing_ok=True, on_error=seen.append)
    assert empty.count() == 0 and empty.columns == ["channel_name", "dashboard"]
    assert len(seen) == 1
    with pytest.raises(Exception):
        readers.read_parquet(spark, missing, schemas.SUGGESTION)
    with pytest.raises(ValueError):
        readers.read_json(spark, "  ", schemas.RAW_VIDEO)


def test_save_guards(spark, tmp_path):
    rows = spark.createDataFrame([("a", "b")], schemas.SUGGESTION)
    none = rows.filter("false")
    target = tmp_path / "table"
    assert sinks.save(none, str(target)) is False and not target.exists()
    assert sinks.save(none, str(target), "excel") is False
    with pytest.raises(ValueError):
        sinks.save(rows, str(target), "excel")
    assert sinks.save(rows, str(target), "CSV") is True
    assert spark.read.option("header", True).csv(str(target)).collect() == rows.collect()
    assert sinks.save(rows, str(target)) is True
    assert sinks.save(none, str(target)) is False
    assert spark.read.parquet(str(target)).count() == 1


def test_landing_replaces_its_dates_only(spark, tmp_path):
    path = str(tmp_path / "landed")
    rows = spark.createDataFrame([("v1",), ("v2",)], "id string")
    assert sinks.land_json(rows, path, "2024-05-01")
    assert sinks.land_json(rows.filter("id = 'v1'"), path, "2024-05-02")
    assert sinks.land_json(rows.filter("id = 'v2'"), path, "2024-05-02")
    assert sinks.land_json(rows.filter("false"), path, "2024-05-01") is False
    found = readers.read_json(spark, path, schemas.RAW_VIDEO).select("id", "extraction_date")
    assert {tuple(map(str, r)) for r in found.collect()} == {
        ("v1", "2024-05-01"), ("v2", "2024-05-01"), ("v2", "2024-05-02")
    }


def test_suggestions_append_and_reject_empty(spark, tmp_path):
    log = str(tmp_path / "log")
    assert sinks.read_suggestions(spark, log).count() == 0
    first = spark.createDataFrame([("canal", "Fitness"), ("", "Fitness"), (None, "x")], schemas.SUGGESTION)
    sinks.append_suggestions(first, log)
    sinks.append_suggestions(spark.createDataFrame([("canal", "Viagens"), (" ", "Viagens")], schemas.SUGGESTION), log)
    found = sorted(tuple(r) for r in sinks.read_suggestions(spark, log).collect())
    assert found == [(" ", "Viagens"), ("canal", "Fitness"), ("canal", "Viagens")]


def test_pipeline_keeps_the_newest_landing_and_writes_gold(spark, tmp_path):
    raw = tmp_path / "raw"
    newer = {**VIDEO, "statistics": {"viewCount": "900", "likeCount": "9"}, "extraction_date": "2024-05-02"}
    short = {**VIDEO, "id": "v4", "contentDetails": {"duration": "PT90S"}}
    write_array(raw, "a.json", [VIDEO, BARE])
    write_array(raw, "b.json", [newer, short, BARE])
    silver = batch.run_videos(
        spark, str(raw), str(tmp_path / "bronze"), str(tmp_path / "silver"), array_files=True
    )
    rows = {r.video_id: r for r in silver.collect()}
    assert set(rows) == {"v1", "v2", "v4"}
    assert (rows["v1"].view_count, rows["v1"].engagement_rate) == (900, 1.0)
    assert (rows["v1"].dia_semana, rows["v1"].hora_publicacao, rows["v1"].ano_mes_publish) == (
        "Tuesday", 23, "2024-03"
    )
    assert rows["v2"].ano is None
    assert silver.schema == schemas.SILVER_VIDEO

    view = niches.niche_view(silver, niches.niche_bridge(spark))
    chosen = ["recommendations", "overview_totals", "channel_month_compare", *recommend.INPUTS]
    write_gold(view, str(tmp_path / "gold"), chosen)
    advice = spark.read.parquet(str(tmp_path / "gold" / "recommendations"))
    assert sorted(map(tuple, advice.collect())) == sorted(
        map(tuple, recommend.recommendations(view).collect())
    )
    totals = spark.read.parquet(str(tmp_path / "gold" / "overview_totals")).collect()
    assert {(r.niche, r.length_class, r.n_videos, r.total_views) for r in totals} == {
        ("Viagens", "long", 1, 900), ("Viagens", "short", 1, 200)
    }
    compared = spark.read.parquet(str(tmp_path / "gold" / "channel_month_compare")).collect()
    assert {r.month_name for r in compared} == {"March"}


def test_channels_job(spark, tmp_path):
    raw = write_array(tmp_path / "raw", "c.json", [{"id": "c1"}])
    assert batch.run_channels(spark, raw, str(tmp_path / "bronze"), array_files=True)
    assert spark.read.parquet(str(tmp_path / "bronze")).count() == 1


def test_unreadable_rows_are_rejects(spark, tmp_path):
    from reelgauge.plans import batch

    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.json").write_text(
        '{"id": "v1", "snippet": {"publishedAt": "2024-01-01T00:00:00Z"}, "contentDetails": {"duration": "PT1M"}}\n'
        '{"id": "v2", "snippet": {"publishedAt": "soon"}, "contentDetails": {"duration": "long"}}\n'
        '{"id": "v3", "snip\n{"snippet": {"title": "no id"}}\n{"snippet": {"title": "no id either"}}\n'
    )
    paths = [str(tmp_path / x) for x in ("raw", "bronze", "silver")]
    silver = batch.run_videos(spark, *paths, rejects=str(tmp_path / "rejects"))
    assert sorted(x.video_id for x in silver.collect()) == ["v1", "v2"]
    found = spark.read.parquet(str(tmp_path / "rejects")).collect()
    reasons = sorted((x.reason, x.video_id) for x in found if x.video_id)
    assert reasons == [("duration", "v2"), ("published_at", "v2")]
    assert sorted(x.reason for x in found if not x.video_id) == ["no id", "no id", "unreadable"]
    assert all(x.source_file.endswith("a.json") and x.record for x in found)


def test_rows_without_key_stay(spark):
    rows = spark.createDataFrame([(None, "1"), (None, "1"), ("a", "2"), ("a", "1")], "video_id string, extraction_date string")
    found = harvest.one_landing(rows).collect()
    assert sorted(map(tuple, found), key=str) == [("a", "1"), (None, "1"), (None, "1")]


def test_rebuild_drops_vanished_partitions(spark, tmp_path):
    path = str(tmp_path / "table")
    sinks.save_table(spark.createDataFrame([("a", 2023), ("b", 2024)], "id string, ano int"), path, ["ano"], ["id"])
    sinks.save_table(spark.createDataFrame([("a", 2024), ("b", 2024)], "id string, ano int"), path, ["ano"], ["id"])
    assert sorted(map(tuple, spark.read.parquet(path).select("id", "ano").collect())) == [("a", 2024), ("b", 2024)]
