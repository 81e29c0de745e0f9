import json

import pytest
from pyspark.sql import functions as F

from reelgauge import schemas
from reelgauge.operators.ranges import placed
from reelgauge.plans import increment
from reelgauge.plans.batch import run_videos
from reelgauge.sources import harvest


def video(number, views, at="2020-02-01T10:00:00Z"):
    return {"id": f"v{number}", "snippet": {"publishedAt": at, "channelId": f"c{number % 3}"}, "statistics": {"viewCount": str(views)},
            "contentDetails": {"duration": "PT5M"}}


def land(raw, date, *rows, name="part"):
    folder = raw / f"extraction_date={date}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in rows))


@pytest.fixture
def layers(tmp_path):
    names = ("raw", "bronze", "silver", "ledger", "rejects")
    return increment.Layers(*(str(tmp_path / x) for x in names), buckets=8)


def files(spark, path):
    rows = spark.read.parquet(path).select("bucket", F.col("_metadata.file_path").alias("f")).distinct().collect()
    found = {}
    for x in rows:
        found.setdefault(x.bucket, set()).add(x.f)
    return found


def rows_of(frame):
    return sorted(map(str, frame.select(sorted(frame.columns)).collect()))


def full(spark, layers, tmp_path):
    return run_videos(spark, layers.raw, str(tmp_path / "full_bronze"), str(tmp_path / "full_silver"))


def test_runs_equal_a_full_build_and_touch_what_changed(spark, tmp_path, layers):
    raw = tmp_path / "raw"
    land(raw, "2024-05-01", *[video(i, 10 + i) for i in range(40)], "cut off {")
    assert increment.run_increment(spark, layers) == list(range(8))
    before = files(spark, layers.bronze), files(spark, layers.silver)

    land(raw, "2024-05-02", video(3, 999, "2021-07-01T10:00:00Z"), video(3, 998), video(100, 5))
    touched = increment.run_increment(spark, layers)
    assert 1 <= len(touched) <= 2
    for path, old in zip((layers.bronze, layers.silver), before, strict=True):
        new = files(spark, path)
        for bucket in range(8):
            assert (new[bucket] == old[bucket]) == (bucket not in touched)
    assert rows_of(increment.silver(spark, layers)) == rows_of(full(spark, layers, tmp_path))

    land(raw, "2024-04-30", video(3, 1), video(200, 7))  # an older day, late
    increment.run_increment(spark, layers)
    land(raw, "2024-05-02", video(3, 1234), name="part")  # a file written anew
    increment.run_increment(spark, layers)
    found = {x.video_id: x.view_count for x in increment.bronze(spark, layers).collect()}
    assert found["v3"] == 1234 and found["v200"] == 7 and "v100" not in found and len(found) == 41
    assert increment.run_increment(spark, layers) == []
    assert spark.read.parquet(layers.rejects).select("reason").distinct().collect()[0].reason == "unreadable"


def test_only_new_files_are_read(spark, tmp_path, layers):
    raw = tmp_path / "raw"
    land(raw, "2024-05-01", video(1, 1))
    increment.run_increment(spark, layers)
    land(raw, "2024-05-02", video(2, 2))
    assert [x.path.split("/")[-2] for x in increment.new_files(spark, layers).collect()] == ["extraction_date=2024-05-02"]
    increment.run_increment(spark, layers)
    assert increment.new_files(spark, layers).count() == 0


def test_a_broken_run_is_repeated(spark, tmp_path, layers, monkeypatch):
    raw = tmp_path / "raw"
    land(raw, "2024-05-01", *[video(i, i) for i in range(10)])
    with monkeypatch.context() as patch:
        patch.setattr(increment, "silver_videos", lambda rows: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            increment.run_increment(spark, layers)
    assert increment.run_increment(spark, layers)
    assert rows_of(increment.silver(spark, layers)) == rows_of(full(spark, layers, tmp_path))


def test_nothing_usable(spark, tmp_path, layers):
    land(tmp_path / "raw", "2024-05-01", "{}", "nonsense")
    assert increment.run_increment(spark, layers) == []
    assert increment.silver(spark, layers).collect() == []


def test_one_landing_has_no_sort_aggregate(spark):
    rows = [("v1", "2024-05-02", 5, "a"), ("v1", "2024-05-02", 5, "a"), ("v1", "2024-05-02", 5, None), ("v2", "soon", 1, "x"),
            ("v2", None, 2, "y"), (None, "2024-01-01", 1, "n"), (None, "2024-01-01", 1, "n")]
    landed = spark.createDataFrame(rows, "video_id string, extraction_date string, view_count long, title string")
    first, last = harvest.one_landing(landed), harvest.one_landing(landed, keep="last")
    assert "SortAggregate" not in first._jdf.queryExecution().executedPlan().toString()
    none = [(None, "2024-01-01", 1, "n")] * 2
    assert sorted(map(tuple, first.collect()), key=str) == sorted([("v1", "2024-05-02", 5, None), ("v2", None, 2, "y"), *none], key=str)
    assert sorted(map(tuple, last.collect()), key=str) == sorted([("v1", "2024-05-02", 5, "a"), ("v2", "soon", 1, "x"), *none], key=str)


def test_global_batches(spark):
    ids = spark.range(1234).select(F.concat(F.lit("v"), F.col("id") % 1021).alias("video_id")).unionByName(
        spark.createDataFrame([(None,)], "video_id string")
    )
    batches = {x.batch_no: x.ids for x in harvest.id_batches_global(ids.repartition(7)).collect()}
    names = sorted(f"v{i}" for i in range(1021))
    assert batches == {i: names[50 * i : 50 * i + 50] for i in range(21)}


def test_places_are_shared_out_evenly(spark):
    rows = spark.range(100_000).select((F.col("id") * 7919 % 100_000).alias("x"))
    found = placed(rows, ["x"], 16)
    assert found.filter("place <> x").count() == 0 and found.count() == 100_000
    sizes = rows.repartitionByRange(16, "x").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert sizes < 100_000 / 16 * 2
    assert placed(rows.limit(0), ["x"]).collect() == []


def test_schemas_are_those_of_the_layers(spark, tmp_path, layers):
    land(tmp_path / "raw", "2024-05-01", video(1, 1))
    increment.run_increment(spark, layers)
    assert increment.bronze(spark, layers).schema.names == schemas.BRONZE_VIDEO.names
    assert increment.silver(spark, layers).schema.names == schemas.SILVER_VIDEO.names


def test_whole_rows_are_shuffled_once(spark, tmp_path, layers):
    """The title is in one shuffle of the rows that are written, that by bucket."""
    import re

    land(tmp_path / "raw", "2024-05-01", *[video(i, i) for i in range(20)])
    increment.run_increment(spark, layers)
    held = increment.read_parquet(spark, layers.bronze, increment._bucketed(schemas.BRONZE_VIDEO))
    text = increment._newest(held, 3)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1 and "Join" not in text


def test_slices_of_a_bucket_keep_one_row_a_video(spark, tmp_path, layers, monkeypatch):
    monkeypatch.setattr(increment, "SLICE", 1)
    land(tmp_path / "raw", "2024-05-01", *[video(i, 10 + i) for i in range(40)])
    land(tmp_path / "raw", "2024-05-02", *[video(i, 99) for i in range(0, 40, 2)], name="other")
    increment.run_increment(spark, layers)
    assert rows_of(increment.silver(spark, layers)) == rows_of(full(spark, layers, tmp_path))
