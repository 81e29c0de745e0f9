import json

import pytest
from pyspark.sql import functions as F

from reelgauge import schemas
from reelgauge.streaming import daily


def run(spark, folder, tmp_path, pattern="*.parquet", files=1):
    query = daily.start_daily(
        daily.event_stream(spark, str(folder), pattern, files=files),
        str(tmp_path / "counts"),
        str(tmp_path / "checkpoint"),
        key="event_id",
        day=F.col("ts"),
        amount=F.col("value"),
    )
    query.awaitTermination()
    return query


def events(spark, *rows):
    return spark.createDataFrame(
        [(i, ts, 1, "view", v, "{}") for i, ts, v in rows],
        "event_id long, ts string, user_id long, event_type string, value double, props string",
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def land(frame, folder, number):
    frame.coalesce(1).write.mode("append").parquet(str(folder / f"load={number}"))


@pytest.fixture
def folder(tmp_path):
    return tmp_path / "events"


def test_repeats_and_later_runs(spark, tmp_path, folder):
    land(events(spark, (1, "2024-01-01 10:00:00", 2.0), (2, "2024-01-02 10:00:00", 3.0)), folder, 1)
    run(spark, folder / "*", tmp_path)
    again = events(spark, (2, "2024-01-02 10:00:00", 3.0), (3, "2024-01-02 11:00:00", 4.0), (3, "2024-01-02 11:00:00", 4.0))
    land(again, folder, 2)
    run(spark, folder / "*", tmp_path)
    found = {str(r.day): (r.n, r.total) for r in daily.daily_totals(spark, str(tmp_path / "counts")).collect()}
    assert found == {"2024-01-01": (1, 2.0), "2024-01-02": (2, 7.0)}
    months = daily.monthly_totals(spark, str(tmp_path / "counts")).collect()
    assert [(r.ano_mes, r.n, r.total) for r in months] == [("2024-01", 3, 9.0)]


def test_late_rows_reopen_their_day(spark, tmp_path, folder):
    land(events(spark, (1, "2024-01-20 10:00:00", 1.0)), folder, 1)
    run(spark, folder / "*", tmp_path)
    land(events(spark, (2, "2024-01-01 10:00:00", 1.0), (3, "2024-01-19 10:00:00", 1.0)), folder, 2)
    run(spark, folder / "*", tmp_path)
    land(events(spark, (4, "2024-01-01 11:00:00", 5.0), (2, "2024-01-01 10:00:00", 1.0)), folder, 3)
    run(spark, folder / "*", tmp_path)
    found = {str(r.day): (r.n, r.total) for r in daily.daily_totals(spark, str(tmp_path / "counts")).collect()}
    assert found == {"2024-01-20": (1, 1.0), "2024-01-19": (1, 1.0), "2024-01-01": (2, 6.0)}


@pytest.mark.parametrize("files", [1, 1000])
def test_trigger_size_changes_nothing(spark, tmp_path, sf_dir, files):
    landed = str(tmp_path / "landed")
    spark.read.parquet(f"{sf_dir}/events.parquet").repartition(4, "event_id").write.parquet(landed)
    run(spark, landed, tmp_path, files=files)
    total = daily.daily_totals(spark, str(tmp_path / "counts")).agg(F.sum("n")).first()[0]
    assert total == spark.read.parquet(f"{sf_dir}/events.parquet").count()


def test_many_triggers_and_bases(spark, tmp_path, sf_dir, monkeypatch):
    monkeypatch.setattr(daily, "ERA", 4)
    landed = str(tmp_path / "landed")
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").limit(500)
    rows.unionByName(rows).repartition(22, F.rand(1)).write.option("maxRecordsPerFile", 10).parquet(landed)
    query = run(spark, landed, tmp_path, files=9)
    assert query.lastProgress["batchId"] > 9
    found = daily.daily_totals(spark, str(tmp_path / "counts"))
    expected = rows.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)), F.round(F.sum("value"), 6))
    assert sorted(map(tuple, found.select("day", "n", F.round("total", 6)).collect())) == sorted(map(tuple, expected.collect()))


def test_work_of_a_trigger_follows_its_rows(spark, tmp_path, folder):
    """A day of 2,000 keys; then one more key for that day, twice, and an old one."""
    first = [(i, "2024-01-01 10:00:00", 1.0) for i in range(2000)]
    land(events(spark, *first), folder, 1)
    run(spark, folder / "*", tmp_path)
    land(events(spark, (5000, "2024-01-01 11:00:00", 2.0), (5000, "2024-01-01 11:00:00", 2.0), first[7]), folder, 2)
    progress = run(spark, folder / "*", tmp_path).lastProgress
    (state,) = progress["stateOperators"]
    assert (progress["numInputRows"] // 2, state["numRowsUpdated"], state["numRowsTotal"]) == (3, 1, 2001)
    assert [tuple(x)[1:] for x in daily.daily_totals(spark, str(tmp_path / "counts")).collect()] == [(2001, 2002.0)]
    added = spark.read.parquet(str(tmp_path / "counts" / "added")).orderBy("batch").select("batch", "n", "total")
    assert [tuple(x) for x in added.collect()] == [(0, 2000, 2000.0), (1, 1, 2.0)]


def test_rows_without_key_or_day_count(spark, tmp_path, folder):
    land(events(spark, (None, "2024-01-01 10:00:00", 1.0), (None, "2024-01-01 10:00:00", 1.0), (1, None, 2.0)), folder, 1)
    run(spark, folder / "*", tmp_path)
    found = {r.day and str(r.day): (r.n, r.total) for r in daily.daily_totals(spark, str(tmp_path / "counts")).collect()}
    assert found == {"2024-01-01": (2, 2.0), None: (1, 2.0)}


def test_no_table_yet(spark, tmp_path):
    assert daily.daily_totals(spark, str(tmp_path / "none")).collect() == []


def test_landed_videos(spark, tmp_path):
    folder = tmp_path / "landed" / "extraction_date=2024-05-01"
    folder.mkdir(parents=True)
    rows = [
        {"id": f"v{n % 3}", "snippet": {"publishedAt": f"2020-02-0{n % 3 + 1}T10:00:00Z"},
         "statistics": {"viewCount": "10"}}
        for n in range(6)
    ]
    (folder / "part.json").write_text("\n".join(map(json.dumps, rows)))
    query = daily.start_daily(
        daily.landed_video_stream(spark, str(tmp_path / "landed")),
        str(tmp_path / "counts"),
        str(tmp_path / "checkpoint"),
        key="video_id",
        day=F.col("published_at"),
        amount=F.col("view_count"),
    )
    query.awaitTermination()
    found = {str(r.day): (r.n, r.total) for r in daily.daily_totals(spark, str(tmp_path / "counts")).collect()}
    assert found == {f"2020-02-0{d}": (1, 10.0) for d in (1, 2, 3)}


def test_stream_equals_batch(spark, tmp_path, sf_dir):
    run(spark, sf_dir, tmp_path, "events.parquet")
    batch = (
        spark.read.schema(schemas.EVENT).parquet(f"{sf_dir}/events.parquet")
        .groupBy(F.to_date("ts").alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    stream = daily.daily_totals(spark, str(tmp_path / "counts")).select("day", "n")
    assert sorted(map(tuple, stream.collect())) == sorted(map(tuple, batch.collect()))
