"""Physical plans: what must and must not be in them."""

import re
import time

import pytest

import __spark_entry__ as spark_entry
from oracle import catalogue
from reelgauge import session
from reelgauge.operators import overview, titles
from reelgauge.plans import niches
from reelgauge.sources import sinks
from reelgauge.sources.harvest import id_batches

QUERIES = spark_entry.queries()


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_the_needed_columns_only(spark, sf_dir):
    text = plan(overview.monthly(catalogue.view(spark, sf_dir)))
    scanned = [set(re.findall(r"(\w+)#", names)) for names in re.findall(r"FileScan parquet \[([^\]]*)\]", text)]
    used = {"video_id", "channel_id", "duration", "view_count", "ano_mes_publish", "ano"}
    assert used in scanned and all(names <= used | {"niche"} for names in scanned)
    assert "BroadcastHashJoin" in text


def test_years_prune_partitions(spark, sf_dir):
    text = plan(QUERIES["channel_month_compare"](spark, sf_dir))
    assert re.search(r"PartitionFilters: \[[^\]]*ano#\d+ IN \(1998,1999,2000\)", text)


def test_top_words_are_cut_before_the_shuffle(spark, sf_dir):
    text = plan(titles.top_words(catalogue.view(spark, sf_dir)))
    assert text.count("WindowGroupLimit") == 2


def test_ids_are_ranked_inside_buckets(spark, sf_dir):
    frame = id_batches(catalogue.silver(spark, sf_dir))
    windows = [line for line in plan(frame).splitlines() if "Window [row_number" in line]
    assert windows and all("bucket" in line for line in windows)
    frame.collect()
    final = plan(frame).split("Initial Plan")[0]
    assert final.count("ReusedExchange") == 1


def test_large_bridge_is_not_broadcast(spark, sf_dir):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        joined = niches.with_niche(catalogue.silver(spark, sf_dir), catalogue.bridge(spark, sf_dir))
        assert "SortMergeJoin" in plan(joined) or "ShuffledHashJoin" in plan(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_scratch_follows_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        assert session.scratch_dir(spark).startswith(shared)


def test_no_local_scratch_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn", "spark.app.id": "x"}.get(key, default)

    class Cluster:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_dir(Cluster())


def test_built_titles_are_shuffled_once(spark, sf_dir, monkeypatch):
    seen = []
    monkeypatch.setattr(catalogue, "save_table", lambda df, *args, **options: seen.append(options))
    monkeypatch.setattr(catalogue, "_BUILT", {})
    catalogue._built(spark, sf_dir)
    assert seen == [{"rebalance": False}]


def shuffled_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {name for name in names if name.startswith("shuffle_")}


def left_after(spark, write):
    """Shuffle files that are still there some time after ``write``."""
    held, before = shuffled_files(spark), spark.conf.get(session.CLEANUP, None)
    rows = spark.range(1000).selectExpr("id % 10 AS k", "id").repartition(3, "id").groupBy("k").count()
    write(rows)
    assert spark.conf.get(session.CLEANUP, None) == before
    for _ in range(100):  # executors delete them on their own time
        left = shuffled_files(spark) - held
        if not left:
            break
        time.sleep(0.1)
    return left


def test_settled_tables_leave_no_shuffle_files(spark):
    assert not left_after(spark, lambda rows: session.settle(rows, "released"))


def test_layers_leave_no_shuffle_files(spark):
    path = session.fresh_path(spark, "layer")
    assert not left_after(spark, lambda rows: sinks.save_table(rows, path, ["k"], ["count"]))
    assert spark.read.parquet(path).count() == 10


def test_titles_are_not_shuffled_for_chosen_words(spark, sf_dir):
    found = titles.keyword_impact(catalogue.view(spark, sf_dir), words=["den", "the", "\U0001f600", "été", "ab"])
    assert "SortMergeJoin" not in plan(found) and "ShuffledHashJoin" not in plan(found)
