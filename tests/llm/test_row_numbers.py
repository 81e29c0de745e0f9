"""Results do not follow from how a scan is split, which other cores may change between two jobs."""

import pytest

from reelgauge.llm import embeddings, fuzzy_lines, mixing, simhash, warc
from reelgauge.session import fresh_path, settle


@pytest.fixture
def shaky(spark, monkeypatch):
    """Every written table is followed by another number of splits."""
    turn = [0]

    def unsteady(frame, label):
        found = settle(frame, label)
        turn[0] += 1
        spark.conf.set("spark.sql.files.minPartitionNum", str((1, 29, 5)[turn[0] % 3]))
        return found

    for module in (embeddings, fuzzy_lines, mixing, simhash, warc):
        monkeypatch.setattr(module, "settle", unsteady)
    spark.conf.set("spark.sql.files.minPartitionNum", "5")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for name in ("minPartitionNum", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{name}")


def files(spark, rows, schema, sizes=(3, 40, 11, 80, 1, 25, 60, 7)):
    path, start = fresh_path(spark, "split"), 0
    for n in sizes:
        spark.createDataFrame(rows[start : start + n], schema).coalesce(1).write.mode("append").parquet(path)
        start += n
    return spark.read.schema(schema).parquet(path)


def test_lines_and_groups(spark, shaky):
    rows = [
        (i, f"one line that stands in all documents\nand number {i * 7919} {i * i} with words {i ^ 5} of its own {'xyz'[i % 3] * i}")
        for i in range(220)
    ]
    documents = files(spark, rows, "doc_id long, text string")
    left = {x.doc_id: x.text for x in fuzzy_lines.without_repeated_lines(documents, similar=1.0).collect()}
    assert left == {i: x if i == 0 else x.split("\n")[1] for i, x in rows}
    twice = files(spark, [(i, rows[i // 2][1]) for i in range(220)], "doc_id long, text string")
    assert sorted(x.doc_id for x in simhash.one_of_each_group(twice, reach=0).collect()) == list(range(0, 220, 2))


def test_mixed_copies(spark, shaky):
    rows = [(None if i % 9 == 0 else i, f"word{i % 4} number{i} " * 5, None if i % 7 == 0 else "ab"[i % 4 == 0]) for i in range(220)]
    documents = files(spark, rows, "doc_id long, text string, source string")
    wanted = {"a": 1.0, "b": 5.0}
    key = ["id", "source", "h1", "h2"]
    copies = {tuple(x[k] for k in key): x.copies for x in mixing.mix(documents, wanted).collect()}
    often = dict.fromkeys(copies, 0)
    for x in mixing.mixed(documents, wanted).select(*mixing._identity("source")).collect():
        often[tuple(x)] += 1
    assert often == copies and len(set(copies.values())) > 1


def test_vectors(spark, shaky):
    rows = [(i, 0, [float(i // 2 == k) for k in range(110)] + [1e-3 * (i % 2)]) for i in range(220)]
    found = embeddings.near_duplicates(files(spark, rows, "vec_id long, label long, embedding array<double>")).collect()
    assert {(x.vec_id, x.n_links, x.component_id) for x in found} == {(i, 1, i - i % 2) for i in range(220)}


def test_pages(spark, shaky):
    rows = [(i // 2, "u", f"page {i // 4}") for i in range(220)]
    pages = files(spark, rows, "page_id long, url string, html string")
    read = warc.read_archives(warc.normalise(warc.write_archives(pages, fresh_path(spark, "warc")))).collect()
    assert len(read) == 220
    assert sorted(x.payload.decode() for x in read if x.record_type == "response") == sorted({x[2] for x in rows})
