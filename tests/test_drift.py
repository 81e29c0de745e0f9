import pytest
from pyspark.sql import types as T

from reelgauge.sources import drift

WANTED = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("views", T.LongType()), T.StructField("rate", T.DoubleType()),
])


@pytest.fixture
def folders(spark, tmp_path):
    tables = {
        "a": ([("a1", 2**40, 0.5)], "id string, views long, rate double"),
        "b": ([("b1", 7)], "id string, views int"),
        "c": ([(3, "12", 1.5, "x"), (4, "many", None, "y")], "id int, views string, rate float, note string"),
        "d": ([("d1", 1)], "id string, views int"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / name))
    return [str(tmp_path / name) for name in tables]


def test_rows_and_drift_table(spark, folders):
    rows, found = drift.reconciled_scan(spark, folders, WANTED)
    assert rows.schema.simpleString() == WANTED.simpleString()
    assert sorted(map(tuple, rows.collect())) == [
        ("3", 12, 1.5), ("4", None, None), ("a1", 2**40, 0.5), ("b1", 7, None), ("d1", 1, None),
    ]
    listed = sorted(((x.folder[-1], x.column, x.change, x.found, x.wanted) for x in found.collect()), key=str)
    assert listed == [
        ("b", "rate", "missing", None, "double"), ("b", "views", "widened", "int", "bigint"),
        ("c", "id", "widened", "int", "string"), ("c", "note", "added", "string", None),
        ("c", "rate", "widened", "float", "double"), ("c", "views", "converted", "string", "bigint"),
        ("d", "rate", "missing", None, "double"), ("d", "views", "widened", "int", "bigint"),
    ]
    counts = {(x.column, x.change): x.folders for x in drift.drift_counts(found).collect()}
    assert counts["views", "widened"] == 2 and counts["note", "added"] == 1


def test_strict_refuses_other_types(spark, folders):
    with pytest.raises(ValueError, match=r"views \(string for bigint\)"):
        drift.reconciled_scan(spark, folders, WANTED, strict=True)
    assert drift.reconciled_scan(spark, folders[:2], WANTED, strict=True)[0].count() == 2


def test_equal_schemas_are_read_together(spark, folders):
    rows, _ = drift.reconciled_scan(spark, [folders[1], folders[3]], WANTED)
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert drift.reconciled_scan(spark, [], WANTED)[0].collect() == []
