"""Folders of one table whose files have changed their columns over time.

The schema of every folder is held against the wanted one before anything is
scanned, and each difference is listed. Folders of equal schema are read
together, so a table of many days costs as many scans as it has had schemas.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = ("tinyint", "smallint", "int", "bigint")
_REAL = ("float", "double")
DRIFT = "folder string, column string, change string, found string, wanted string"


def widens(found: T.DataType, wanted: T.DataType) -> bool:
    """Every value of ``found`` is one of ``wanted``."""
    a, b = found.simpleString(), wanted.simpleString()
    for kinds in (_WHOLE, _REAL):
        if a in kinds and b in kinds:
            return kinds.index(a) <= kinds.index(b)
    return a in _WHOLE[:3] and b == "double" or (a, b) in (("date", "timestamp_ntz"),) or b == "string" and a in (*_WHOLE, "boolean", "date")


def _changes(found: T.StructType, wanted: T.StructType) -> list[tuple[str, str, str | None, str | None]]:
    """(column, change, found type, wanted type); names are told apart by letter case."""
    here = {field.name: field.dataType for field in found.fields}
    asked = {field.name: field.dataType for field in wanted.fields}
    rows = []
    for name, kind in asked.items():
        if name not in here:
            rows.append((name, "missing", None, kind.simpleString()))
        elif here[name].simpleString() != kind.simpleString():
            change = "widened" if widens(here[name], kind) else "converted"
            rows.append((name, change, here[name].simpleString(), kind.simpleString()))
    return rows + [(name, "added", kind.simpleString(), None) for name, kind in here.items() if name not in asked]


def reconciled_scan(
    spark: SparkSession, folders: list[str], wanted: T.StructType, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """All rows of the folders in the wanted schema, and the drift table (folder, column, change, found, wanted).

    "missing" columns are NULL, "added" ones are left out, "widened" ones lose
    nothing; a "converted" column has another kind of type, and what cannot be
    read as the wanted one is NULL. ``strict`` raises instead of converting.
    """
    schemas: dict[str, tuple[T.StructType, list[str]]] = {}
    drift = []
    for folder in folders:
        found = spark.read.parquet(folder).schema  # footers only
        schemas.setdefault(found.json(), (found, []))[1].append(folder)
        drift += [(folder, *change) for change in _changes(found, wanted)]
    refused = sorted({f"{row[1]} ({row[3]} for {row[4]})" for row in drift if row[2] == "converted"})
    if strict and refused:
        raise ValueError(f"columns of another type: {', '.join(refused)}")

    def column(field: T.StructField, kinds: dict[str, T.DataType]) -> Column:
        if field.name not in kinds:
            return F.lit(None).cast(field.dataType).alias(field.name)
        same = kinds[field.name].simpleString() == field.dataType.simpleString()
        return (F.col(field.name) if same else F.col(field.name).try_cast(field.dataType)).alias(field.name)

    rows = spark.createDataFrame([], wanted)
    for found, members in schemas.values():
        kinds = {field.name: field.dataType for field in found.fields}
        read = spark.read.schema(found).parquet(*members)
        rows = rows.unionByName(read.select(*[column(field, kinds) for field in wanted.fields]))
    return rows, spark.createDataFrame(drift, DRIFT)


def drift_counts(drift: DataFrame) -> DataFrame:
    """How many folders show each change of a column."""
    return drift.groupBy("column", "change", "found", "wanted").agg(F.count_distinct("folder").alias("folders"))
