"""Scans with explicit schemas."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ErrorHandler = Callable[[str], None]


def _checked(path: str) -> str:
    if not isinstance(path, str) or not path.strip():
        raise ValueError("path must be a non-empty string")
    return path


def _or_empty(
    spark: SparkSession,
    read: Callable[[], DataFrame],
    schema: T.StructType,
    missing_ok: bool,
    on_error: ErrorHandler | None,
) -> DataFrame:
    try:
        return read()
    except (AnalysisException, ValueError) as error:
        if on_error is not None:
            on_error(str(error))
        if not missing_ok:
            raise
        return spark.createDataFrame([], schema)


def read_parquet(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    missing_ok: bool = False,
    on_error: ErrorHandler | None = None,
) -> DataFrame:
    """Parquet scan in schema order. ``missing_ok`` turns an unreadable path into no rows."""
    return _or_empty(
        spark,
        lambda: spark.read.schema(schema).parquet(_checked(path)).select(*schema.names),
        schema,
        missing_ok,
        on_error,
    )


def read_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    array_files: bool = False,
    missing_ok: bool = False,
    on_error: ErrorHandler | None = None,
) -> DataFrame:
    """JSON scan.

    Lines are the default because Spark can split them. ``array_files`` reads
    files that hold one JSON array each; such a file is one task, so land many
    of them rather than a large one.
    """
    return _or_empty(
        spark,
        lambda: spark.read.schema(schema).option("multiLine", array_files).json(_checked(path)),
        schema,
        missing_ok,
        on_error,
    )


CORRUPT = "_corrupt_record"


def read_json_checked(
    spark: SparkSession, path: str, schema: T.StructType, array_files: bool = False, files: list[str] | None = None
) -> DataFrame:
    """JSON scan that keeps what it cannot read, as text in ``_corrupt_record``, and the file each row is from.

    ``files`` names the files below ``path`` to read; default: all.
    """
    wanted = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = spark.read.schema(wanted).option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", array_files)
    found = rows.json(_checked(path)) if files is None else rows.option("basePath", _checked(path)).json(files)
    return found.select("*", F.col("_metadata.file_path").alias("source_file"))


FILES = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
])


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, modificationTime, length) of all files below ``path``; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(_checked(path))
    return files.select(*FILES.names)


def parse_json(text: Column, schema: T.StructType) -> Column:
    """One JSON object held as text; an unreadable one gives NULL fields."""
    return F.from_json(text, schema, {"mode": "PERMISSIVE"})
