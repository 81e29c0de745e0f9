"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    # Weekday, hour and month of an instant must not depend on the machine.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Streaming state outgrows the heap of an executor.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # A trigger uploads what it changed, not the whole state.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the analyses rely on to a running session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "reelgauge", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def scratch_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables and streaming checkpoints.

    It is below the folder ``spark.checkpoint.dir`` names, which every executor
    can reach. A local master that names none has it below its warehouse.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return f"{shared.rstrip('/')}/reelgauge/{spark.conf.get('spark.app.id', 'app')}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables, once all results that read them are written."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Give a folder another place in the same file system."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = place(target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(place(target).getParent())
    if not files.rename(place(source), place(target)):
        raise OSError(f"cannot move {source} to {target}")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


#: Since Spark 4.1; earlier releases take no notice of it.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write inside are deleted when it has ended.

    Otherwise they stay until the driver happens to collect its garbage, so
    that the files of all steps of a long job may lie on the disks at once.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the scratch folder and read it back.

    Meant for results that are small and used more than once, such as one row
    of thresholds per niche. The lineage ends at the files, so losing an
    executor costs nothing, and the file size gives Catalyst an exact figure to
    choose between a broadcast and a shuffled join. The write is a job: an
    analysis that settles runs jobs when it is called, not only at its action.
    What the job has shuffled is deleted after it.
    """
    path = fresh_path(df.sparkSession, label)
    with released(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
