"""What the operators share: scratch tables, files, hot buckets and components."""

from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import suppress
from pathlib import Path
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgauge.session import configure, fresh_path, settle

__all__ = ["fresh_path", "settle"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reachable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it, and bound their batches."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)
    # Whole texts are long: fewer of them at a time in a worker.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1000)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", 16 << 20)
    return configure(spark)


def width(spark: SparkSession) -> int:
    """Partitions of a shuffle."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def open_shared(path: str, mode: str = "rb"):
    """A file in the shared folder, from a task. Local mounts, HDFS and object stores work."""
    url = urlparse(path)
    if url.scheme in ("", "file"):
        name = unquote(url.path)
        if "w" in mode:
            os.makedirs(os.path.dirname(name), exist_ok=True)
        return open(name, mode)
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path)
    if "w" in mode:
        system.create_dir(name.rpartition("/")[0], recursive=True)
        return system.open_output_stream(name)
    return system.open_input_file(name)


def release() -> None:
    """Give memory that this worker has freed back to the machine; the next stage runs in the same process."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # another C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def attempt_name(folder: str, part: int, kind: str) -> str:
    """A file no other attempt of this task writes; the manifest names the one that counts."""
    return f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.{kind}"




def groups_of(batches: Iterator[pa.RecordBatch], key: str, most: int = 200_000) -> Iterator[pa.Table]:
    """Regroup sorted batches so that no run of equal keys is cut.

    Tables hold about ``most`` rows, more only if one key does.
    """
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < most:
            continue
        whole = pa.Table.from_batches(held)
        keys = whole[key].to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(keys, keys[-1], side="left")) if keys.dtype != object else _first(keys)
        if cut:
            yield whole.slice(0, cut)
        held, count = whole.slice(cut).combine_chunks().to_batches(), whole.num_rows - cut
    if held:
        yield pa.Table.from_batches(held)


def _first(keys: np.ndarray) -> int:
    last = len(keys) - 1
    while last and keys[last - 1] == keys[-1]:
        last -= 1
    return last


def unit_rows(members: DataFrame, bucket: str, spread: Column, most: int) -> DataFrame:
    """Cut hot buckets so that every pair of members still meets exactly once.

    A bucket of at most ``most`` members is one unit. A larger one is cut by
    ``spread`` (an evenly spread non-negative long) into slices, and each pair
    of slices becomes a unit of its own: ``unit`` is its key, ``side`` 0 or 1
    the slice, and pairs are to be made inside a unit of one slice or across
    the two sides. Buckets of one member are left out.
    """
    sizes = members.groupBy(bucket).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    slices = F.ceil(F.col("_n") / most).cast("long")
    mine = F.col("_mine")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_slices") - 1))
    return (
        members.join(sizes, bucket)
        .withColumn("_slices", slices)
        .withColumn("_mine", F.pmod(spread, F.col("_slices")))
        .select("*", other.alias("_other"))
        .withColumn("side", (mine > F.col("_other")).cast("int"))
        .withColumn(
            "unit",
            F.xxhash64(bucket, F.least(mine, F.col("_other")), F.greatest(mine, F.col("_other"))),
        )
        .withColumn("one_slice", mine == F.col("_other"))
        .drop("_n", "_slices", "_mine", "_other")
    )


def smallest_root(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Component of each of ``n`` nodes under links a-b: the smallest node of it."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label = jumped
        if np.array_equal(before, label):
            return label


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a partition, replaced by links from each node to the smallest one of its local component."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    held: list[np.ndarray] = []
    count = 0

    def shrunk() -> np.ndarray:
        links = np.concatenate(held)
        nodes, at = np.unique(links, return_inverse=True)
        at = at.reshape(links.shape)
        root = smallest_root(len(nodes), at[:, 0], at[:, 1])
        mine = root != np.arange(len(nodes))
        return np.stack([nodes[mine], nodes[root[mine]]], 1)

    for batch in batches:
        held.append(np.stack([batch[0].to_numpy(), batch[1].to_numpy()], 1))
        count += batch.num_rows
        if count > 2_000_000:
            links = shrunk()
            if len(links) > 1_000_000:  # nothing more to gain here: pass it on
                yield pa.record_batch([links[:, 0], links[:, 1]], schema=schema)
                links = links[:0]
            held, count = [links], len(links)
    if count:
        links = shrunk()
        yield pa.record_batch([links[:, 0], links[:, 1]], schema=schema)


def _contracted(made: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """Links that ``made`` finds in a partition, contracted in the same worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _contract(made(batches))

    return run


def components(links: DataFrame, most_rounds: int = 60, made: Callable | None = None) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b: longs); the component is its smallest node.

    With ``made``, a function for ``mapInArrow``, ``links`` are the rows it
    makes the links from. Two such steps in a row would take two workers for
    each core, and a worker keeps its memory until the executor ends.

    Each round unites links inside every partition, then sends all links of a
    node to the smallest neighbour ("large star", then "small star"), written
    to the shared folder. Rounds grow with the logarithm of the longest path;
    no component is ever gathered in one task. A node with very many links
    sends one row per task, as the smallest neighbour is combined on the map
    side and joined back by a join that Spark may split.
    """
    spark = links.sparkSession
    schema = "a long, b long"
    rows, step = (links, _contracted(made)) if made else (links.select("a", "b").filter("a <> b"), _contract)
    links = settle(rows.mapInArrow(step, schema), "links")
    for _ in range(most_rounds):
        # Large star: what hangs on a node moves to the smallest neighbour of that node.
        low = settle(links.groupBy(F.col("a").alias("b")).agg(F.min("b").alias("m")), "low")
        large = links.join(low, "b", "left").select("a", F.coalesce("m", "b").alias("b"))
        # Small star: a node's parents and the node itself move to the smallest parent.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
        small = (
            large.join(least, "a").select(F.explode(moved).alias("x")).select("x.*").filter("a <> b").distinct()
        )
        links = settle(small, "links")
        # Done when no node has two parents and no parent has a parent.
        parents = links.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        moving = parents.filter("n > 1").select("a").limit(1).count() or (
            links.join(links.select(F.col("a").alias("b")).distinct(), "b", "left_semi").limit(1).count()
        )
        if not moving:
            roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
    raise RuntimeError("components did not settle")
