"""Shared helpers of the training-data operators: table access, staging and connected components."""

from __future__ import annotations

import re
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import prepare, scratch_path, table_path

#: ASCII white space, the only characters that separate words in every operator here.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(table_path(sf_dir, name))


def stage(df: DataFrame, name: str, partition_by: str | None = None, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to a fresh folder of the shared scratch space and return the written table.

    A later failure of an executor re-reads the table instead of recomputing it. The folder goes with the
    session (Hadoop's deleteOnExit).
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    writer = df.write.option("compression", compression)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    schema = df.schema
    if partition_by:  # partition columns come last when read again
        schema = T.StructType([f for f in schema if f.name != partition_by] + [schema[partition_by]])
    out = spark.read.schema(schema).parquet(path)
    out._staged_at = path
    for held in _recording():
        held.append(out)
    return out


_LOCAL = threading.local()


def _recording() -> list[list[DataFrame]]:
    if not hasattr(_LOCAL, "lists"):
        _LOCAL.lists = []
    return _LOCAL.lists


@contextmanager
def recorded(into: list[DataFrame] | None = None) -> Iterator[list[DataFrame]]:
    """The tables that this thread stages in the block, for ``drop``."""
    held: list[DataFrame] = [] if into is None else into
    _recording().append(held)
    try:
        yield held
    finally:
        _recording().pop()


def drop(*frames: DataFrame) -> None:
    """Delete the folders of staged tables now.

    Only for tables all of whose readers are themselves written: a lost executor's work is then read, not done again.
    """
    for df in frames:
        path = getattr(df, "_staged_at", None)
        if path:
            spark = df.sparkSession
            hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def reads_only_others(df: DataFrame, frames: list[DataFrame]) -> bool:
    """Is ``df`` read from files, none of them of one of the staged tables? (A cached table names no files.)"""
    files = df.inputFiles()
    paths = [re.sub(r"^\w+:/*", "", f._staged_at) for f in frames]
    return bool(files) and not any(p in f for f in files for p in paths)


def maybe_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """A staged table marked for broadcast if it has at most ``rows`` rows, else as it is (joined by a shuffle)."""
    return F.broadcast(df) if df.count() <= rows else df


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, though ``body`` uses it many times."""
    return F.transform(F.array(value), body)[0]


def once(value: Column) -> Column:
    """``value`` marked so that the optimizer neither copies it into later expressions nor moves filters below it."""
    return F.when(F.spark_partition_id() >= 0, value)


def text_sha(text: Column | str) -> Column:
    """SHA-256 of a text, 32 bytes; null for a null text."""
    return F.unhex(F.sha2(text, 256))


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Connected components: ``nodes(id)``, ``edges(a, b)`` -> (id, component), the smallest id reachable.

    Each round takes the smallest label among a node's neighbours (combined on the map side, so a node with
    very many links ships one row per task) and then jumps to its label's label. Rounds follow the logarithm of
    the longest path. Nodes without edges are their own component and take no part in the rounds.
    """
    both = stage(
        edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "edges",
    )
    label = stage(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("c")), "labels")
    while True:
        near = both.join(label.select(F.col("a").alias("b"), F.col("c").alias("cb")), "b").groupBy("a").agg(F.min("cb").alias("m"))
        hooked = stage(label.join(near, "a").select("a", F.least("c", "m").alias("n"), F.col("c").alias("old")), "hooked")
        jump = hooked.select(F.col("a").alias("n"), F.col("n").alias("nn"))
        after = stage(hooked.join(jump, "n").select("a", F.col("nn").alias("c"), "old"), "labels")
        done = after.where("c <> old").isEmpty() and hooked.where("n <> old").isEmpty()
        label = after.select("a", "c")
        if done:
            break
    return nodes.join(label.withColumnRenamed("a", "id"), "id", "left").select("id", F.coalesce("c", "id").alias("component"))
