"""Spark helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.scratch import bounded_batches, forget, saved, shared_dir, split_join, tidy

__all__ = ["bounded_batches", "buffers", "components", "forget", "released", "saved", "shared_dir", "split_join", "table", "tidy"]

#: Bytes of text that a Python worker handles as one numpy buffer.
BUFFER_BYTES = 1 << 20


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow, after which a worker, which lives on for later tasks, gives freed memory back to the system."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)

    return wrapped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def buffers(ids: list, texts: list, limit: int = BUFFER_BYTES):
    """Cut one Arrow batch into runs of rows of at most ``limit`` bytes (a longer text is a run of its own)."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and size + n > limit:
            yield ids[start:i], texts[start:i]
            start, size = i, 0
        size += n
    if start < len(texts):
        yield ids[start:], texts[start:]


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of ``edges`` (a, b: bigint): one row (id, comp) per node, comp its smallest node.

    Alternates the large-star and small-star steps until the edges stay the same; each step is a partial
    minimum per node and one equi-join, so a node with a great many edges is never gathered into one task.
    Loops and repeated edges are ignored; an empty input gives an empty result.
    """

    def lowest(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))

    now = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    state = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = split_join(both, lowest(both), ["a"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        small = split_join(large, lowest(large), ["a"]).select("a", "b", "m")
        step = small.select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        after = saved(step.select("e.a", "e.b").where("a <> b").distinct(), name)
        seen = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        forget(now)
        now = after
        if tuple(seen) == state:
            break
        state = tuple(seen)
    nodes = now.select(F.col("a").alias("id"), F.col("b").alias("comp"))
    return nodes.unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("comp")).distinct())
