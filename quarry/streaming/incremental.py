"""Each shard once: a file stream with a checkpoint in place of hand-kept progress files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def process_new(spark: SparkSession, source: str, schema: str, checkpoint: str, handle: Callable[[DataFrame, int], None], fmt: str = "json") -> None:
    """Run ``handle(rows, batch)`` over the files that arrived since the last call; a batch that fails is tried again next time."""
    rows = spark.readStream.schema(schema).format(fmt).load(source)
    rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def new_ids(spark: SparkSession, source: str, schema: str, checkpoint: str, target: str, key: str, fmt: str = "json") -> None:
    """Append the first row of each key, over all runs, to ``target``. The state grows with the keys; give a watermark to bound it."""
    rows = spark.readStream.schema(schema).format(fmt).load(source).dropDuplicates([key])
    rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
