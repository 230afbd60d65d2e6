"""The first row of each id over all runs, with the tags that later ones add, as state that expires."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

#: The state store that holds more than memory does; no batches without data, of which a run until now would have no end.
_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


class FirstWins(StatefulProcessor):
    """Keeps an id's first row and its tags; gives a row when the id is new or a tag is."""

    def __init__(self, key: str, columns: list[str], kept: StructType, order: list[str], ttl: int | None):
        self.key, self.columns, self.kept, self.order, self.ttl = key, columns, kept, order, ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first", self.kept, self.ttl)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        old = self.first.get() if self.first.exists() else None
        row, tags = (None, set()) if old is None else (list(old[:-1]), set(old[-1]))
        own, before = None, len(tags)
        for part in rows:  # pieces of the id's rows of this batch, in any order
            for x in part[[*self.order, *self.columns, "tags"]].itertuples(index=False):
                tags.update(t for t in (x[-1] if x[-1] is not None else ()) if t is not None)
                at, values = tuple(x[: len(self.order)]), list(x[len(self.order) : -1])
                if row is None and (own is None or at < own[0]):
                    own = at, values
        if row is None or len(tags) > before:
            row = own[1] if row is None else row
            row = [None if x is pd.NaT or (isinstance(x, float) and x != x) else x.item() if hasattr(x, "item") else x for x in row]
            self.first.update((*row, sorted(tags)))
            yield pd.DataFrame([[key[0], *row, sorted(tags)]], columns=[self.key, *self.columns, "tags"], dtype=object)

    def close(self) -> None:
        pass


def first_wins(rows: DataFrame, key: str, order: list[str], ttl: int | None = None) -> DataFrame:
    """Updates of a stream of rows (``key``, ``order``, others, tags): an id's first row by ``order`` of the first batch that holds it, and all its tags so far.

    An update comes when the id is new or a tag is. ``ttl`` is the time in milliseconds after which an id that brought
    nothing new is forgotten, which bounds the state by the ids of that time; None: never. A row without a key is left
    out; columns of ``order`` must not be null. Columns besides these come from the first row.
    """
    columns = [c for c in rows.columns if c not in (key, "tags")]
    kept = StructType([rows.schema[c] for c in columns] + [rows.schema["tags"]])
    out = StructType([rows.schema[key], *kept.fields])
    own = FirstWins(key, columns, kept, order, ttl)
    return rows.where(F.col(key).isNotNull()).groupBy(key).transformWithStateInPandas(own, out, "Update", "None" if ttl is None else "ProcessingTime")


@contextlib.contextmanager
def _settings(spark: SparkSession):
    """``_SETTINGS`` for queries that start within, the caller's after."""
    old = {k: spark.conf.get(k, None) for k in _SETTINGS}
    for k, v in _SETTINGS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def collect(spark: SparkSession, source: str, schema: str, key: str, order: list[str], checkpoint: str, target: str, ttl: int | None = None, fmt: str = "json") -> None:
    """Bring ``target`` up to date with the files under ``source`` that have come since the last call.

    Each batch's updates are a folder of their own, which a batch that is run again writes anew; so no row is lost or there
    twice. Read them by :func:`current`.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    rows = spark.readStream.schema(schema).format(fmt).load(source)
    with _settings(spark):
        query = first_wins(rows, key, order, ttl).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()


def current(spark: SparkSession, target: str, key: str) -> DataFrame:
    """The last update of each id; if an id was forgotten and came again, its row since then."""
    updates = spark.read.option("basePath", target).parquet(f"{target}/batch=*")
    last = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("batch")))
    return updates.withColumn("__last", last).where("__last = 1").drop("__last", "batch")
