"""Services that hand out rows page by page behind a cursor, as a data source by format name: batch and stream.

A search is cut into queries (term chunks); each is a partition, as its pages come one after the other while those of others
don't wait. Rows go from the service to the tasks, never through the driver. As a stream, a micro-batch is one epoch:
every query that isn't at its end is read on by ``flush`` pages; once there have been more epochs than a few, it is as many as make
a quarter of those before, so the number of micro-batches grows with the logarithm of the pages, and what one that breaks off
repeats is at most a fifth of all. An offset is the number of an epoch; where a query stood
after it is a small file of the ledger, written by the task that read it. A micro-batch that is run again, after a lost task
or a restart, begins at the ledger's file of the epoch before and ends where its own file says, so its rows are the same.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from quarry.sources import files

#: Cursor of a query's first page (a fixed value of such services).
START = "*"
#: Rows of a page, pages of an epoch, and attempts for a page.
ROWS, FLUSH, ATTEMPTS = 500, 50, 10
#: A micro-batch has one epoch for so many epochs before it, at least one.
GROWTH = 4

#: client(query, cursor, rows, fields) -> (rows as dicts, next cursor); the same cursor or no rows: the end.
Client = Callable[[str, str, int, list[str]], tuple[list[dict], str]]


@dataclass
class Settings:
    """What a reader needs; goes to the tasks."""

    client: Client
    queries: list[str]
    fields: list[str]
    rows: int = ROWS
    flush: int = FLUSH
    attempts: int = ATTEMPTS
    ledger: str | None = None
    pause: Callable[[float], None] = field(default=time.sleep)

    def page(self, query: str, cursor: str) -> tuple[list[dict], str]:
        """A page; a failed request is made again after 5, 10, 15 ... seconds, the last failure is raised."""
        for k in range(1, self.attempts):
            try:
                return self.client(query, cursor, self.rows, self.fields)
            except Exception:
                self.pause(5.0 * k)
        return self.client(query, cursor, self.rows, self.fields)

    def walk(self, query: str, cursor: str, ends: Callable[[str, int], bool]) -> Iterator[tuple[list[dict], str, bool]]:
        """(rows, cursor after them, whether that is the end) of each page from ``cursor`` on, until ``ends`` says so of cursor and pages."""
        pages = 0
        while True:
            rows, after = self.page(query, cursor)
            done, pages = not rows or after == cursor, pages + 1
            cursor = cursor if done else after
            yield rows, cursor, done
            if done or ends(cursor, pages):
                return


@dataclass
class Chunk(InputPartition):
    """A query to read from a cursor on; in a stream, as part of the epochs after ``start`` up to ``end``."""

    index: int
    cursor: str = START
    start: int = 0
    end: int = 0


class _Pages(DataSourceReader):
    def __init__(self, own: Settings):
        self.own = own

    def partitions(self) -> list[Chunk]:
        return [Chunk(i) for i in range(len(self.own.queries))]

    def read(self, partition: Chunk) -> Iterator[tuple]:
        for rows, _, _ in self.own.walk(self.own.queries[partition.index], partition.cursor, lambda cursor, pages: False):
            yield from (tuple(r.get(c) for c in self.own.fields) for r in rows)


class _Epochs(DataSourceStreamReader):
    def __init__(self, own: Settings):
        self.own = own

    def place(self, epoch: int, index: int) -> str:
        return f"{self.own.ledger}/{epoch:08d}/{index:06d}.json"

    def entry(self, epoch: int, index: int) -> dict | None:
        """Where a query stood after an epoch: its cursor, and whether that was the end; None if it isn't known yet."""
        if not epoch:
            return {"cursor": START, "done": False}
        found = files.get(self.place(epoch, index))
        return None if found is None else json.loads(found)

    def initialOffset(self) -> dict:
        return {"epoch": 0}

    def latestOffset(self) -> dict:
        """The end of the micro-batch after the last epoch that all queries have read; that epoch itself if all are at their end."""
        every = range(len(self.own.queries))
        for name in reversed(files.names(self.own.ledger)):
            found = [self.entry(int(name), i) for i in every]
            if None not in found:
                last = int(name)
                return {"epoch": last if all(x["done"] for x in found) else last + max(1, last // GROWTH)}
        return {"epoch": 1 if self.own.queries else 0}

    def partitions(self, start: dict, end: dict) -> list[Chunk]:
        a, b = start["epoch"], end["epoch"]
        if a == b:
            return []
        out = []
        for i in range(len(self.own.queries)):
            if (before := self.entry(a, i)) is None:
                raise ValueError(f"the ledger {self.own.ledger} doesn't belong to this checkpoint: it lacks epoch {a}")
            out.append(Chunk(i, before["cursor"] if not before["done"] else "", a, b))
        return out

    def read(self, partition: Chunk) -> Iterator[tuple]:
        i, own = partition.index, self.own
        known = self.entry(partition.end, i)
        cursor, done = partition.cursor, not partition.cursor  # a query at its end has nothing more to read
        most = own.flush * (partition.end - partition.start)
        if not done:
            stop = (lambda at, pages: pages >= most) if known is None else (lambda at, pages: not known["done"] and at == known["cursor"])
            for rows, cursor, done in own.walk(own.queries[i], cursor, stop):  # noqa: B007
                yield from (tuple(r.get(c) for c in own.fields) for r in rows)
        if known is None:
            cursor = cursor or (self.entry(partition.start, i) or {}).get("cursor", START)
            files.put(self.place(partition.end, i), json.dumps({"cursor": cursor, "done": done}).encode())

    def commit(self, end: dict) -> None:
        """Epochs before ``end`` won't be asked for again."""
        for name in files.names(self.own.ledger):
            if int(name) < end["epoch"]:
                files.remove(f"{self.own.ledger}/{name}")


def register(spark: SparkSession, name: str, client: Client, queries: list[str], schema: str, **settings) -> None:
    """Make ``spark.read.format(name)`` and ``spark.readStream.format(name)`` read the rows of all queries.

    ``schema`` names the fields that the client is asked for; a row that lacks one has null there (for ids alone, name the id
    alone). Rows that several queries find come several times. ``settings`` are those of :class:`Settings`; a stream needs
    ``ledger``, a folder that driver and tasks share, of its own for each checkpoint. The client goes to the tasks.
    """
    own = Settings(client, list(queries), StructType.fromDDL(schema).names, **settings)

    class Cursor(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def reader(self, schema: StructType) -> DataSourceReader:
            return _Pages(own)

        def streamReader(self, schema: StructType) -> DataSourceStreamReader:
            if not own.ledger:
                raise ValueError("a stream of a cursor service needs a ledger")
            return _Epochs(own)

    spark.dataSource.register(Cursor)


def collect(spark: SparkSession, name: str, target: str, checkpoint: str, key: str) -> DataFrame:
    """All rows of a registered cursor service, the first of each ``key``, appended to ``target``; goes on where ``checkpoint`` stands.

    Rows without a key are left out. A run that fails or is killed is called again; each row comes once. Calling it after the
    end asks the service for nothing.
    """
    rows = spark.readStream.format(name).load()
    once = rows.where(f"`{key}` is not null").dropDuplicates([key])
    query = once.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return spark.read.schema(rows.schema).parquet(target)
