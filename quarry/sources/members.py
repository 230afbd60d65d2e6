"""Gzip shards read by members: one file in many tasks, lines across members, and their numbers in the file.

A gzip file that was appended to is a row of members, each inflatable by itself. A file is cut into byte ranges; a
range's task looks for the first member that begins in it. A place that looks like a beginning counts if it inflates to
its end with the right checksum. From there members follow each other, so the task also knows where the first one
after its range begins, and neighbours must agree on that: if they don't, as when a shard holds another gzip file stored as it
is, the file is read by one task. Lines belong to the range in which they begin; the task reads on until the last one ends.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.scratch import saved
from quarry.sources import files

#: Compressed bytes of a range, bytes that are read or inflated at once, and those that a member's first step takes, as most may be short.
RANGE, BLOCK, STEP = 64 << 20, 1 << 20, 4 << 10
#: Tasks for each core, if there are so many ranges.
TASKS = 4
_MAGIC = b"\x1f\x8b\x08"
#: The end of a range that is a whole file; in place of the next member after something that isn't one.
WHOLE, BROKEN = 1 << 62, -2


class Shard:
    """A gzip file by members."""

    def __init__(self, path: str):
        store, at = files.located(path)
        self.file, self.size = store.open_input_file(at), store.get_file_info(at).size
        self.start, self.held = 0, b""

    def read(self, at: int, n: int) -> bytes:
        """Bytes of the file, out of the block that is held if they are all there."""
        end = min(at + n, self.size)
        if at >= end:
            return b""
        if at < self.start or end > self.start + len(self.held):
            self.file.seek(at)
            self.start, self.held = at, self.file.read(min(max(n, BLOCK), self.size - at))
        return self.held[at - self.start : end - self.start]

    def member(self, at: int) -> Iterator[tuple[bytes, int]]:
        """(inflated bytes, 0) again and again, last (b"", where the next member begins); zlib.error if it is none.

        Zeros after a member are padding. A file that ends within a member is an error.
        """
        inflater, step = zlib.decompressobj(31), STEP
        while not inflater.eof:
            if not (block := self.read(at, step)):
                raise zlib.error("the file ends within a member")
            at, step = at + len(block), min(2 * step, BLOCK)
            while block and not inflater.eof:
                if data := inflater.decompress(block, BLOCK):
                    yield data, 0
                block = inflater.unconsumed_tail
        at -= len(inflater.unused_data)
        while (block := self.read(at, STEP)) and not block.strip(b"\0"):
            at += len(block)
        yield b"", at + len(block) - len(block.lstrip(b"\0"))

    def begins(self, at: int) -> bool:
        """Whether a member begins there: it inflates to its end and its checksum is right."""
        try:
            for _ in self.member(at):
                pass
        except zlib.error:
            return False
        return True

    def first(self, start: int, end: int) -> int | None:
        """Where the first member begins in [start, end)."""
        if not start:
            return 0 if self.size and end else None
        at = start
        while at < end:
            step = min(BLOCK, end - at)
            found = self.read(at, step + len(_MAGIC)).find(_MAGIC)
            if found < 0 or found >= step:
                at += step
            elif at + found < end and self.begins(at + found):
                return at + found
            else:
                at += found + 1
        return None

    def bytes_from(self, start: int) -> Iterator[tuple[bytes, int]]:
        """(inflated bytes, where the member that follows them begins) of all members from ``start`` on; the second is 0 within a member."""
        at = start
        while at < self.size:
            for data, following in self.member(at):
                if data:
                    yield data, 0
            at = following
            yield b"", at


def range_lines(path: str, start: int, end: int) -> Iterator[tuple[int, bytes] | tuple[None, int, int]]:
    """(local number from 0, line) of the lines that begin in a range, then (None, first member, next member); -1 where there is none.

    If what follows a member is none, the next member is given as BROKEN; a range that is a whole file raises zlib.error.

    A range other than a file's first leaves out what comes before its first line feed, as the range before reads on to
    it; so its lines are those that begin after its first byte, and the one that begins where it ends.
    """
    shard = Shard(path)
    first = shard.first(start, end)
    if first is None:
        yield None, -1, -1
        return
    try:
        yield from _lines(shard, first, end)
    except zlib.error:
        if end >= WHOLE:
            raise
        yield None, first, BROKEN


def _lines(shard: Shard, first: int, end: int) -> Iterator[tuple[int, bytes] | tuple[None, int, int]]:
    number, held, skipping, beyond, after = 0, [], first > 0, False, -1
    for data, following in shard.bytes_from(first):
        if following:
            if following >= end and not beyond:
                beyond, after = True, following
                if skipping:  # no line begins in this range
                    yield None, first, after
                    return
            continue
        *whole, rest = data.split(b"\n")
        for line in whole:
            if skipping:
                skipping = False
            else:
                yield number, b"".join([*held, line])
                number += 1
            held = []
            if beyond:
                yield None, first, after
                return
        held.append(rest)
    if not skipping and (last := b"".join(held)):
        yield number, last
    yield None, first, after if beyond else shard.size


def gzip_lines(spark: SparkSession, paths: list[str], range_bytes: int = RANGE) -> DataFrame:
    """(path, line_number, value) of the lines of gzip files, numbered from 1 within a file; blank lines are numbered but left out.

    Files must lie where tasks can open them (a shared folder, or a store that pyarrow knows). A line is at most as long as
    a task's memory allows; the rest is held in blocks. Bytes that are no UTF-8 become U+FFFD.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    ranges = []
    for p in paths:
        where = hadoop(p)
        size = where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).getLen()
        ranges += [(p, k, at, at + range_bytes) for k, at in enumerate(range(0, size, range_bytes))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(path: str, k: int, rows: list[tuple]) -> pa.RecordBatch:
            number, value, first, after = (list(x) for x in zip(*rows, strict=True))
            return pa.RecordBatch.from_pydict({"path": [path] * len(rows), "k": pa.array([k] * len(rows), pa.int64()), "number": pa.array(number, pa.int64()), "value": pa.array(value, pa.string()), "first": pa.array(first, pa.int64()), "after": pa.array(after, pa.int64())})

        for rows in batches:
            for path, k, start, end in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                held, size = [], 0
                for x in range_lines(path, start, end):
                    held.append((None, None, x[1], x[2]) if x[0] is None else (x[0], x[1].decode("utf-8", "replace"), None, None))
                    size += 64 + (len(x[1]) if x[0] is not None else 0)
                    if size > BLOCK:
                        yield batch(path, k, held)
                        held, size = [], 0
                if held:
                    yield batch(path, k, held)

    shape = "path string, k bigint, number bigint, value string, first bigint, after bigint"

    def read(rows: list[tuple]) -> DataFrame:
        # short ranges share tasks, as many as there would be of ranges of RANGE bytes, but enough for every core
        tasks = max(1, min(len(rows), max(TASKS * spark.sparkContext.defaultParallelism, sum(min(e - s, RANGE) for _, _, s, e in rows) // RANGE)))
        table = spark.createDataFrame(rows, "path string, k bigint, start bigint, `end` bigint").repartition(tasks, "path", "k")
        return saved(table.mapInArrow(run, shape), "gzip-lines")

    found = read(ranges)
    joints = found.where("first is not null and first >= 0").select("path", "k", "first", "after", F.lag("after").over(Window.partitionBy("path").orderBy("k")).alias("told"))
    apart = [r.path for r in joints.where(f"told <> first or after = {BROKEN}").select("path").distinct().collect()]  # files whose ranges disagree: few
    if apart:
        whole = [(p, 0, 0, WHOLE) for p in apart]
        found = found.where(~F.col("path").isin(apart)).unionByName(read(whole))
    counts = found.where("number is not null").groupBy("path", "k").agg((F.max("number") + 1).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("path").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offset = counts.select("path", "k", before.alias("before"))
    lines = found.where("trim(value) <> ''").join(offset, ["path", "k"])
    return lines.select("path", (F.col("number") + F.col("before") + 1).alias("line_number"), "value")
