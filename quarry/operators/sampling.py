"""Samples of strata with their sizes from one scan, by a partial aggregate that merges in any order.

A row's place in its stratum is given by the digest of seed and id, so a sample is the same at every run, on any cluster.
The aggregate of a set of rows is, per stratum, how many there are and the n lowest by (digest, id). Each task makes it of
its own rows, then groups of tasks are merged, then these; only ids and digests move. Texts are fetched afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.scratch import saved, split_join

#: Groups of tasks that are merged at first; ids that are broadcast to fetch their rows.
MERGERS, MOST_IDS = 64, 100_000


def merged(table: pa.Table, n: int) -> pa.Table:
    """The aggregate of rows or aggregates (stratum, digest, id, seen): the n lowest of each stratum, all of its ``seen`` with the first."""
    table = table.sort_by([("stratum", "ascending"), ("digest", "ascending"), ("id", "ascending")])
    if not len(table):
        return table
    code = table.column("stratum").combine_chunks().dictionary_encode().indices.to_numpy()
    first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    rank = np.arange(len(code)) - np.repeat(first, np.diff(np.r_[first, len(code)]))
    seen = np.zeros(len(code), np.int64)
    seen[first] = np.add.reduceat(table.column("seen").to_numpy(), first)
    keep = rank < n
    return table.drop_columns(["seen"]).append_column("seen", pa.array(seen)).filter(pa.array(keep))


def stratified(docs: DataFrame, stratum: str, id_col: str, n: int, seed: int) -> DataFrame:
    """stratum, id, rank (from 1), seen: ``n`` rows of each stratum, fewer if it has fewer, and how many rows it has.

    Nulls are a stratum of their own, given as null. Rows that repeat an id count, and are drawn, each for itself; a null id
    is drawn last of equals. An empty table gives an empty result.
    """
    kind, label = docs.schema[id_col].dataType.simpleString(), F.col(stratum).cast("string")
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))
    light = docs.select(F.coalesce(F.concat(F.lit("="), label), F.lit("")).alias("stratum"), digest.alias("digest"), F.col(id_col).alias("id"), F.lit(1).cast("long").alias("seen"))
    shape = f"stratum string, digest string, id {kind}, seen bigint"

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table.cast(pa.schema([f.with_nullable(True) for f in table.schema]))  # as what is held
            held = merged(table if held is None else pa.concat_tables([held, table]), n)
        if held is not None:
            yield from held.combine_chunks().to_batches()

    parts = light.mapInArrow(partial, shape).withColumn("merger", F.pmod(F.xxhash64("digest"), F.lit(MERGERS)))
    fewer = parts.groupBy("stratum", "merger").applyInArrow(lambda t: merged(t.select(["stratum", "digest", "id", "seen"]), n), shape)

    def final(table: pa.Table) -> pa.Table:
        table = merged(table, n)
        total = table.column("seen").to_pylist()[0]
        return pa.table({"stratum": table.column("stratum"), "id": table.column("id"), "rank": pa.array(range(1, len(table) + 1), pa.int32()), "seen": pa.array([total] * len(table), pa.int64())})

    out = fewer.groupBy("stratum").applyInArrow(final, f"stratum string, id {kind}, rank int, seen bigint")
    return out.withColumn("stratum", F.when(F.col("stratum") != "", F.expr("substring(stratum, 2)")))


def rows_of(docs: DataFrame, sample: DataFrame, id_col: str) -> DataFrame:
    """The rows of ``docs`` whose id a sample holds, with stratum, rank and seen; of a repeated id, each row with each of its places."""
    sample = saved(sample.withColumnRenamed("id", id_col), "sample")
    if sample.count() <= MOST_IDS:
        return docs.join(F.broadcast(sample), id_col)
    return split_join(docs, sample, [id_col])
