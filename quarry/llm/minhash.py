"""Near-duplicate detection by min-max hashing (operator 8).

Every permutation gives two signature values, the minimum and the maximum over a document's shingles, so half the
hash evaluations fill the bands. Documents that share a band are candidates; candidates are confirmed on their full
shingle sets, and connected components of the confirmed links give the groups.

Scale: documents with equal sets collapse to one representative before banding, and buckets become stars (never pairs).
The rays of the stars are confirmed first, which is linear and joins nearly all of a large group of copies. What is left
to compare is, in buckets that this does not join, the documents outside the bucket's largest joined part with the
others there, in blocks of bounded size; a block returns a spanning forest of its links, never its pairs. Buckets with
the same members are looked at once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import _bytes
from quarry.llm._shared import buffers, components, forget, released, saved, split_join

#: Permutations for each band; each permutation gives two rows. A pair at the threshold misses all bands with probability MISS.
PERMS, MISS = 3, 5e-6
#: Documents of a cell and shingles of a block of the confirmation: a block holds one cell, or two.
CELL_DOCS, BLOCK_SHINGLES = 200, 1_000_000
#: Up to so many rows the ids of candidates and the keys of buckets are broadcast (24 bytes a row at most); beyond, they are joined by shuffle.
BROADCAST_IDS = 1_000_000

_rng = np.random.Generator(np.random.PCG64(20240229))
_MOST_BANDS = 64
_A = (_rng.integers(0, 1 << 32, _MOST_BANDS * PERMS, dtype=np.uint32) | np.uint32(1))[:, None]
_B = _rng.integers(0, 1 << 32, _MOST_BANDS * PERMS, dtype=np.uint32)[:, None]
_M = _bytes.mix(np.arange(1, 2 * PERMS + 1, dtype=np.uint64)) | np.uint64(1)
_SKETCH = "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>"


def bands_for(percent: int) -> int:
    """Bands that a pair at the threshold misses with probability ``MISS``: 26 at 85 %, 41 at 80 %, 64 at most."""
    return min(_MOST_BANDS, math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** (2 * PERMS)))) if percent < 100 else 1


def min_max(shingles: np.ndarray, bands: int) -> tuple[np.ndarray, np.ndarray]:
    """Minimum and maximum under each permutation; the set must not be empty."""
    u = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    n = bands * PERMS
    low, high = np.full(n, 0xFFFFFFFF, np.uint32), np.zeros(n, np.uint32)
    for i in range(0, len(u), 4096):
        x = _A[:n] * u[None, i : i + 4096] + _B[:n]
        np.minimum(low, x.min(axis=1), out=low)
        np.maximum(high, x.max(axis=1), out=high)
    return low, high


def band_keys(shingles: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per band from its minima and maxima."""
    low, high = min_max(shingles, bands)
    rows = np.concatenate([low.reshape(bands, PERMS), high.reshape(bands, PERMS)], axis=1).astype(np.uint64)
    return _bytes.mix((_bytes.mix(rows + np.uint64(1)) * _M).sum(axis=1, dtype=np.uint64) + np.arange(bands, dtype=np.uint64))


def _sketches(bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
            for some, part in buffers(ids, texts):
                sets = _bytes.shingles(*_bytes.words(part))
                size = [len(s) for s in sets]
                a = np.array([(_bytes.mix(s).sum(dtype=np.uint64)) for s in sets], np.uint64).view(np.int64)
                b = np.array([np.bitwise_xor.reduce(_bytes.mix(s ^ np.uint64(0x5851F42D4C957F2D))) if len(s) else 0 for s in sets], np.uint64).view(np.int64)
                keys = [band_keys(s, bands).view(np.int64) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(size, pa.int64()), pa.array(a), pa.array(b), pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "set_a", "set_b", "bands"])

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
        for some, part in buffers(ids, texts):
            sets = _bytes.shingles(*_bytes.words(part))
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["doc_id", "shingles"])


def _forest(ids: np.ndarray, sets: list[np.ndarray], side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among a block's members (side 0), or between side 0 and side 1 where both occur."""
    n = len(ids)
    size = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n), size)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.r_[True, flat[1:] != flat[:-1]]
    at = np.flatnonzero(new)
    shared = np.diff(np.r_[at, len(flat)]) > 1
    column = (np.cumsum(shared) - 1)[np.cumsum(new) - 1]
    keep = shared[np.cumsum(new) - 1]
    column, owner = column[keep], owner[keep]
    left, right = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if side.any() else (np.arange(n),) * 2
    exact = np.float32 if size.max() < 1 << 24 else np.float64  # counts up to the size of a set
    common = np.zeros((len(left), len(right)), exact)
    width = 2048
    cuts = np.searchsorted(column, np.arange(0, (column[-1] + 1 if len(column) else 0) + width, width))
    for c, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if lo == hi:
            continue
        m = np.zeros((n, width), exact)
        m[owner[lo:hi], column[lo:hi] - c * width] = 1
        rows = np.flatnonzero(m.any(axis=1))
        l, r = np.intersect1d(left, rows), np.intersect1d(right, rows)
        if len(l) and len(r):
            common[np.ix_(np.searchsorted(left, l), np.searchsorted(right, r))] += m[l] @ m[r].T
    inter = common.astype(np.int64)
    union = size[left][:, None] + size[right][None, :] - inter
    x, y = np.nonzero(100 * inter >= percent * union)
    root = list(range(n))

    def find(v: int) -> int:
        while root[v] != v:
            root[v] = root[root[v]]
            v = root[v]
        return v

    out = []
    for i, j in zip(left[x].tolist(), right[y].tolist(), strict=True):
        p, q = find(i), find(j)
        if p != q:
            root[max(p, q)] = min(p, q)
            out.append((int(ids[i]), int(ids[j])))
    return out


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """Groups of documents linked by 100 * |intersection| >= percent * |union| of their sets of distinct 5-word shingles.

    ``docs`` needs doc_id and text; other columns are not looked at. Returns one row per input row: doc_id,
    n_shingles (set size), set_id (smallest doc_id with an equal set), component_id, kept.
    Null or empty text, or text without words: n_shingles 0, linked with nothing. Fewer than five words: the whole
    sequence is the one shingle. A repeated doc_id keeps one row for each occurrence with the same component; rows
    whose doc_id is null form no link and get component_id null and kept true. An empty table gives an empty result.
    """
    sketch = saved(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(released(_sketches(bands_for(percent))), _SKETCH), "sketch")
    by_set = ["n_shingles", "set_a", "set_b"]
    some = sketch.where("n_shingles > 0 and doc_id is not null")
    classes = saved(some.groupBy(*by_set).agg(F.min("doc_id").alias("rep")), "classes")
    # the bands of a set are the same in all of its copies: any row of a representative serves
    reps = some.select("doc_id", "bands", *by_set).join(classes.select(F.col("rep").alias("doc_id"), *by_set), ["doc_id", *by_set], "left_semi").dropDuplicates(["doc_id", *by_set])
    member = saved(reps.select("doc_id", "n_shingles", F.explode("bands").alias("key")), "bands")
    pivot = saved(member.groupBy("key").agg(F.min("doc_id").alias("pivot"), F.count(F.lit(1)).alias("size")).where("size > 1"), "pivots")
    # most keys are of one document: where those of more are few, only they travel
    held = member.join(F.broadcast(pivot), "key") if pivot.count() <= BROADCAST_IDS else split_join(member, pivot, ["key"])
    bucket = saved(held.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "key", "pivot", "size"), "buckets")
    forget(member, pivot)
    rays = saved(bucket.where("id <> pivot").groupBy(F.col("id").alias("a"), F.col("pivot").alias("b")).agg(F.max("n").alias("n")), "rays")
    sets = _candidate_sets(docs, saved(bucket.select("id").distinct(), "candidates"))
    first = saved(_rays_confirmed(rays, sets, percent), "links")
    links = first.unionByName(_rest_confirmed(bucket.where("size > 2"), components(first, "joined"), sets, percent))
    comp = components(links, "groups")
    forget(bucket, rays, sets)
    found = split_join(sketch.select("doc_id", *by_set), classes, by_set, "left")
    found = split_join(found.withColumnRenamed("rep", "id"), comp, ["id"], "left")
    whole = F.coalesce("comp", "id", "doc_id")
    return found.select("doc_id", "n_shingles", F.coalesce("id", "doc_id").alias("set_id"), whole.alias("component_id"), F.coalesce(F.col("doc_id") == whole, F.lit(True)).alias("kept"))


def _candidate_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, n, shingles) of the documents ``ids``, from a second pass over the texts; rows that repeat an id with an equal set once."""
    n = ids.count()
    ids = F.broadcast(ids) if n <= BROADCAST_IDS else ids
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(ids, "id", "left_semi")
    sets = saved(texts.mapInArrow(released(_sets), "doc_id bigint, shingles array<bigint>").where("size(shingles) > 0"), "sets")
    if sets.count() > n:  # rows that repeat a doc_id
        sets = sets.dropDuplicates(["doc_id", "shingles"])
    return sets.select(F.col("doc_id").alias("id"), F.size("shingles").cast("long").alias("n"), "shingles")


def _read_block(table: pa.Table) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """ids, sets and sides of a block, each (id, side) with equal sets once."""
    shingles = table.column("shingles").combine_chunks()
    at, flat = shingles.offsets.to_numpy(), shingles.values.to_numpy().view(np.uint64)  # ascending as they were made
    return table.column("id").to_numpy(), [flat[a:b] for a, b in zip(at[:-1], at[1:], strict=True)], table.column("side").to_numpy()


def _links(found: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})


def _rays_confirmed(rays: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rays (a, b) of the stars that hold on full sets; a star is dealt out in slices that each get the pivot's set."""
    star = rays.groupBy("b").agg(F.greatest(F.ceil(F.count(F.lit(1)) / CELL_DOCS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("slices"))
    of = split_join(rays, star, ["b"]).select(F.col("a").alias("id"), F.col("b").alias("pivot"), F.pmod(F.xxhash64("a"), F.col("slices")).cast("int").alias("s"), F.lit(1).alias("side"))
    to = star.select(F.col("b").alias("id"), F.col("b").alias("pivot"), F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("s"), F.lit(0).alias("side"))
    rows = split_join(of.unionByName(to), sets.select("id", "shingles"), ["id"])

    def block(table: pa.Table) -> pa.Table:
        ids, own, side = _read_block(table)
        found = []
        for p in np.flatnonzero(side == 0):  # one, unless its doc_id is repeated
            for i in np.flatnonzero(side == 1):
                x, y = own[i], own[p]
                both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                if 100 * both >= percent * (len(x) + len(y) - both):
                    found.append((int(ids[i]), int(ids[p])))
        return _links(found)

    return rows.groupBy("pivot", "s").applyInArrow(block, "a bigint, b bigint")


def _rest_confirmed(bucket: DataFrame, joined: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) on full sets within buckets of three or more that ``joined`` (components of confirmed rays) does not make one.

    In each, the largest joined part needs no comparison within itself. Sizes of linked sets differ by less than one
    level, so a cell (level, part, slice) meets the cells of its own and the neighbouring levels alone.
    """
    step = -math.log(percent / 100) if percent < 100 else math.log(2)
    mark = F.xxhash64("id")
    once = bucket.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.bit_xor(mark).alias("x"), F.sum(mark.bitwiseAND((1 << 31) - 1)).alias("y"))
    once = once.groupBy("size", "x", "y").agg(F.min("key").alias("key")).select("key")
    part = split_join(split_join(bucket.select("id", "n", "key"), once, ["key"]), joined.withColumnRenamed("comp", "part"), ["id"], "left").withColumn("part", F.coalesce("part", "id"))
    parts = part.groupBy("key", "part").agg(F.count(F.lit(1)).alias("docs"))
    main = parts.groupBy("key").agg(F.max_by("part", F.struct("docs", "part")).alias("main"), F.count(F.lit(1)).alias("parts")).where("parts > 1").select("key", "main")
    light = split_join(part, main, ["key"])
    light = saved(light.select("id", "key", "n", F.floor(F.log("n") / step).cast("int").alias("level"), (F.col("part") != F.col("main")).cast("int").alias("stray")), "rest")
    cells = light.groupBy("key", "level", "stray").agg(F.greatest(F.ceil(F.count(F.lit(1)) / CELL_DOCS), F.ceil(F.sum("n") * 2 / BLOCK_SHINGLES)).cast("int").alias("slices"))
    cells = saved(cells, "cells")
    other = cells.select("key", F.explode(F.array(F.col("level") - 1, F.col("level"), F.col("level") + 1)).alias("level"), F.col("level").alias("to_level"), F.col("stray").alias("to_stray"), F.col("slices").alias("to_slices"))
    meets = split_join(cells, other, ["key", "level"]).where("stray + to_stray > 0")
    own = F.struct("level", "stray", F.pmod(F.xxhash64("id"), F.col("slices")).cast("int").alias("slice"))
    partner = F.struct(F.col("to_level").alias("level"), F.col("to_stray").alias("stray"), F.col("s").alias("slice"))
    place = split_join(light, meets, ["key", "level", "stray"]).withColumn("s", F.explode(F.sequence(F.lit(0), F.col("to_slices") - 1)))
    place = place.select("id", "key", own.alias("own"), partner.alias("partner"))
    place = place.select("id", "key", F.least("own", "partner").alias("one"), F.greatest("own", "partner").alias("two"), (F.col("own") > F.col("partner")).cast("int").alias("side"))
    rows = split_join(place, sets.select("id", "shingles"), ["id"])

    def block(table: pa.Table) -> pa.Table:
        return _links(_forest(*_read_block(table), percent))

    return rows.groupBy("key", "one", "two").applyInArrow(block, "a bigint, b bigint")


def deduplicate(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that are the kept one of their group; columns as in ``docs``.

    Of rows that repeat a kept doc_id all stay (they are one document to this operator); rows without doc_id stay.
    """
    drop = near_duplicates(docs, percent).where("not kept").select("doc_id").distinct()
    if (n := (drop := saved(drop, "dropped")).count()) <= BROADCAST_IDS:
        drop = F.broadcast(drop)
    return docs.join(drop, "doc_id", "left_anti") if n else docs
