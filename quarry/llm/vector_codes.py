"""Compression of vectors to codes of their parts' nearest codebook entries, with an exact bounded search (operator 13).

Components become integers, so distances are exact. A part's search starts at the entry e that it had before, at squared
distance r: an entry that is as near or nearer lies within twice that distance of e, so only the entries f with
|e - f|^2 <= 4 r can win. They are the head of e's list of entries by distance, found by the list's distances and scanned
with ties to the lower index. All vectors of a batch take each step together.

Scale: each round is one pass over the vectors, kept as a table with the codes of the round before; a task hands on one
sum for each part and entry. What the driver and each task hold of the model is the codebooks, parts x entries.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm._shared import forget, released, saved, split_join

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Labels whose sums are broadcast (16 bytes each); more are joined by a shuffle.
MOST_LABELS = 100_000


@dataclass
class Book:
    """The entries of one part, and for each of them all entries by distance (ties by index) with the squared distances."""

    entries: np.ndarray

    def __post_init__(self):
        each = self.entries[:, None, :] - self.entries[None, :, :]
        gaps = (each * each).sum(2)
        self.order = np.argsort(gaps, axis=1, kind="stable")
        # an entry itself comes first, also before its equals
        place = np.argmax(self.order == np.arange(len(gaps))[:, None], axis=1)
        for e, at in enumerate(place.tolist()):
            self.order[e, : at + 1] = np.r_[e, self.order[e, :at]]
        self.quarters = -(-np.take_along_axis(gaps, self.order, 1) // 4)  # |e - f|^2 <= 4 r exactly if this is at most r

    def nearest(self, x: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Entry and squared distance of each row of ``x``, searched from the entries ``start``; and how many distances that took."""
        def distance(rows: np.ndarray, entry: np.ndarray) -> np.ndarray:
            d = rows - self.entries[entry]
            return np.einsum("ij,ij->i", d, d)

        best, at = distance(x, start), start.copy()
        reach = (self.quarters[start] <= best[:, None]).sum(1)
        far = np.argsort(-reach, kind="stable")
        live, taken = len(far), len(x)
        for step in range(1, int(reach.max(initial=0))):
            while live and reach[far[live - 1]] <= step:
                live = int(np.searchsorted(-reach[far[:live]], -step))
            rows = far[:live]
            entry = self.order[start[rows], step]
            d = distance(x[rows], entry)
            taken += live
            better = (d < best[rows]) | ((d == best[rows]) & (entry < at[rows]))
            best[rows[better]], at[rows[better]] = d[better], entry[better]
        return at, best, taken


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label, v: the rows whose vector has only finite components, each component x as floor(scale * x)."""
    x = F.col("embedding")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", x.cast("array<double>").alias("embedding")).where(x.isNotNull() & ~bad)
    return rows.select("vec_id", "label", F.transform("embedding", lambda c: F.floor(c * scale).cast("long")).alias("v"))


def largest(size: int) -> int:
    """The largest integer component with which a vector's error surely fits a long: size * (2 * component)^2 < 2^63."""
    return math.isqrt(((1 << 63) - 1) // (4 * size))


def _books(entries: np.ndarray, parts: int) -> list[Book]:
    return [Book(part) for part in np.split(entries, parts, axis=1)]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _codes(column: pa.Array | None, n: int, parts: int) -> np.ndarray:
    """Codes of a batch as entries by row and part; zeros if there are none yet."""
    if column is None:
        return np.zeros((n, parts), np.int64)
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(n, parts).astype(np.int64)


def assigned(rows: DataFrame, entries: np.ndarray, parts: int, keep: bool) -> DataFrame:
    """vec_id, label, code (a byte for each part), error, and v if ``keep``, of rows (vec_id, label, v, maybe code: where the search starts)."""
    started = "code" in rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = _books(entries, parts)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, start = _matrix(batch.column("v")), _codes(batch.column("code") if started else None, batch.num_rows, parts)
            code, error = np.zeros((len(x), parts), np.uint8), np.zeros(len(x), np.int64)
            for k, part in enumerate(np.split(x, parts, axis=1)):
                code[:, k], d, _ = books[k].nearest(part, start[:, k])
                error += d
            own = [batch.column("vec_id"), batch.column("label"), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(error)]
            yield pa.RecordBatch.from_arrays([*own, *[batch.column("v")] * keep], names=["vec_id", "label", "code", "error", *["v"] * keep])

    kind = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(released(run), f"vec_id bigint, label {kind}, code binary, error bigint" + ", v array<bigint>" * keep)


def updated(rows: DataFrame, entries: np.ndarray, parts: int) -> np.ndarray:
    """The entries as floors of the means of what ``rows`` (v, code) have assigned to them; entries without any stay."""
    count, size = entries.shape
    width = size // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = np.zeros((parts, count, width), np.int64), np.zeros((parts, count), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, code = _matrix(batch.column("v")), _codes(batch.column("code"), batch.num_rows, parts)
            for k, part in enumerate(np.split(x, parts, axis=1)):
                np.add.at(sums[k], code[:, k], part)
                n[k] += np.bincount(code[:, k], minlength=count)
        part, entry = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(n[part, entry]), pa.array(list(sums[part, entry]), pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])

    found = rows.select("v", "code").mapInArrow(released(run), "part int, entry int, n bigint, sums array<bigint>")
    totals = found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)))
    out = entries.copy()
    for r in totals.collect():  # a row for each part and entry at most
        out[r.entry, r.part * width : (r.part + 1) * width] = [int(r[f"s{i}"]) // r.n for i in range(width)]
    return out


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error of each kept vector; the final entries, an entry a row, its parts side by side).

    Codebooks begin with the vectors of the smallest vec_ids (rows that repeat one by their components) and are fitted
    ``rounds`` times on all vectors; fewer vectors than ``entries`` give fewer. Left out are rows whose vector is null,
    empty or holds a null or non-finite component, whose length can't be cut or isn't the most frequent (ties: the
    shortest), or with a component beyond :func:`largest`, whose error might not fit a long. Rows with a null vec_id begin
    no codebook but get their code. Repeated rows count as often as they occur. An empty table gives an empty result.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has a byte for each part: 1 to 256 entries")
    kept = whole_vectors(vectors, scale)
    sizes = kept.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n")).where((F.col("size") > 0) & (F.col("size") % parts == 0))
    size = sizes.orderBy(F.desc("n"), "size").first()
    if size is None:
        return kept.select("vec_id", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error")).limit(0), np.zeros((0, parts), np.int64)
    most = largest(size[0])
    kept = kept.where((F.size("v") == size[0]) & ~F.exists("v", lambda c: (c > most) | (c < -most)))
    first = kept.where("vec_id is not null").orderBy("vec_id", "v").limit(entries).collect()  # as many rows as entries
    if not first:
        return kept.select("vec_id", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error")).limit(0), np.zeros((0, size[0]), np.int64)
    book, now = np.array([r.v for r in first], np.int64), kept
    for _ in range(rounds):
        after = saved(assigned(now, book, parts, True).drop("error"), "vector-codes")
        if now is not kept:
            forget(now)
        now, book = after, updated(after, book, parts)
    return assigned(now, book, parts, False), book


def with_label_error(codes: DataFrame) -> DataFrame:
    """``codes`` with label_error, the error summed over equal labels, nulls together (null if it doesn't fit a long)."""
    codes = saved(codes, "vector-errors")
    sums = saved(codes.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error")), "vector-labels")
    by_value = sums.select(F.coalesce(F.to_json(F.struct("label")), F.lit("")).alias("__label"), "label_error")
    rows = codes.withColumn("__label", F.coalesce(F.to_json(F.struct("label")), F.lit("")))
    if sums.count() <= MOST_LABELS:
        return rows.join(F.broadcast(by_value), "__label").drop("__label")
    return split_join(rows, by_value, ["__label"]).drop("__label")


def digest(book: np.ndarray, parts: int = PARTS) -> str:
    """SHA-256 of all entries' components in decimal by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(c) for part in np.split(book, parts, axis=1) for c in part.ravel().tolist()).encode()).hexdigest()


def restored(codes: DataFrame, book: np.ndarray, parts: int = PARTS, scale: int = SCALE) -> DataFrame:
    """``codes`` with embedding, the vector that a code stands for: its entries' components over ``scale``, and half a step, as they are floors."""
    table = F.array(*(F.array(*(F.array(*(F.lit((c + 0.5) / scale) for c in entry.tolist())) for entry in part)) for part in np.split(book, parts, axis=1)))
    entry = lambda k: F.conv(F.hex(F.substring("code", k + 1, 1)), 16, 10).cast("int")
    return codes.withColumn("embedding", F.concat(*(F.get(F.get(table, k), entry(k)) for k in range(parts))))
