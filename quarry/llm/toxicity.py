"""Toxicity by a classifier chain (operator 1).

Categories are those of the labels table and are predicted one after another: each has a linear model over selected words
of a text and the probabilities of the categories before it. For training, those probabilities are out-of-fold, so that a
later model sees an earlier one as it will be at prediction. Features are exact 64-bit word hashes, chosen for each
category by how far its share among the training rows that hold them lies above chance.

Scale: the chain is fitted on a bounded sample of the labelled rows (``TRAIN_ROWS``, lowest by a hash of doc_id). Their
texts are read once; feature counts are a Spark aggregate, and the driver gets 48 bytes a row and the selected features
a row holds (``MAX_FEATURES`` a category at most), whatever the texts' lengths. Scoring is one map-side pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import _bytes
from quarry.llm._shared import buffers, saved

TRAIN_ROWS, MAX_FEATURES, LEAST_DOCS, LIFT, FOLDS, RIDGE = 10_000, 200, 6, 7.0, 3, 0.2
BEGINNINGS = (4, 6, 8)
#: Categories in the order of the chain: name, column of the labels table, the value that stands for the category.
CHAIN = (("low_quality", "quality", 0), ("toxic", "toxic", 1))
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def tokens(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of letters and digits, A-Z lower-cased, and where each text's begin (and the end)."""
    buf, at = _bytes.joined(texts)
    starts, ends = _bytes.runs(_ALNUM[buf])
    return _bytes.span_hashes(_bytes._LOWER[buf], starts, ends), np.searchsorted(starts, at)


def features(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each word and of its beginnings of ``BEGINNINGS`` bytes, so that other forms of a word tell as well."""
    buf, at = _bytes.joined(texts)
    low = _bytes._LOWER[buf]
    starts, ends = _bytes.runs(_ALNUM[buf])
    every = np.zeros((len(starts), 1 + len(BEGINNINGS)), np.uint64)
    known = np.ones(every.shape, bool)
    every[:, 0] = _bytes.span_hashes(low, starts, ends)
    for k, n in enumerate(BEGINNINGS, 1):
        long = np.flatnonzero(ends - starts > n)
        every[long, k] = _bytes.mix(_bytes.span_hashes(low, starts[long], starts[long] + n))
        known[:, k] = ends - starts > n
    upto = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(known.sum(axis=1), out=upto[1:])
    return every[known], upto[np.searchsorted(starts, at)]


@dataclass
class Chain:
    """words: sorted hashes; for each category its weights on words, on earlier probabilities, and its bias."""

    names: list[str]
    words: np.ndarray
    weights: list[np.ndarray]
    carry: list[np.ndarray]
    bias: list[float]

    def predict(self, rows: np.ndarray, cols: np.ndarray, n: int) -> np.ndarray:
        """Probabilities (n, categories) of texts whose distinct words are the pairs (row, column of words)."""
        out = np.zeros((n, len(self.names)))
        for k in range(len(self.names)):
            z = self.bias[k] + np.bincount(rows, self.weights[k][cols], n) + out[:, :k] @ self.carry[k]
            out[:, k] = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        return out

    def columns(self, h: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (row, column) pairs of the words of texts that the model knows."""
        if not len(self.words) or not len(h):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        hit = np.flatnonzero(self.words[at] == h)
        pair = np.unique((np.searchsorted(ptr, hit, "right") - 1) * len(self.words) + at[hit])
        return pair // len(self.words), pair % len(self.words)


def _fit(rows: np.ndarray, cols: np.ndarray, dense: np.ndarray, y: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Logistic regression with a ridge penalty by Newton steps; weights of words, of earlier probabilities, and the bias."""
    n, extra = len(y), dense.shape[1]
    x = np.zeros((n, width + extra + 1))
    x[rows, cols] = 1
    x[:, width:-1] = dense
    x[:, -1] = 1
    penalty = np.full(width + extra + 1, RIDGE)
    penalty[-1] = 1e-3
    v = np.zeros(width + extra + 1)
    v[-1] = np.log((y.sum() + 0.5) / (n - y.sum() + 0.5))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        change = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + np.diag(penalty + 1e-9), x.T @ (y - p) - penalty * v)
        v += change * min(1.0, 4 / max(np.abs(change).max(), 1e-9))
        if np.abs(change).max() < 1e-6:
            break
    return v[:width], v[width:-1], float(v[-1])


def train_chain(rows: np.ndarray, cols: np.ndarray, words: np.ndarray, labels: dict[str, np.ndarray], fold: np.ndarray) -> Chain:
    """Fit the chain in the order of ``labels`` (1, 0, or NaN where unknown).

    The texts are given by their distinct pairs (row, column of ``words``); ``fold`` deals them out. A category's model
    is fitted on the rows with its label, and rows without one carry on the probability that model gives them.
    """
    n, chain, early = len(fold), Chain(list(labels), words, [], [], []), np.zeros((len(fold), 0))

    def fitted(own: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        index, use = np.cumsum(own) - 1, own[rows]
        return _fit(index[rows[use]], cols[use], early[own], y[own], len(words))

    def said(w: np.ndarray, c: np.ndarray, b: float) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(b + np.bincount(rows, w[cols], n) + early @ c, -40, 40)))

    for y in labels.values():
        known = ~np.isnan(y)
        whole = fitted(known, y)
        held = said(*whole)
        for k in range(FOLDS):
            own, test = known & (fold != k), known & (fold == k)
            if own.any() and test.any():
                held[test] = said(*fitted(own, y))[test]
        for x, v in zip((chain.weights, chain.carry, chain.bias), whole, strict=True):
            x.append(v)
        early = np.column_stack([early, held])
    return chain


_TURN = _bytes.mix(np.arange(101, 113, dtype=np.uint64))[:, None] | np.uint64(1)


def _signature(shingles: np.ndarray) -> np.ndarray:
    """Six keys, each of two minima; texts of which more than a few tenths of the shingles agree share one, as a rule."""
    if not len(shingles):
        return np.zeros(0, np.uint64)
    low = np.full(len(_TURN), np.uint64(2**64 - 1))
    for i in range(0, len(shingles), 4096):
        low = np.minimum(low, _bytes.mix(shingles[None, i : i + 4096] * _TURN).min(axis=1))
    return _bytes.mix(low[:6] + _bytes.mix(low[6:]) + np.arange(6, dtype=np.uint64))


def _one_of_each(near: list[list[int]]) -> list[int]:
    """Rows that share no key with an earlier row, directly or through others."""
    root = list(range(len(near)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    first: dict[int, int] = {}
    for i, keys in enumerate(near):
        for k in keys:
            a, b = sorted((find(first.setdefault(k, i)), find(i)))
            root[b] = a
    return [i for i in range(len(near)) if root[i] == i]


def training_rows(docs: DataFrame, labels: DataFrame, chain=CHAIN, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, text and a 0/1 column for each category (null: unknown) of the documents that the chain learns from; a saved table.

    A document that any of its label rows puts in a category is in it; null labels say nothing. At most ``rows`` labelled
    documents, the lowest by a hash of doc_id; of rows that repeat a doc_id the least text. Of near copies the one with
    the smallest doc_id teaches, or the rare words of a text that was copied often would look like evidence.
    """
    marks = [F.max((F.col(column) == value).cast("int")).alias(name) for name, column, value in chain]
    own = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(*marks)
    own = own.where(F.coalesce(*(name for name, _, _ in chain)).isNotNull()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null").join(F.broadcast(own), "doc_id")
    texts = saved(texts.groupBy("doc_id", *(name for name, _, _ in chain)).agg(F.min("text").alias("text")), "labelled")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [_signature(x).view(np.int64) for x in _bytes.shingles(*tokens(batch.column(1).cast(pa.binary()).to_pylist()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(near, pa.list_(pa.int64()))], names=["doc_id", "near"])

    got = texts.select("doc_id", "text").mapInArrow(keys, "doc_id bigint, near array<bigint>").toArrow().sort_by("doc_id")
    ids = got.column("doc_id").to_numpy()[_one_of_each(got.column("near").to_pylist())]  # at most ``rows``
    return texts.join(F.broadcast(docs.sparkSession.createDataFrame([(int(i),) for i in ids], "doc_id bigint")), "doc_id", "left_semi")


def selected(texts: DataFrame, chain=CHAIN) -> np.ndarray:
    """Sorted hashes of the features that at least LEAST_DOCS rows hold and whose share of a category lies LIFT deviations above the mean; the best MAX_FEATURES of each category."""
    names = [name for name, _, _ in chain]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, part in buffers(list(range(batch.num_rows)), batch.column(0).cast(pa.binary()).to_pylist()):
                h, ptr = features(part)
                each = [np.unique(h[a:b]) for a, b in zip(ptr[:-1], ptr[1:], strict=True)]
                at = pa.array(np.repeat(some, [len(x) for x in each]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(each).view(np.int64)), *(batch.column(1 + k).take(at) for k in range(len(names)))], names=["feature", *names])

    sums = texts.agg(*(F.avg(x).alias(x) for x in names)).first()
    every = texts.select("text", *names).mapInArrow(run, ", ".join(["feature bigint", *(f"{x} int" for x in names)]))
    counts = saved(every.groupBy("feature").agg(*(F.count(x).alias(f"n_{x}") for x in names), *(F.sum(x).alias(f"s_{x}") for x in names)).where(F.greatest(*(F.col(f"n_{x}") for x in names)) >= LEAST_DOCS), "features")
    out = np.zeros(0, np.int64)
    for x in names:
        share = sums[x]
        if share is not None and 0 < share < 1:
            lift = (F.col(f"s_{x}") - F.col(f"n_{x}") * share) / F.sqrt(F.col(f"n_{x}") * share * (1 - share))
            best = counts.where(F.col(f"n_{x}") >= LEAST_DOCS).select("feature", lift.alias("lift")).where(F.col("lift") >= LIFT)
            out = np.union1d(out, best.orderBy(F.desc("lift"), "feature").limit(MAX_FEATURES).select("feature").toArrow().column(0).to_numpy())
    return np.sort(out.view(np.uint64))


def fit(docs: DataFrame, labels: DataFrame, chain=CHAIN) -> Chain:
    """The chain fitted on :func:`training_rows`; without a row of the last category nothing is in any."""
    names = [name for name, _, _ in chain]
    texts = training_rows(docs, labels, chain)
    if texts.where(F.col(names[-1]) == 1).isEmpty():
        k = len(names)
        return Chain(names, np.zeros(0, np.uint64), [np.zeros(0)] * k, [np.zeros(i) for i in range(k)], [-5.0] * k)
    words = selected(texts, chain)
    known = Chain(names, words, [], [], [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, part in buffers(list(range(batch.num_rows)), batch.column(1).cast(pa.binary()).to_pylist()):
                row, col = known.columns(*features(part))
                held = [col[row == i].astype(np.int32) for i in range(len(part))]
                at = pa.array(some)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), *(batch.column(2 + k).take(at) for k in range(len(names))), pa.array(held, pa.list_(pa.int32()))], names=["doc_id", *names, "held"])

    got = texts.select("doc_id", "text", *names).mapInArrow(run, ", ".join(["doc_id bigint", *(f"{x} int" for x in names), "held array<int>"])).toArrow().sort_by("doc_id")
    held = [np.array(x, np.int64) for x in got.column("held").to_pylist()]
    rows, cols = np.repeat(np.arange(len(held)), [len(x) for x in held]), np.concatenate(held)
    marks = {x: np.array([np.nan if v is None else float(v) for v in got.column(x).to_pylist()]) for x in names}
    ids = got.column("doc_id").to_numpy().astype(np.int64).view(np.uint64)
    return train_chain(rows, cols, words, marks, (_bytes.mix(ids) % np.uint64(FOLDS)).astype(np.int64))


def score(docs: DataFrame, chain: Chain, threshold: float = 0.5) -> DataFrame:
    """doc_id, p_<category> for each category of the chain, and <last category> (probability >= threshold).

    Null and empty texts have no word and get the bias alone. Rows are independent, so repeated rows get equal results;
    columns besides doc_id and text are not looked at. An empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(chain)
    names = [f"p_{x}" for x in chain.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            for some, part in buffers(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                p = own.predict(*own.columns(*features(part)), len(part))
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), *(pa.array(p[:, k]) for k in range(p.shape[1]))], names=["doc_id", *names])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = rows.mapInArrow(run, ", ".join(["doc_id bigint", *(f"{x} double" for x in names)]))
    return found.withColumn(chain.names[-1], F.col(names[-1]) >= threshold)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, chain=CHAIN) -> DataFrame:
    """Train the chain on the labelled documents and score every document; see :func:`score`. No labels: nothing is toxic."""
    return score(docs, fit(docs, labels, chain), threshold)
