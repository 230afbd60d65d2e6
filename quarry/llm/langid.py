"""Language identification by interpolated Kneser-Ney character models (operator 7).

A model per language: n-grams of orders 1 to 4 over lower-cased letters, each order a sorted array of packed keys with
the interpolated log probability. The language with the lowest cross-entropy per character wins; a threshold per
language and class of length, calibrated on all training rows by models that have not seen them, rejects texts that no
model explains.

Scale: counts are gathered from all training rows as partial sums per task and n-gram. What reaches the driver is the
distinct n-grams: 2^24 a language and fold at most by the width of a key, and in natural text some 100,000. The
calibration is a histogram that each task sums up.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm._shared import released, saved

#: Symbols of 6 bits: 0 for a run of other characters, 1-26 for a-z, further letters on 27-63 by code point.
BITS, ORDER = 6, 4
#: Halves of the training rows by a hash of the text; each is scored by models of the other. Bins a nat.
FOLDS, BINS = 2, 50
#: Classes of length by the binary logarithm of the symbols: under 8, 8 to 15, and so on, 64 or more.
CLASSES = range(2, 7)
#: The excess over a language's mean that this share of out-of-fold texts stays under is widened by SLACK.
SHARE, SLACK = 0.999, 1.5
_table: list[np.ndarray] = []


def _symbols() -> np.ndarray:
    """Symbol of each code point of the basic plane."""
    if not _table:
        t = np.zeros(65536, np.uint8)
        for i in range(65536):
            c = chr(i)
            if c.isalpha():
                low = ord(c.lower()[0])
                t[i] = low - 96 if 97 <= low <= 122 else 27 + low % 37
        _table.append(t)
    return _table[0]


def encode(text: str) -> np.ndarray:
    """Symbols of a text, with one 0 before it, between words and after it; empty if it has no letter."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    s = _symbols()[np.minimum(points, 65535)]
    if len(points) and points.max() > 65535:
        big = np.flatnonzero(points > 65535)
        s[big] = [27 + int(p) % 37 if chr(p).isalpha() else 0 for p in points[big]]
    if not s.any():
        return np.zeros(0, np.uint8)
    s = np.concatenate([np.zeros(1, np.uint8), s, np.zeros(1, np.uint8)])
    return s[np.r_[True, (s[1:] != 0) | (s[:-1] != 0)]]


def grams(s: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Packed n-grams, one for each symbol after the first, preceded by zeros."""
    x = np.concatenate([np.zeros(order - 2, np.uint8), s]).astype(np.int32)
    n = len(x) - order + 1
    key = np.zeros(max(0, n), np.int32)
    for j in range(order):
        key = (key << BITS) | x[j : j + len(key)]
    return key


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, int], list[np.ndarray]] = {}
    size: dict[tuple[str, int], int] = {}

    def out(lang: tuple[str, int]) -> pa.RecordBatch:
        key, n = np.unique(np.concatenate(held.pop(lang)), return_counts=True)
        cols = [pa.array([lang[0]] * len(key), pa.string()), pa.array([lang[1]] * len(key), pa.int32()), pa.array(key, pa.int32()), pa.array(n, pa.int64())]
        return pa.RecordBatch.from_arrays(cols, names=["lang", "fold", "key", "n"])

    for batch in batches:
        for *lang, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 1)), strict=True):
            lang = tuple(lang)
            for i in range(0, len(text), 1 << 20):  # the pieces of a long text overlap by the context of an n-gram
                s = encode(text[max(0, i - ORDER) : i + (1 << 20)] if i else text[: 1 << 20])
                g = grams(s)[ORDER if i else 0 :]
                if len(g):
                    held.setdefault(lang, []).append(g)
                    size[lang] = size.get(lang, 0) + len(g)
            if size.get(lang, 0) > 4_000_000:
                yield out(lang)
                size[lang] = 0
    for lang in list(held):
        yield out(lang)


@dataclass
class Model:
    """One language: for each order the sorted n-grams with log probabilities, and the sorted contexts with log weights."""

    keys: list[np.ndarray] = field(default_factory=list)
    logp: list[np.ndarray] = field(default_factory=list)
    contexts: list[np.ndarray] = field(default_factory=list)
    weight: list[np.ndarray] = field(default_factory=list)

    @classmethod
    def fit(cls, key: np.ndarray, n: np.ndarray, order: int = ORDER) -> Model:
        """Interpolated Kneser-Ney from the counts of the highest order; lower orders count distinct left extensions."""
        m = cls()
        levels = [(key, n.astype(np.float64))]
        for k in range(order - 1, 0, -1):
            low, seen = np.unique(levels[-1][0] & ((1 << BITS * k) - 1), return_counts=True)
            levels.append((low, seen.astype(np.float64)))
        for key, n in levels[::-1]:
            once, twice = (n == 1).sum(), (n == 2).sum()
            discount = float(np.clip(once / (once + 2 * twice), 0.1, 0.95)) if once else 0.5
            context, where = np.unique(key >> BITS, return_inverse=True)
            total, types = np.bincount(where, n), np.bincount(where)
            weight = discount * types / total
            below = np.exp(m.score(key & ((1 << BITS * len(m.keys)) - 1), len(m.keys)))
            p = (n - discount) / total[where] + weight[where] * below
            m.keys.append(key)
            m.logp.append(np.log(p).astype(np.float32))
            m.contexts.append(context)
            m.weight.append(np.log(weight).astype(np.float32))
        return m

    def score(self, key: np.ndarray, order: int | None = None) -> np.ndarray:
        """Log probability of the last symbol of each packed n-gram given the others."""
        order = len(self.keys) if order is None else order
        if order == 0:
            return np.full(len(key), -BITS * np.log(2), np.float32)
        k, p = self.keys[order - 1], self.logp[order - 1]
        at = np.minimum(np.searchsorted(k, key), len(k) - 1)
        out, miss = p[at], np.flatnonzero(k[at] != key)
        if len(miss):
            rest = key[miss]
            c, w = self.contexts[order - 1], self.weight[order - 1]
            i = np.minimum(np.searchsorted(c, rest >> BITS), len(c) - 1)
            out[miss] = np.where(c[i] == rest >> BITS, w[i], 0) + self.score(rest & ((1 << BITS * (order - 1)) - 1), order - 1)
        return out


@dataclass
class Identifier:
    """Models by language, and per language (any other: ``default``) the largest cross-entropy of each class that is not rejected.

    Without any calibration that is the one of equally likely symbols, which no model is needed for.
    """

    models: dict[str, Model]
    limits: dict[str, list[float]] = field(default_factory=dict)
    default: list[float] = field(default_factory=lambda: [BITS * float(np.log(2))] * len(CLASSES))

    def predict(self, text: str | None) -> tuple[str, float, float | None, bool]:
        """Language, score, nats per character, rejected. The score is the posterior over languages of up to 64 characters."""
        s = encode(text or "")
        if not len(s) or not self.models:
            return "und", 0.0, None, True
        key, n = np.unique(grams(s), return_counts=True)
        total = int(n.sum())
        names = list(self.models)
        cross = np.array([-float(self.models[x].score(key).astype(np.float64) @ n) / total for x in names])
        best = int(np.argmin(cross))
        score = float(1 / np.exp(-(cross - cross[best]) * min(total, 64)).sum())
        most = self.limits.get(names[best], self.default)[length_class(total)]
        return names[best], score, float(cross[best]), bool(cross[best] > most)


def length_class(total: int) -> int:
    return min(max(total.bit_length() - 1, CLASSES[0]), CLASSES[-1]) - CLASSES[0]


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _calibration(folds):
    """Histograms of out-of-fold cross-entropies by language and class: of texts that their own language explains best, and of such beginnings of them as the shorter classes hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int, int], int] = {}
        for batch in batches:
            for lang, text, fold in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                models, g = folds.value[fold], grams(encode(text))
                if not len(g) or lang not in models:
                    continue
                key, where, n = np.unique(g, return_inverse=True, return_counts=True)
                nats = {x: -m.score(key).astype(np.float64) for x, m in models.items()}
                if min(nats, key=lambda x: (nats[x] @ n, x)) != lang:
                    continue
                seen = [(length_class(len(g)), float(nats[lang] @ n) / len(g))]
                sums = np.cumsum(nats[lang][where[: 1 << CLASSES[-1]]])
                seen += [(c - CLASSES[0], float(sums[(1 << c) - 1]) / (1 << c)) for c in CLASSES[:-1] if len(g) >= 2 << c]
                for c, cross in seen:
                    at = lang, c, int(cross * BINS)
                    held[at] = held.get(at, 0) + 1
        lang, c, cross = zip(*held, strict=True) if held else ((), (), ())
        cols = [pa.array(lang, pa.string()), pa.array(c, pa.int32()), pa.array(cross, pa.int32()), pa.array(held.values(), pa.int64())]
        yield pa.RecordBatch.from_arrays(cols, names=["lang", "class", "bin", "n"])

    return run


def _limits(seen: list[tuple[str, int, int, int]], model: Identifier) -> None:
    """Limits of each class from (lang, class, bin, n): a language's own excess or that of all, whichever is more."""
    whole: dict[str, np.ndarray] = {}
    for lang, _, x, n in seen:
        whole[lang] = whole.get(lang, np.zeros(2)) + np.array([n * (x + 0.5) / BINS, n])
    mean = {x: float(t / n) for x, (t, n) in whole.items()}
    by: dict[tuple[str | None, int], list[tuple[float, int]]] = {}
    for lang, c, x, n in seen:
        for who in (lang, None):
            by.setdefault((who, c), []).append(((x + 1) / BINS - mean[lang], n))

    def excess(who: str | None, c: int) -> float | None:
        if (who, c) not in by:
            return None
        x, n = (np.array(v) for v in zip(*sorted(by[who, c]), strict=True))
        return float(x[np.searchsorted(np.cumsum(n), SHARE * n.sum())])

    def limits(who: str | None, middle: float) -> list[float]:
        # a class that nothing calibrates takes the next shorter one, else the next longer one, else equally likely symbols
        out = [max((e for e in (excess(who, c), excess(None, c)) if e is not None), default=None) for c in range(len(CLASSES))]
        for step in (range(1, len(out)), range(len(out) - 2, -1, -1)):
            for i in step:
                if out[i] is None:
                    out[i] = out[i - 1] if step.step > 0 else out[i + 1]
        return [middle + SLACK * e for e in out]

    if mean:
        model.limits = {x: limits(x, m) for x, m in mean.items()}
        model.default = limits(None, max(mean.values()))


def train(rows: DataFrame) -> Identifier:
    """Fit on all ``rows`` (doc_id, text, lang); rows with a null text or lang teach nothing. No language: everything is ``und``.

    All of them calibrate the rejection too: texts of each fold, equal ones in the same, by models of the other folds.
    """
    rows = rows.where("lang is not null and text is not null").select("lang", "text", F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int").alias("fold"))
    counts = saved(rows.mapInArrow(released(_counts), "lang string, fold int, key int, n bigint").groupBy("lang", "fold", "key").agg(F.sum("n").alias("n")), "grams")
    got = counts.toArrow()

    def fit(part: pa.Table) -> dict[str, Model]:
        models = {}
        for x in sorted(pc.unique(part.column("lang")).to_pylist()):
            own = part.filter(pc.equal(part.column("lang"), x))
            key, where = np.unique(own.column("key").to_numpy(), return_inverse=True)
            models[x] = Model.fit(key, np.bincount(where, own.column("n").to_numpy(), len(key)).astype(np.int64))
        return models

    out = Identifier(fit(got))
    folds = rows.sparkSession.sparkContext.broadcast([fit(got.filter(pc.not_equal(got.column("fold"), k))) for k in range(FOLDS)])
    seen = rows.mapInArrow(released(_calibration(folds)), "lang string, class int, bin int, n bigint").groupBy("lang", "class", "bin").agg(F.sum("n").alias("n"))
    _limits([tuple(r) for r in seen.collect()], out)
    return out


def _scored(rows: DataFrame, model: Identifier) -> DataFrame:
    """doc_id and extra as given, with lang_pred, score, nats, symbols, rejected."""
    sent = rows.sparkSession.sparkContext.broadcast(model)
    kind = rows.schema["extra"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            got = [own.predict(t) for t in texts]
            cols = [pa.array(c, k) for c, k in zip(zip(*got, strict=True) if got else [[]] * 4, (pa.string(), pa.float64(), pa.float64(), pa.bool_()), strict=True)]
            cols.insert(3, pa.array([max(0, len(encode(t or "")) - 1) if x[2] is not None else 0 for t, x in zip(texts, got, strict=True)], pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *cols], names=["doc_id", "extra", "lang_pred", "score", "nats", "symbols", "rejected"])

    return rows.select("doc_id", "text", "extra").mapInArrow(released(score), f"doc_id bigint, extra {kind}, lang_pred string, score double, nats double, symbols bigint, rejected boolean")


def identify(docs: DataFrame, model: Identifier, extra: Column | None = None) -> DataFrame:
    """Language of every row of ``docs`` (doc_id, text): doc_id, extra, lang_pred, score, nats, symbols, rejected.

    A null text or one without a letter is ``und``, with score 0, nats null and rejected true. Ties go to the language
    that sorts first. Rows are independent, so repeated rows get equal results; other columns are not looked at.
    """
    extra = F.lit(False) if extra is None else extra
    return _scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", extra.alias("extra")), model)


def keep_identified(docs: DataFrame, model: Identifier) -> DataFrame:
    """The rows of ``docs`` whose text isn't rejected; columns as in ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            texts = batch.column(names.index("text")).to_pylist()
            yield batch.filter(pa.array([not own.predict(t)[3] for t in texts], pa.bool_()))

    return docs.mapInArrow(released(keep), docs.schema)


__all__ = ["Identifier", "Model", "held_out", "identify", "keep_identified", "train"]
