"""Packing into optimal length buckets (operator 4); DataFrame functions except for the token counts and the dynamic program.

Lengths are token counts (operator 2).
Bucket boundaries minimise the padding of the whole corpus: a dynamic program over the global length histogram, which
has at most ``max_tokens`` + 1 entries. Inside a bucket, sequences form batches of at most ``budget`` padded tokens.

Scale: one partial aggregate gives the histogram; places inside a bucket come from counts per slice (a hash range of
documents and parts) and a rank within the slice, so no window ever spans a bucket.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm._shared import released, saved

MAX_TOKENS, BUCKETS, BUDGET = 2048, 8, 32_768
#: Words at which a Python worker's table of counts counts as full; it holds these, those before and a batch's.
MEMO = 100_000
_SPACE = "▁"
_WORDS = re.compile(f"(?<=[^ {_SPACE}])[ {_SPACE}]")
#: Rows of one window when places are dealt out.
SLICE_ROWS = 50_000


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null: 0. A measure of length where no tokenizer is at hand."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))


class Lengths(dict):
    """Tokens of words as the library gives them, each asked for once; a text's tokens are the sum of its words'.

    A space after another character begins a word, which no piece of the vocabulary crosses, and the library puts
    one space before what it is given.
    """

    def __init__(self, path: str):
        import sentencepiece

        super().__init__()
        self.encode = sentencepiece.SentencePieceProcessor(model_file=path).encode
        self.space = len(self.encode("a ")) - len(self.encode("a"))
        self.before: dict[str, int] = {}

    def counts(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text; the library is asked once for all words that are new.

        Words that no text has held since the table last filled up are forgotten.
        """
        parts = [self._words(t) if t else () for t in texts]
        if len(self) > MEMO:
            self.before = dict(self)
            self.clear()
        wanted = set().union(*parts).difference(self)
        old = self.before.keys() & wanted
        self.update((w, self.before[w]) for w in old)
        words = list(wanted.difference(old))
        self.update(zip(words, map(len, self.encode(words, num_threads=1)), strict=True))
        self[""] = self.space
        get = self.__getitem__
        return [sum(map(get, p)) for p in parts]

    def forget(self) -> None:
        self.before = {}
        self.clear()

    @staticmethod
    def _words(text: str) -> list[str]:
        return _WORDS.split(text) if "  " in text or text[0] == " " or _SPACE in text else text.split(" ")


@lru_cache(1)
def _lengths(path: str) -> Lengths:
    """One per Python worker."""
    return Lengths(path)


def token_lengths(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and n_tokens of every text by the vocabulary file ``path``; equal to operator 2's counts. Null and empty: 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _lengths(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own.counts(batch.column(1).to_pylist()), pa.int64())], names=["doc_id", "n_tokens"])
        own.forget()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(released(run), "doc_id bigint, n_tokens bigint")


def boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """At most ``buckets`` upper bounds, the last the greatest length, whose padding over the histogram is least.

    cost(i, j) = length[j] * (count of i..j) - tokens of i..j; the constant token sum drops out. Of equal optima the
    one with the smaller bounds is taken. An empty histogram has no bound.
    """
    order = np.argsort(lengths)
    x, n = np.asarray(lengths, np.float64)[order], np.asarray(counts, np.float64)[order]
    if not len(x):
        return []
    upto = np.r_[0.0, np.cumsum(n)]
    best = x * upto[1:]
    back = []
    for _ in range(1, min(buckets, len(x))):
        # one bucket more: the last one begins at i and ends at j
        new, at = best.copy(), np.zeros(len(x), np.int64)
        for j in range(1, len(x)):
            cost = best[:j] + x[j] * (upto[j + 1] - upto[1 : j + 1])
            i = int(np.argmin(cost))
            if cost[i] < new[j]:
                new[j], at[j] = cost[i], i + 1
        best = new
        back.append(at)
    out, j = [], len(x) - 1
    for at in reversed(back):
        out.append(int(x[j]))
        if at[j] == 0:  # fewer buckets were as good
            continue
        j = int(at[j]) - 1
    out.append(int(x[j]))
    return sorted(set(out))


def pack(docs: DataFrame, length: Column | None = None, max_tokens: int = MAX_TOKENS, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """Batches of padded sequences: doc_id, part, n_tokens, bucket, batch, slot.

    ``length`` is a document's number of tokens (see ``token_counts``); without it words are counted. A document of more
    than ``max_tokens`` becomes several parts of at most that many, numbered from 0, so no token is lost; any other
    document is one part, also an empty one (0 tokens) or one with null text. bucket is the padded length; a batch number
    counts within its bucket, and slot within the batch; batch_size * bucket <= budget unless one sequence alone is
    longer. Sequences are ordered by a hash of doc_id, part and n_tokens, then by these; rows equal in all three are
    counted, placed as one run and are sequences of their own again in the result, so neither a null nor a repeated
    doc_id makes a hot window. An empty table gives an empty result. Columns besides doc_id and the length's aren't
    looked at.
    """
    n = F.coalesce((word_count(F.col("text")) if length is None else length).cast("long"), F.lit(0).cast("long"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), n.alias("n"))
    parts = rows.select("doc_id", "n", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n") / max_tokens), F.lit(1)).cast("int") - 1)).alias("part"))
    parts = parts.select("doc_id", "part", F.least(F.col("n") - F.col("part") * F.lit(max_tokens), F.lit(max_tokens)).cast("long").alias("n_tokens"))
    same = saved(parts.groupBy("doc_id", "part", "n_tokens").agg(F.count(F.lit(1)).alias("copies")), "sequences")
    histogram = same.groupBy("n_tokens").agg(F.sum("copies").alias("n"), F.max("copies").alias("most")).collect()  # at most max_tokens + 1 rows
    bounds = boundaries([r.n_tokens for r in histogram], [r.n for r in histogram], buckets)
    total = sum(r.n for r in histogram)
    bucket = F.lit(bounds[-1] if bounds else 0)
    for b in reversed(bounds[:-1]):
        bucket = F.when(F.col("n_tokens") <= b, b).otherwise(bucket)
    slices = max(1, -(-total // SLICE_ROWS))
    key = F.xxhash64("doc_id", "part", "n_tokens")
    placed = same.withColumn("bucket", bucket.cast("long")).withColumn("key", key).withColumn("slice", F.floor((F.col("key") / F.lit(2.0**64) + 0.5) * slices).cast("int"))
    # at most buckets * slices rows: 50,000 times fewer than sequences
    before = Window.partitionBy("bucket").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offset = placed.groupBy("bucket", "slice").agg(F.sum("copies").alias("n")).select("bucket", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("bucket", "slice").orderBy("key", "doc_id", "part", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    ranked = placed.withColumn("rank", F.coalesce(F.sum("copies").over(inside), F.lit(0))).join(offset, ["bucket", "slice"]).withColumn("rank", F.col("rank") + F.col("before"))
    if max((r.most for r in histogram), default=0) > SLICE_ROWS:  # a run of so many equal sequences is written by many tasks
        ranked = ranked.withColumn("from", F.explode(F.expr(f"sequence(0, copies - 1, {SLICE_ROWS})"))).repartition(max(1, -(-total // SLICE_ROWS)))
        ranked = ranked.withColumn("rank", F.col("rank") + F.col("from")).withColumn("copies", F.least(F.col("copies") - F.col("from"), F.lit(SLICE_ROWS)))
    ranked = ranked.withColumn("rank", F.explode(F.expr("sequence(rank, rank + copies - 1)")))
    fit = F.greatest(F.floor(F.lit(budget) / F.greatest("bucket", F.lit(1))), F.lit(1))
    return ranked.select("doc_id", "part", "n_tokens", "bucket", F.floor(F.col("rank") / fit).cast("long").alias("batch"), F.pmod(F.col("rank"), fit).cast("long").alias("slot"))
