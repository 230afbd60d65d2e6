"""Spelling variants of a corpus's words without pairs (operator 12).

Words are numbered in the order of falling frequency, so a group's best member is its least number. A word of L
characters belongs to L wildcard groups (position, prefix, suffix): two words of a group differ by one replacement, and
two words that do share one group only. A group keeps its size and its top two members, which is all that a member needs:
how many others there are, and the best that isn't itself. Insertions and deletions are an equi-join of the words less one
character with the words. Both give counts and least numbers, which add up per word.

Scale: one pass over the texts that counts words before it shuffles; then only the words, a row for each character. A
group has a member for each character of the alphabet at most, and a word one key for each of its characters, so nothing
grows with the square of anything. Parts of long words are keyed by digests.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm._shared import forget, released, saved, split_join

#: Runs that are words (so a wildcard group has at most 90 members: 26 lower-case letters and 64 of the range), and what is taken of them.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LEAST_LENGTH, LEAST_COUNT, DAMAGE, RATIO = 6, 5, 199, 5
#: Words that a task counts before it hands them on; characters up to which a word's parts are keys themselves.
TABLE, LONG = 100_000, 64
#: Keys in one Arrow batch.
KEYS = 50_000
_LOWER = {c: c + 32 for c in range(65, 91)}


def damaged(word: str, start: int, every: int = DAMAGE) -> str:
    """The word, less one character if the checksum that goes on from ``start`` is a multiple of ``every``."""
    h = zlib.crc32(word.encode(), start)
    if h % every:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n of the words of all whole texts with at least so many characters and occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                start, own = zlib.crc32(f"{'' if doc is None else doc}:".encode()), {}
                for m in RUN.finditer(text or ""):
                    if m.end() - m.start() >= least_length:
                        own[m.group()] = own.get(m.group(), 0) + 1
                for raw, n in own.items():
                    word = damaged(raw.translate(_LOWER) if not raw.islower() else raw, start)
                    if len(word) >= least_length:
                        counts[word] = counts.get(word, 0) + n
                if len(counts) >= TABLE:
                    yield flush()
        yield flush()

    rows = docs.select("doc_id", "text").mapInArrow(released(run), "word string, n bigint")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _digests(word: str) -> list[bytes]:
    """A digest of each prefix of a word, the empty one and the whole included."""
    state = hashlib.blake2b(digest_size=16)
    out = [state.digest()]
    for c in word:
        state.update(c.encode())
        out.append(state.copy().digest())
    return out


def _cut(word: str, mark: bytes, cuts: Iterator[tuple[int, int]]) -> Iterator[bytes]:
    """Keys of what is left of a long word when the characters from i to j are taken out; they tell i."""
    before, after = _digests(word), _digests(word[::-1])
    return (mark + before[i] + after[len(word) - j] + i.to_bytes(8, "big") for i, j in cuts)


def wildcards(word: str, long: int) -> Iterator[bytes]:
    """A key for each place whose character may be another."""
    if len(word) > long:
        return _cut(word, b"%d*" % len(word), ((i, i + 1) for i in range(len(word))))
    return ((word[:i] + "\0" + word[i + 1 :]).encode() for i in range(len(word)))


def shortened(word: str, long: int) -> Iterator[bytes]:
    """A key for each different word that is this one less a character (of equal neighbours the first)."""
    places = (i for i in range(len(word)) if not i or word[i] != word[i - 1])
    if len(word) - 1 > long:
        return _cut(word, b"%d-" % (len(word) - 1), ((i, i + 1) for i in places))
    return ((word[:i] + word[i + 1 :]).encode() for i in places)


def whole(word: str, long: int) -> Iterator[bytes]:
    """The keys by which :func:`shortened` of a longer word names this one: itself, or if it is long one for each place of the other's character."""
    if len(word) > long:
        return _cut(word, b"%d-" % len(word), ((i, i) for i in range(len(word) + 1)))
    return iter([word.encode()])


def _keys(words: DataFrame, of) -> DataFrame:
    """key, id: a row for each key ``of`` each word."""
    long = LONG

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids = [], []
        for batch in batches:
            for i, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for key in of(word, long):
                    keys.append(key)
                    ids.append(i)
                    if len(keys) >= KEYS:
                        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ids, pa.int64())], names=["key", "id"])
                        keys, ids = [], []
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ids, pa.int64())], names=["key", "id"])

    return words.select("id", "word").mapInArrow(run, "key binary, id bigint")


def _roots(links: DataFrame) -> DataFrame:
    """id, root of links (id, form): the end of the chain. Each round doubles the steps; frequencies bound the chains' lengths."""
    now = saved(links.select("id", F.col("form").alias("root")), "spelling-chains")
    while True:
        further = split_join(now, now.select(F.col("id").alias("root"), F.col("root").alias("next")), ["root"], "left")
        after = saved(further.select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-chains")
        forget(now)
        now = after.select("id", "root")
        if after.where("moved").isEmpty():
            return now


def variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``docs`` (doc_id, text).

    Words are near if one inserted, deleted or replaced character makes one the other. A word's form is its most frequent
    near word (ties: the least in code-point order) if that is ``ratio`` times as frequent, else null; root is the end
    of the chain of forms, the word itself without one.

    Null and empty texts hold no words, and a null doc_id stands as the empty string in the checksum. Repeated rows count as
    often as they occur; other columns are not looked at; words may be of any length. An empty table gives an empty result.
    """
    if ratio < 2:
        raise ValueError("a form must be more frequent than its word, or chains would have no end")
    ranked = saved(vocabulary(docs, least_length, least_count).orderBy(F.desc("n"), "word").withColumn("id", F.monotonically_increasing_id()), "spelling-words")
    group = _keys(ranked, wildcards).groupBy("key").agg(F.sort_array(F.collect_list("id")).alias("ids")).where(F.size("ids") > 1)
    member = group.select(F.explode("ids").alias("id"), (F.size("ids") - 1).cast("long").alias("near"), F.col("ids")[0].alias("top"), F.col("ids")[1].alias("next"))
    replaced = member.select("id", "near", F.when(F.col("id") == F.col("top"), F.col("next")).otherwise(F.col("top")).alias("best"))
    longer = _keys(ranked, shortened).withColumnRenamed("id", "long")
    both = longer.join(_keys(ranked, whole).withColumnRenamed("id", "short"), "key")
    changed = both.select(F.inline(F.array(F.struct(F.col("long").alias("id"), F.lit(1).cast("long").alias("near"), F.col("short").alias("best")), F.struct(F.col("short").alias("id"), F.lit(1).cast("long").alias("near"), F.col("long").alias("best")))))
    near = replaced.unionByName(changed).groupBy("id").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))
    known = ranked.join(near, "id", "left")
    other = ranked.select(F.col("id").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    with_form = split_join(known.where("best is not null"), other, ["best"]).where(F.col("form_n") >= ratio * F.col("n"))
    forms = saved(with_form.select("id", "best", "form", "form_n"), "spelling-forms")
    root = split_join(_roots(forms.select("id", F.col("best").alias("form"))), ranked.select(F.col("id").alias("root"), F.col("word").alias("root_word")), ["root"]).select("id", "root_word")
    out = known.drop("best").join(forms.drop("best"), "id", "left").join(root, "id", "left")
    return out.select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n")
