"""Benchmark decontamination by template canonicalisation (operator 5).

Texts become sequences of template tokens: numbers, units after a number and names turn into typed placeholders (a run
of names becomes one), other tokens are lower-cased. Windows of five template tokens of documents and benchmark items are hash-joined. A document
holds an item if at least 80 % of the item's windows occur in it and the slots agree: within one placement of the item
a benchmark value always stands for one value of the document, as in a question with changed parameters. Items of few
tokens or without a window that says something are looked up by their whole token sequence, as it is and as a template.

Scale: one pass over the documents tests windows against a bitmap of fixed size built from the benchmark (2 MB however
large that is), so only likely hits are shuffled. A document that covers 80 % of an item's windows holds one of the
item's rarest fifth and one more, so only these are joined by window, and a window that many documents and items share
doesn't multiply them; coverage and slots follow on the pairs found.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import _bytes
from quarry.llm._shared import buffers, released, saved, split_join

WINDOW, COVERAGE, AGREEMENT = 5, 0.8, 0.8
#: Template tokens of a window that must be words, not placeholders; a window of placeholders alone says nothing.
LITERALS = 2
#: Items of fewer tokens are looked up whole too: one lost window would put them below COVERAGE.
SHORT = 10
FILTER_BITS = 24
UNITS = "mm cm m km in ft yd mi mg g kg lb lbs oz t ml cl l s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month months year years hz khz mhz ghz kb mb gb tb v w kw kwh j kj a k c f mph kmh usd eur gbp dollar dollars euro euros pound pounds cent cents percent degrees degree meter meters metre metres kilometer kilometers kilogram kilograms gram grams liter liters litre litres mile miles inch inches foot feet"

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:;\n\r\"|"]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[9, 11, 12, 32]] = True
_unit = _bytes.joined([u.encode() for u in UNITS.split()])
_UNIT_HASHES = np.unique(_bytes.span_hashes(_unit[0], _unit[1][:-1], _unit[1][1:] - 1))
_NUMBER, _UNIT, _NAME = (np.uint64(x) for x in (0x1F1F1F1F01, 0x1F1F1F1F02, 0x1F1F1F1F03))


class Tokens(NamedTuple):
    """Template hash and kind (0 word, 1 number, 2 unit, 3 name) of each token, its own hash, where each text's tokens begin, and which words would be names within a sentence."""

    shape: np.ndarray
    kind: np.ndarray
    own: np.ndarray
    ptr: np.ndarray
    proper: np.ndarray

    def rolled(self) -> tuple[np.ndarray, np.ndarray]:
        return _rolled(self.shape)


def templates(texts: list[bytes | None], named_first: bool = False) -> tuple[Tokens, np.ndarray, np.ndarray]:
    """The template of each text; and, before runs of names were joined, the hashes of its words and where they begin.

    With ``named_first`` a text's first word is a name if it is capitalised: what it is in the middle of a sentence.
    """
    buf, at = _bytes.joined(texts)
    word = _WORD[buf]
    digit = _DIGIT[buf]
    dot = np.flatnonzero((buf == 46) | (buf == 44))
    dot = dot[(dot > 0) & (dot < len(buf) - 1)]
    dot = dot[digit[dot - 1] & digit[dot + 1]]
    word[dot] = True
    starts, ends = _bytes.runs(word)
    if not len(starts):
        none, ptr = np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
        return Tokens(none, none.astype(np.int8), none, ptr, none.astype(bool)), none, ptr
    digit[dot] = True
    low = _bytes._LOWER[buf]
    latin = np.flatnonzero((buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E)) + 1
    low[latin] += 32
    own = _bytes.span_hashes(low, starts, ends)
    upper = _UPPER[buf]
    upper[latin] = True
    uppers = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(upper, out=uppers[1:])
    digits = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(digit, out=digits[1:])
    number = digits[ends] - digits[starts] == ends - starts
    capital = upper[starts] | ((buf[starts] == 0xC3) & upper[np.minimum(starts + 1, len(buf) - 1)])
    capital &= (uppers[ends] - uppers[starts] == 1) & (ends - starts > 1)
    # the last byte before a token that isn't blank; a text's start counts as a stop
    solid = np.where(_BLANK[buf], -1, np.arange(len(buf)))
    np.maximum.accumulate(solid, out=solid)
    before = np.where(starts > 0, solid[np.maximum(starts - 1, 0)], -1)
    first = at[np.searchsorted(at, starts, "right") - 1]
    initial = ((before < first) & (not named_first)) | ((before >= first) & _STOP[buf[np.maximum(before, 0)]])
    kind = np.zeros(len(starts), np.int8)
    kind[capital & ~initial] = 3
    kind[number] = 1
    after = np.flatnonzero(number[:-1]) + 1
    after = after[(starts[after] >= first[after]) & (first[after] == first[after - 1]) & (kind[after] != 1)]
    kind[after[np.isin(own[after], _UNIT_HASHES)]] = 2
    words, words_ptr = own, np.searchsorted(starts, at)
    # a run of names, with nothing but blanks between them, is one name: its slot is the hash of all of them
    name = kind == 3
    goes_on = np.zeros(len(starts), bool)
    goes_on[1:] = name[1:] & name[:-1] & (first[1:] == first[:-1]) & (before[1:] == ends[:-1] - 1)
    keep = np.flatnonzero(~goes_on)
    if len(keep) < len(starts):
        run = np.cumsum(~goes_on) - 1
        place = np.arange(len(starts)) - keep[run]
        joined = np.zeros(len(keep), np.uint64)
        np.add.at(joined, run, own * _bytes._power(int(place.max()))[0][place])
        many = np.bincount(run) > 1
        own = np.where(many, _bytes.mix(joined), own[keep])
        starts, kind, capital = starts[keep], kind[keep], capital[keep]
    shape = np.choose(kind, [own, _NUMBER, _UNIT, _NAME])
    return Tokens(shape, kind, own, np.searchsorted(starts, at), capital & (kind == 0)), words, words_ptr


def _rolled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a polynomial of the hashes, and the inverse powers that shift a difference to its start."""
    up, down = _bytes._power(len(x))
    sums = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x * up[: len(x)], out=sums[1:])
    return sums, down


def _whole(rolled: tuple[np.ndarray, np.ndarray], starts: np.ndarray, length: int, salt: int) -> np.ndarray:
    """Hash of the ``length`` tokens at each start."""
    sums, down = rolled
    return _bytes.mix(_bytes.mix((sums[starts + length] - sums[starts]) * down[starts]) + np.uint64(2 * length + salt))


def _window(shape: np.ndarray, at: np.ndarray) -> np.ndarray:
    h = np.zeros(len(at), np.uint64)
    for j in range(WINDOW):
        h += shape[at + j] * _bytes._GRAM[j]
    return _bytes.mix(h)


def _starts(ptr: np.ndarray, length: int) -> np.ndarray:
    """Every place where ``length`` tokens of one text begin."""
    at = np.arange(max(0, int(ptr[-1]) - length + 1))
    return at[at + length <= ptr[np.searchsorted(ptr, at, "right")]]


def _says(t: Tokens, at: np.ndarray, length: int) -> np.ndarray:
    """Those of the starts whose ``length`` tokens hold LITERALS words."""
    literal = np.zeros(len(t.kind) + 1, np.int64)
    np.cumsum(t.kind == 0, out=literal[1:])
    return at[literal[at + length] - literal[at] >= LITERALS]


def _windows(texts: list[bytes | None], keep: np.ndarray | None, lengths: list[int] | None = None) -> tuple[np.ndarray, ...]:
    """Text, position, hash, slots' own hashes and kind of lookup of each hit.

    Kind 0 is a window with enough words, 1 a whole sequence as a template, 2 one as it is. With ``keep`` the texts are
    documents: what the filter lets pass, whole sequences of ``lengths``. Without, they are items: what begins with the
    item's first word comes a second time with that word as a name, if it is capitalised; the sixth column is the hash
    of the first form, and the number of tokens follows.
    """
    t, plain, plain_ptr = templates(texts)
    out: list[tuple[np.ndarray, ...]] = []

    def add(t: Tokens | None, ptr: np.ndarray, at: np.ndarray, h: np.ndarray, length: int, sort: int, first: np.ndarray | None = None) -> None:
        first = h if first is None else first
        text = np.searchsorted(ptr, at, "right") - 1
        if keep is not None:
            slot = h & np.uint64((1 << FILTER_BITS) - 1)
            ok = (keep[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
            at, text, h, first = at[ok], text[ok], h[ok], first[ok]
        slots = [[int(t.own[j]) for j in range(p, p + length) if t.kind[j]] if t else [] for p in at.tolist()]
        out.append((text, at - ptr[text], h, slots, np.full(len(at), sort), first, np.full(len(at), length)))

    at = _says(t, _starts(t.ptr, WINDOW), WINDOW)
    add(t, t.ptr, at, _window(t.shape, at), WINDOW, 0)
    if keep is not None:
        if lengths:
            words, shapes = _rolled(plain), t.rolled()
        for n in lengths or []:
            at = _starts(plain_ptr, n)
            add(None, plain_ptr, at, _whole(words, at, n, 0), n, 2)
            if n >= WINDOW:
                at = _says(t, _starts(t.ptr, n), n)
                add(t, t.ptr, at, _whole(shapes, at, n, 1), n, 1)
    else:
        said = np.bincount(out[0][0], minlength=len(texts))
        begun = dict(zip(out[0][0][out[0][1] == 0].tolist(), out[0][2][out[0][1] == 0].tolist(), strict=True))
        short = (np.diff(plain_ptr) < SHORT) | (said == 0)
        v, _, _ = templates(texts, True)  # the first word as a name
        again = np.flatnonzero(np.diff(v.ptr) > 0)
        again = again[(v.kind[v.ptr[again]] == 3) & (t.kind[t.ptr[again]] == 0)]
        at = v.ptr[again[np.diff(v.ptr)[again] >= WINDOW]]
        at = _says(v, at, WINDOW)
        h = _window(v.shape, at)
        names = (np.searchsorted(v.ptr, at, "right") - 1).tolist()
        add(v, v.ptr, at, h, WINDOW, 0, np.array([begun.get(i, x) for i, x in zip(names, h.tolist(), strict=True)], np.uint64))
        words, shapes = _rolled(plain), {id(x): x.rolled() for x in (t, v)}
        named = set(again.tolist())
        for i in np.flatnonzero(short & (np.diff(plain_ptr) > 0)).tolist():
            n, at = int(plain_ptr[i + 1] - plain_ptr[i]), plain_ptr[i : i + 1]
            add(None, plain_ptr, at, _whole(words, at, n, 0), n, 2)
            for x in (t, v) if i in named else (t,):
                n = int(x.ptr[i + 1] - x.ptr[i])
                if n >= WINDOW and len(at := _says(x, x.ptr[i : i + 1], n)):
                    add(x, x.ptr, at, _whole(shapes[id(x)], at, n, 1), n, 1)
    return tuple(sum((x[i] for x in out), []) if i == 3 else np.concatenate([x[i] for x in out]) for i in range(7))


def _emit(ids: str, keep_from=None, lengths=None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = None if keep_from is None else keep_from.value
        for batch in batches:
            for some, part in buffers(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                text, pos, h, slots, sort, first, size = _windows(part, keep, lengths)
                flat = pa.array([[x - (1 << 64) if x >> 63 else x for x in s] for s in slots], pa.list_(pa.int64()))
                cols = [pa.array([some[i] for i in text.tolist()], pa.int64()), pa.array(pos, pa.int64()), pa.array(h.view(np.int64)), flat, pa.array(sort, pa.int32()), pa.array(first.view(np.int64)), pa.array(size, pa.int32())]
                yield pa.RecordBatch.from_arrays(cols, names=[ids, "pos", "h", "slots", "sort", "first", "size"])

    return run


def windows(rows: DataFrame, id_col: str, keep=None, lengths: list[int] | None = None) -> DataFrame:
    """(id, pos, h, slots, sort, first, size) of the lookups of ``rows`` (id, text); see :func:`_windows`."""
    src = rows.select(F.col(id_col).cast("long").alias(id_col), "text")
    return src.mapInArrow(released(_emit(id_col, keep, lengths)), f"{id_col} bigint, pos bigint, h bigint, slots array<bigint>, sort int, first bigint, size int")


def _candidates(hits: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id) that may reach COVERAGE: pairs that share a whole sequence or one of the item's rarest windows.

    Of an item's W windows a document must miss more than (1 - COVERAGE) * W not to reach it, so one of any so many plus
    one occurs in it; the ones that the fewest lookups of documents and items hit are taken.
    """
    forms = items.where("sort = 0").select("item_id", "first", "h").distinct()
    often = hits.where("sort = 0").groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    rank = split_join(forms, often, ["h"], "left").groupBy("item_id", "first").agg(F.sum(F.coalesce("n", F.lit(0))).alias("n"))
    by_item = Window.partitionBy("item_id")  # the windows of one item
    rare = rank.withColumn("place", F.row_number().over(by_item.orderBy("n", "first"))).withColumn("windows", F.count(F.lit(1)).over(by_item))
    rare = rare.where(F.col("place") <= F.floor((1 - COVERAGE) * F.col("windows") + 1e-9) + 1).select("item_id", "first")
    keys = split_join(forms, rare, ["item_id", "first"]).select("item_id", "h", F.lit(0).alias("sort")).unionByName(items.where("sort > 0").select("item_id", "h", "sort"))
    return split_join(hits.select("doc_id", "h", "sort").distinct(), keys.distinct(), ["h", "sort"]).select("doc_id", "item_id").distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Benchmark items that documents hold, one row each: doc_id, item_id, windows_hit, windows, coverage, agreement, contaminated (true).

    ``docs`` needs doc_id and text, ``benchmark`` item_id and text; other columns are not looked at. coverage is the
    share of the item's distinct windows found in the document, agreement the share of slot fillings that follow one
    mapping per placement (1.0 without slots). Items of fewer than ``SHORT`` tokens, or without a window of two words, are
    also found by their whole token sequence: as it is (both shares 1.0), and from five tokens of which two are words as a
    template (coverage 1.0); an item of one word is held by every document with that word. A run of names counts as one
    name, so a name of another number of words moves no window. Texts without a token match
    nothing, null ids neither. Repeated rows of a document count once. Either table empty: an empty result.
    """
    spark = docs.sparkSession
    items = saved(windows(benchmark.where("item_id is not null"), "item_id").withColumnRenamed("pos", "item_pos").withColumnRenamed("slots", "item_slots"), "items")
    lengths = sorted(r["size"] for r in items.where("sort > 0").select("size").distinct().collect())
    mask = (1 << FILTER_BITS) - 1
    slot = items.select(F.col("h").bitwiseAND(mask).alias("s")).selectExpr("shiftright(s, 6) as word", "shiftleft(1L, cast(s & 63 as int)) as bit")
    keep = np.zeros(1 << FILTER_BITS - 6, np.uint64)
    got = slot.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most 2^18 rows
    keep[got.column("word").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    hits = saved(windows(docs.where("doc_id is not null"), "doc_id", spark.sparkContext.broadcast(keep), lengths).drop("first", "size").distinct(), "hits")
    distinct = F.countDistinct(F.when(F.col("sort") == 0, F.col("first")))
    size = items.groupBy("item_id").agg(distinct.alias("windows"))
    pairs = saved(_candidates(hits, items), "candidates")
    both = split_join(split_join(pairs, hits, ["doc_id"]), items, ["item_id", "h", "sort"])
    both = saved(both.select("doc_id", "item_id", "pos", "item_pos", "sort", "first", "slots", "item_slots").dropDuplicates(["doc_id", "item_id", "pos", "item_pos", "sort"]), "matches")
    share = both.groupBy("doc_id", "item_id").agg(distinct.alias("windows_hit"), F.max("sort").alias("whole")).join(size, "item_id")
    share = share.withColumn("coverage", F.when(F.col("whole") > 0, 1.0).otherwise(F.col("windows_hit") / F.col("windows"))).where(F.col("coverage") >= COVERAGE)
    pairs = both.where("size(slots) > 0").select("doc_id", "item_id", (F.col("pos") - F.col("item_pos")).alias("place"), F.explode(F.arrays_zip("item_slots", "slots")).alias("z"))
    fill = pairs.groupBy("doc_id", "item_id", "place", F.col("z.item_slots").alias("stands"), F.col("z.slots").alias("for")).agg(F.count(F.lit(1)).alias("n"))
    fill = fill.groupBy("doc_id", "item_id", "place", "stands").agg(F.max("n").alias("most"), F.sum("n").alias("all"))
    # the best placement decides: chance windows elsewhere in the document don't speak against it
    fill = fill.groupBy("doc_id", "item_id", "place").agg(F.sum("most").alias("most"), F.sum("all").alias("all"))
    fill = fill.groupBy("doc_id", "item_id").agg(F.max(F.struct("all", (F.col("most") / F.col("all")).alias("agreement"))).alias("best"))
    found = share.join(fill, ["doc_id", "item_id"], "left").withColumn("agreement", F.when(F.col("whole") == 2, 1.0).otherwise(F.coalesce("best.agreement", F.lit(1.0))))
    return found.where(F.col("agreement") >= AGREEMENT).select("doc_id", "item_id", "windows_hit", "windows", "coverage", "agreement", F.lit(True).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, broadcast_ids: int = 1_000_000) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item; columns as in ``docs``.

    Rows are told apart by doc_id: all rows of one that holds an item go. Rows without doc_id stay.
    """
    drop = saved(contaminated(docs, benchmark).select("doc_id").distinct(), "leaks")
    if (n := drop.count()) <= broadcast_ids:
        drop = F.broadcast(drop)
    return docs.join(drop, "doc_id", "left_anti") if n else docs
