"""Personal data by patterns and information-theoretic sanitisation (operator 9).

Patterns find the protected entities: e-mail and IP addresses, card and phone numbers. Terms that stand near an entity
somewhere are weighed by how much of the entity's information they give away: disclosure = PMI(term; entity) /
IC(entity), both from counts of whole documents over the corpus. Where it reaches ``DISCLOSURE``, every occurrence of the
term in a document that holds the entity is a span too, and :func:`sanitise` generalises entities to their kind and
removes such terms.

Scale: the first pass emits a row per document and the few terms around its entities. Document counts of terms come
from a second pass that keeps only words of a bitmap of fixed size (2 MB) and sums them within a task, so what is
shuffled follows the entities, not the corpus' vocabulary. Terms whose count beside entities alone rules a disclosure
out, such as all frequent words, aren't looked for. A third pass reads the documents that hold an entity of a candidate
pair and emits the pairs that a bitmap lets pass, at most the words of these documents for each entity they hold.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm._bytes import mix
from quarry.llm._shared import buffers, released, saved, split_join
from quarry.llm.toxicity import tokens

KINDS = ("email", "ip", "card", "phone")
#: Words on each side of an entity that may give it away; share of its information that is too much; documents that must show it.
NEAR, DISCLOSURE, SUPPORT = 6, 0.8, 2
FILTER_BITS = 24
#: Words whose counts a task holds before it passes them on.
TASK_TERMS = 1 << 20
#: Up to so many digests of texts with candidate entities they are broadcast (some 60 bytes each).
BROADCAST_IDS = 1_000_000
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)++")
_GROUP = re.compile(r"[0-9]+")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", m.end() if m else at + 1)


def ips(text: str) -> Iterator[tuple[int, int]]:
    """A dotted run of numbers holds one match for each four of them in a row."""
    for m in _DOTTED.finditer(text):
        parts = list(_GROUP.finditer(text, m.start(), m.end()))
        for i in range(0, len(parts) - 3, 4):
            if all(len(p[0].lstrip("0")) <= 3 and int(p[0].lstrip("0") or 0) <= 255 for p in parts[i : i + 4]):
                yield parts[i].start(), parts[i + 3].end()


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _DIGITS.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            yield m.span()


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start; code points, end exclusive. Null: none."""
    if not text:
        return []
    return [(k, *s) for k, find in zip(KINDS, (emails, ips, cards, phones), strict=True) for s in find(text)]


def _near(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """Spans of up to NEAR terms on each side."""
    left, low, step = [], start, 200
    while low > 0 and len(left) <= NEAR:
        low, step = max(0, low - step), 2 * step
        left = [m.span() for m in _TERM.finditer(text, low, start)]
    yield from left[-NEAR:] if low == 0 else left[1:][-NEAR:]
    for i, m in enumerate(_TERM.finditer(text, end)):
        if i == NEAR:
            return
        yield m.span()


def _outside(spans: list[tuple[str, int, int]]):
    """A test of whether a span meets none of ``spans``, in logarithmic time."""
    begins, ends = [], []
    for a, b in sorted((a, b) for _, a, b in spans):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            begins.append(a)
            ends.append(b)

    def free(a: int, b: int) -> bool:
        k = bisect_left(begins, b)
        return k == 0 or ends[k - 1] <= a

    return free


def _join(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


_TERMS = "array<struct<entity: bigint, term: bigint, start: int, stop: int>>"
_FOUND = f"doc_id bigint, text_md5 string, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, base string, entities array<bigint>, terms {_TERMS}"


def _hashes(words: list[str]) -> list[int]:
    return tokens([w.encode("utf-8", "surrogatepass") for w in words])[0].view(np.int64).tolist() if words else []


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("text_md5", pa.string()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("base", pa.string()), ("entities", pa.list_(pa.int64())), ("terms", pa.list_(pa.struct([("entity", pa.int64()), ("term", pa.int64()), ("start", pa.int32()), ("stop", pa.int32())])))])
    for batch in batches:
        out = []
        for doc, own, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            spans = base_spans(text)
            row = {"doc_id": doc, "text_md5": own if spans else None} | {f"n_{k}": sum(s[0] == k for s in spans) for k in KINDS}
            row |= {"base": _join(spans), "base_sha256": hashlib.sha256(_join(spans).encode()).hexdigest(), "entities": [], "terms": []}
            free = _outside(spans)
            for k, a, b in spans:
                entity = _entity(k, text[a:b])
                row["entities"].append(entity)
                near = [(x, y) for x, y in _near(text, a, b) if y - x > 2 and not text[x:y].isdigit() and free(x, y)]
                for h, (x, y) in zip(_hashes([text[x:y] for x, y in near]), near, strict=True):
                    row["terms"].append({"entity": entity, "term": h, "start": x, "stop": y})
            out.append(row)
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def _words(keep) -> object:
    """Document counts of the words that the bitmap lets pass, summed within a task up to a bounded number of words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, held, size = keep.value, [], 0

        def total() -> tuple[np.ndarray, np.ndarray]:
            term, at = np.unique(np.concatenate([t for t, _ in held]), return_inverse=True)
            return term, np.bincount(at, np.concatenate([n for _, n in held]), len(term)).astype(np.int64)

        def out(term: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(n)], names=["term", "n"])

        for batch in batches:
            for _, part in buffers(batch.column(0).to_pylist(), batch.column(0).cast(pa.binary()).to_pylist()):
                h, ptr = tokens(part)
                slot = h & np.uint64((1 << FILTER_BITS) - 1)
                at = np.flatnonzero((bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1))
                pair = np.unique(np.rec.fromarrays([np.searchsorted(ptr, at, "right"), h[at]]))
                held.append(np.unique(pair.f1, return_counts=True))
                size += len(held[-1][0])
                if size > TASK_TERMS:
                    held = [total()]
                    size = len(held[0][0])
                    if size > TASK_TERMS // 2:
                        yield out(*held.pop())
                        size = 0
        if held:
            yield out(*total())

    return run


_TOGETHER = "text_md5 string, entity bigint, term bigint, spans array<struct<start: int, stop: int>>"


def _entity(kind: str, value: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{kind}:{value}".encode(), digest_size=8).digest(), "big", signed=True)


def _pair(entity: np.ndarray, term: np.ndarray) -> np.ndarray:
    """Bit of each pair of an entity and a term."""
    return (mix(entity.view(np.uint64)) ^ term.view(np.uint64)) & np.uint64((1 << FILTER_BITS) - 1)


def _set(bits: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def _pair_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        slot = _pair(batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False))
        bit = np.uint64(1) << (slot & np.uint64(63))
        yield pa.RecordBatch.from_arrays([pa.array((slot >> np.uint64(6)).astype(np.int64)), pa.array(bit.view(np.int64))], names=["word", "bit"])


def _together(terms, pairs):
    """Of every document the pairs of an entity and a term in it that the bitmaps let pass, with the term's places outside the base spans."""
    schema = pa.schema([("text_md5", pa.string()), ("entity", pa.int64()), ("term", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[dict] = []
            for own_text, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                spans = base_spans(text)
                if not spans:
                    continue
                free, places = _outside(spans), {}
                words = [m.span() for m in _TERM.finditer(text)]
                h = np.array(_hashes([text[x:y] for x, y in words]), np.int64)
                for i in np.flatnonzero(_set(terms.value, h.view(np.uint64) & np.uint64((1 << FILTER_BITS) - 1))).tolist():
                    x, y = words[i]
                    own = places.setdefault(int(h[i]), [])
                    if y - x > 2 and not text[x:y].isdigit() and free(x, y):
                        own.append({"start": x, "stop": y})
                term = np.array(list(places), np.int64)
                for entity in sorted({_entity(k, text[a:b]) for k, a, b in spans}) if len(term) else ():
                    for t in term[_set(pairs.value, _pair(np.array([entity], np.int64), term))].tolist():
                        out.append({"text_md5": own_text, "entity": entity, "term": t, "spans": places[t]})
                    if len(out) >= 10_000:
                        yield pa.RecordBatch.from_pylist(out, schema=schema)
                        out = []
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def found_spans(docs: DataFrame, disclosure: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """Spans of personal data of every document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, text_md5 (null without base spans).

    spans lists the base spans and those of revealing terms (kind ``term``; all occurrences in documents that hold what
    they reveal, at any distance) as kind:start:end; base_sha256 digests the base spans alone. Null and empty texts have
    none. Repeated rows are rows of the result each and count as documents of their own in the statistics. Terms belong
    to a text, not to a doc_id (they are joined by the text's digest), so rows that repeat a doc_id with other texts, or
    have none, get the terms of their own text. Columns besides doc_id and text are not looked at. An empty table gives
    an empty result.
    """
    spark = docs.sparkSession
    digest = F.md5(F.coalesce("text", F.lit(""))).alias("text_md5")
    found = saved(docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest, "text").mapInArrow(released(_find), _FOUND), "pii")
    row = found.where("size(entities) > 0").select("text_md5", "entities", "terms")
    near = row.select(F.explode(F.array_distinct(F.transform("terms", lambda t: F.struct(t["entity"].alias("entity"), t["term"].alias("term"))))).alias("p")).select("p.entity", "p.term").distinct()
    entity = row.select(F.explode(F.array_distinct("entities")).alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("entity_docs")).where(F.col("entity_docs") >= support)
    beside = row.select(F.explode(F.array_distinct("terms.term")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("beside_docs"))
    total = F.lit(float(found.count()))

    def share(both: Column, term_docs: str) -> Column:
        """PMI / IC: 1 if the term gives all of the entity's information away."""
        return F.try_divide(F.log(both * total / (F.col(term_docs) * F.col("entity_docs"))), F.log(total / F.col("entity_docs")))

    # a term is in at least the documents that show it beside some entity, and at most all of the entity's and the term's
    # documents hold both: what is told then is the most it can tell
    def most(term_docs: str) -> Column:
        return share(F.least(F.col(term_docs), F.col("entity_docs")), term_docs) >= disclosure

    both = saved(split_join(split_join(near, entity, ["entity"]), beside, ["term"]).where(most("beside_docs")), "near")
    base = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"]

    def bitmap(bits: DataFrame) -> np.ndarray:
        got = bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most 2^18 rows
        keep = np.zeros(1 << FILTER_BITS - 6, np.uint64)
        keep[got.column("word").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
        return keep

    def of_terms(rows: DataFrame) -> np.ndarray:
        slot = rows.select(F.col("term").bitwiseAND((1 << FILTER_BITS) - 1).alias("s"))
        return bitmap(slot.selectExpr("shiftright(s, 6) as word", "shiftleft(1L, cast(s & 63 as int)) as bit"))

    send = spark.sparkContext.broadcast
    words = docs.select("text").where("text is not null").mapInArrow(released(_words(send(of_terms(both)))), "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("term_docs"))
    pairs = split_join(both, words, ["term"], "left").withColumn("term_docs", F.greatest(F.coalesce("term_docs", F.lit(0)), "beside_docs"))
    pairs = saved(pairs.where((F.col("term_docs") >= support) & most("term_docs")).select("entity", "term", "entity_docs", "term_docs"), "pairs")
    if pairs.isEmpty():
        return found.select(*base, F.col("base").alias("spans"), "text_md5")
    held = row.select("text_md5", F.explode("entities").alias("entity"))
    ids = saved(split_join(held, pairs.select("entity").distinct(), ["entity"], "left_semi").select("text_md5").distinct(), "holders")
    texts = docs.where("text is not null").select(digest, "text")
    texts = texts.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "text_md5", "left_semi")
    bits = bitmap(pairs.select("entity", "term").mapInArrow(_pair_bits, "word bigint, bit bigint"))
    seen = saved(texts.mapInArrow(released(_together(send(of_terms(pairs)), send(bits))), _TOGETHER), "together")
    told = seen.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("both")).where(F.col("both") >= support)
    told = split_join(told, pairs, ["entity", "term"]).where(share(F.col("both"), "term_docs") >= disclosure).select("entity", "term")
    each = split_join(seen, told, ["entity", "term"]).select("text_md5", F.explode("spans").alias("s"))
    more = each.groupBy("text_md5").agg(F.array_sort(F.collect_set("s")).alias("more"))
    listed = F.transform("more", lambda s: F.concat(F.lit("term:"), s["start"], F.lit(":"), s["stop"]))
    out = split_join(found.where("text_md5 is not null"), more, ["text_md5"], "left")
    out = out.select(*base, F.concat_ws(",", F.col("base"), listed).alias("spans"), "text_md5")
    return out.unionByName(found.where("text_md5 is null").select(*base, F.col("base").alias("spans"), "text_md5"))


def find(docs: DataFrame, disclosure: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """As :func:`found_spans`, without the digest of the text."""
    return found_spans(docs, disclosure, support).drop("text_md5")


def sanitise(docs: DataFrame, disclosure: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """doc_id and text of ``docs`` with each base span generalised to <EMAIL>, <IP>, <CARD>, <PHONE> and each term removed (<...>).

    Spans are those of :func:`find`; of overlapping spans the one that begins first, then the longest, is replaced. Rows
    without spans stay as they are; a null text stays null. Rows that repeat a doc_id are cleaned by their own text each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, listed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if text and listed:
                    parts, at = [], 0
                    for k, a, b in sorted(((k, int(a), int(b)) for k, a, b in (x.split(":") for x in listed.split(","))), key=lambda x: (x[1], -x[2])):
                        if a >= at:
                            parts += [text[at:a], "<...>" if k == "term" else f"<{k.upper()}>"]
                            at = b
                    text = "".join(parts) + text[at:]
                out.append(text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["doc_id", "text"])

    digest = F.md5(F.coalesce("text", F.lit("")))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", digest.alias("text_md5"))
    some = found_spans(docs, disclosure, support).where("spans <> ''").groupBy("text_md5").agg(F.min("spans").alias("spans"))
    return split_join(own, some, ["text_md5"], "left").select("doc_id", "text", "spans").mapInArrow(run, "doc_id bigint, text string")
