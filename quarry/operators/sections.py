"""Sectionizer: span annotations to canonical named sections, with accounting and an independent audit.

One Arrow pass cuts headers and paragraphs out of a text, normalises them and finds each paragraph's header; a second, over
what is kept of it, deals paragraphs to the headers that open sections. Header rules and the rule table are plain columns
over one row per section, so code generation sees them. One shuffle, by a key of the row, puts the sections of a document
together again, so rows that repeat an id, or have none, stay documents of their own.
"""

from __future__ import annotations

import bisect
import itertools
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from quarry.functions import text as T
from quarry.operators.search import matched_patterns
from quarry.operators.search import sample as sampled
from quarry.sources.documents import best_title, spans

OUTCOMES = ("unfiltered", "partially_filtered", "fully_filtered", "structural_failure", "excluded_by_pattern")
REASONS = ("noise_header", "unneeded_skip_remaining", "unneeded_no_skip", "non_substantive", "non_english_or_invalid", "post_break_truncated", "post_conclusion_truncation")


def _owners(headers, paragraphs) -> list[int]:
    """Of each paragraph the last header whose running end is at most its start, -1 before any: where a pointer stands that stops at the first header that doesn't end before the paragraph."""
    ends = list(itertools.accumulate((h["e"] for h in headers), max))
    return [bisect.bisect_right(ends, p["s"]) - 1 for p in paragraphs]


@F.pandas_udf(ArrayType(IntegerType()))
def owners(headers: pd.Series, paragraphs: pd.Series) -> pd.Series:
    return pd.Series([_owners(hs, ps) for hs, ps in zip(headers, paragraphs, strict=True)])


_BODY = StructType([StructField("owner", IntegerType()), StructField("body", StringType())])


@F.pandas_udf(StructType([StructField("surfaces", ArrayType(StringType())), StructField("bodies", ArrayType(_BODY))]))
def _cut(text: pd.Series, headers: pd.Series, paragraphs: pd.Series) -> pd.DataFrame:
    """Surfaces of the headers, and of each paragraph with something in it its header and its normalised text."""
    surfaces, bodies = [], []
    for t, hs, ps in zip(text, headers, paragraphs, strict=True):
        surfaces.append([T._surface(t[h["s"] : h["e"]]) for h in hs])
        cut = ((o, T.normalized(t[p["s"] : p["e"]])) for o, p in zip(_owners(hs, ps), ps, strict=True))
        bodies.append([{"owner": o, "body": b} for o, b in cut if b])
    return pd.DataFrame({"surfaces": surfaces, "bodies": bodies})


_SECTION = StructType([StructField("canon", StringType()), StructField("paras", ArrayType(StringType()))])


@F.pandas_udf(StructType([StructField("pre", ArrayType(StringType())), StructField("sections", ArrayType(_SECTION))]))
def _assign(bodies: pd.Series, canon: pd.Series, markup: pd.Series) -> pd.DataFrame:
    """Paragraphs to the sections of their headers; markup opens nothing, its paragraphs fall to the section before."""
    pre, out = [], []
    for bs, names, marks in zip(bodies, canon, markup, strict=True):
        before: list[str] = []
        found: list[dict] = []
        bins: list[list[str]] = []  # of each header: where its paragraphs go
        for name, mark in zip(names, marks, strict=True):
            if not mark:
                found.append({"canon": name, "paras": []})
            bins.append(found[-1]["paras"] if found else before)
        for b in bs:
            (bins[b["owner"]] if b["owner"] >= 0 else before).append(b["body"])
        pre.append(before)
        out.append(found)
    return pd.DataFrame({"pre": pre, "sections": out})


@F.pandas_udf(ArrayType(StructType([StructField("header", StringType()), StructField("text", StringType())])))
def _merge(flat: pd.Series) -> pd.Series:
    """Texts of equal headers joined by a space, in the order of first occurrence."""
    def one(xs) -> list[dict]:
        by: dict[str, str] = {}
        for x in xs:
            by[x["header"]] = f"{by[x['header']]} {x['text']}" if x["header"] in by else x["text"]
        return [{"header": h, "text": t} for h, t in by.items()]

    return flat.map(one)


def normalise_schema(docs: DataFrame) -> DataFrame:
    """corpusid, title, text, paragraphs, headers (spans) from v2 (body) or v1 (content) rows, per row whichever is there."""
    has = set(docs.columns)
    get = lambda path, col: F.col(path) if col in has else F.lit(None).cast("string")
    body = [get("body.text", "body"), get("content.text", "content")]
    ann = {"paragraphs": ("paragraph", "paragraph"), "headers": ("section_header", "sectionheader")}
    columns = [F.col("corpusid").cast("string").alias("corpusid"), _title(has, get, body).alias("title"), F.coalesce(*body, F.lit("")).alias("text")]
    for out, (new, old) in ann.items():
        parts = [F.try_element_at(F.col("body.annotations"), F.lit(new)) if "body" in has else None, F.try_element_at(F.col("content.annotations"), F.lit(old)) if "content" in has else None]
        columns.append(spans(F.coalesce(*(p for p in parts if p is not None))).alias(out))
    return docs.select(*columns)


def _title(has: set[str], get, body: list[Column]) -> Column:
    """Rows with a body keep the title they have; others get one from their annotations or first line (see ``best_title``)."""
    own = get("title", "title")
    if "content" not in has:
        return F.coalesce(own, F.lit(""))
    found = best_title(own, body[1], F.col("content.annotations"))
    return F.when(body[0].isNotNull(), F.coalesce(own, F.lit(""))).otherwise(found)


def legacy_sections(docs: DataFrame) -> DataFrame:
    """Parallel arrays of a multi-valued document as sections: the shorter of sectionheader and paragraph counts."""
    n = F.least(F.size("sectionheader"), F.size("paragraph"))
    z = F.slice(F.arrays_zip("sectionheader", "paragraph"), 1, F.greatest(n, F.lit(0)))
    return docs.select(F.element_at("corpus_id", 1).alias("corpusid"), F.try_element_at("title", F.lit(1)).alias("title"), F.try_element_at("abstract", F.lit(1)).alias("abstract"), F.transform(z, lambda x: F.struct(x["sectionheader"].alias("raw"), F.array(x["paragraph"]).alias("paras"))).alias("raw_sections"))


def section_rows(docs: DataFrame) -> DataFrame:
    """corpusid, title, text, n_paragraphs, pre (paragraphs before a header), sections [(canon, paras)] in order.

    Headers that are mere markup open no section; their paragraphs fall to the one before.
    """
    base = docs.withColumn("cut", _cut("text", "headers", "paragraphs")).withColumn("normal", F.transform("cut.surfaces", _after_surface))
    got = _assign("cut.bodies", F.transform("normal", T.apply_synonyms), F.transform("normal", T.structural_noise))
    return base.select("corpusid", "title", "text", F.size("paragraphs").alias("n_paragraphs"), got.alias("g")).select("corpusid", "title", "text", "n_paragraphs", "g.pre", "g.sections")


def _after_surface(s: Column) -> Column:
    edge = r"""[\s.,;:!?\-\[\](){}"'`]+"""
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(T.keep_marker(s), f"^{edge}", ""), f"{edge}$", "")))


def _is_english(text: Column) -> Column:
    return F.coalesce(T.stopword_language(text) == "en", F.lit(False))


def ruled(rows: DataFrame, conclusion_breaks: bool = True, english=_is_english) -> DataFrame:
    """One row per section (idx, header, text, paragraphs, words, chars, kind, stop): the rule table without the cut.

    ``rows`` has canon and paras; with ``conclusion_breaks`` false a dropped conclusion doesn't end a document (legacy).
    """
    rows = rows.withColumn("text", F.array_join("paras", " ")).withColumn("cmp", F.lower(F.regexp_replace(T.strip_enumeration(F.col("canon")), r"\s+", "")))

    def has(terms) -> Column:
        return F.col("cmp").rlike("|".join(re.escape(t) for t in terms))

    kind = (
        F.when(T.header_noise(F.col("canon")), "noise_header")
        .when(has(T.SKIP_REMAINING), "unneeded_skip_remaining")
        .when(has(T.NO_SKIP), "unneeded_no_skip")
        .when(F.size("paras") == 0, "empty_parent")
        .when(~T.substantive(F.col("text")), "non_substantive")
        .when(english(F.col("text")) & T.string_valid(F.col("text")), "kept")
        .otherwise("non_english_or_invalid")
    )
    ends = F.contains("cmp", F.lit("conclusion"))
    stop = F.when(F.col("kind") == "noise_header", False).when(F.col("kind") == "unneeded_skip_remaining", True).when((F.col("kind") == "unneeded_no_skip") & F.lit(not conclusion_breaks), False).otherwise(ends)
    words = T.word_count(F.col("text"))
    return rows.withColumn("kind", T.evaluated_once(kind)).select("*", stop.alias("stop"), F.size("paras").alias("paragraphs"), words.alias("words"), F.length("text").alias("chars"))


def sectionize(docs: DataFrame, exclude_patterns: list[str] | None = None, english=_is_english, rows: DataFrame | None = None, conclusion_breaks: bool = True) -> DataFrame:
    """corpusid, title, outcome, sections [(header, text)] in first-kept order, pre, detail (every section with its outcome).

    Repeated headers are joined by a space, also onto an empty one. Paragraphs before any header are the abstract.
    After the first section that ends a document the others are dropped. A document without text or paragraphs, or that a
    pattern excludes, has no detail. ``docs`` is a result of :func:`normalise_schema`; rows that repeat an id, or have
    none, are documents of their own. ``rows`` may give sections found otherwise.
    """
    rows = (section_rows(docs) if rows is None else rows).withColumn("row", F.monotonically_increasing_id())
    hit = F.size(matched_patterns(exclude_patterns or [], F.col("title"), F.col("text"))) > 0
    early = F.when(F.col("text") == "", "structural_failure").when(hit, "excluded_by_pattern").when(F.col("n_paragraphs") == 0, "structural_failure")
    each = rows.select("row", "corpusid", "title", "pre", early.alias("early"), F.posexplode_outer("sections").alias("idx", "s")).select("row", "corpusid", "title", "pre", "early", "idx", F.coalesce("s.canon", F.lit("")).alias("canon"), F.coalesce("s.paras", F.array().cast("array<string>")).alias("paras"))
    tail = F.when(F.col("kind").isin("kept", "non_english_or_invalid"), "post_conclusion_truncation").otherwise("post_break_truncated")
    one = F.when(F.col("idx").isNotNull(), F.struct("idx", F.col("canon").alias("header"), "text", "paragraphs", "words", "chars", "kind"))
    docs = ruled(each, conclusion_breaks, english).groupBy("row").agg(F.first(F.struct("corpusid", "title", "pre", "early")).alias("d"), F.array_sort(F.collect_list(one)).alias("all"), F.min(F.when(F.col("stop") & F.col("idx").isNotNull(), F.struct("idx", tail.alias("tail")))).alias("end"))
    cut = F.transform("all", lambda r: F.struct(*(r[c].alias(c) for c in ("idx", "header", "text", "paragraphs", "words", "chars")), F.when(F.col("end").isNotNull() & (r["idx"] > F.col("end.idx")), F.col("end.tail")).otherwise(r["kind"]).alias("outcome")))
    docs = docs.select("d.*", cut.alias("detail"))
    none = lambda c: F.when(F.col("early").isNull(), F.col(c)).otherwise(F.slice(c, 1, 0)).alias(c)
    docs = docs.select("corpusid", "title", "early", none("pre"), none("detail"))
    abstract = F.when(F.size("pre") > 0, F.array(F.struct(F.lit("abstract").alias("header"), F.array_join("pre", " ").alias("text")))).otherwise(F.array().cast("array<struct<header:string,text:string>>"))
    kept = F.transform(F.filter("detail", lambda r: r["outcome"].isin("kept", "empty_parent")), lambda r: F.struct(r["header"].alias("header"), r["text"].alias("text")))
    flat = F.concat(abstract, kept)
    dropped = F.exists("detail", lambda r: ~r["outcome"].isin("kept", "empty_parent"))
    content = (F.size("pre") > 0) | F.exists("detail", lambda r: r["outcome"] == "kept")
    outcome = F.coalesce("early", F.when(~content, F.when(F.size("detail") > 0, "fully_filtered").otherwise("structural_failure")).when(dropped, "partially_filtered").otherwise("unfiltered"))
    docs = docs.withColumn("outcome", outcome).withColumn("merged", _merge(flat))
    none = F.array().cast("array<struct<header:string,text:string>>")
    return docs.select("corpusid", "title", "outcome", F.when(F.col("outcome").isin("unfiltered", "partially_filtered"), F.col("merged")).otherwise(none).alias("sections"), "pre", "detail")


def sectionize_legacy(docs: DataFrame, english=_is_english) -> DataFrame:
    """As :func:`sectionize` for multi-valued documents (see :func:`legacy_sections`): an abstract of 40 characters is required, a dropped conclusion doesn't end a document."""
    rows = legacy_sections(docs).withColumn("normal", F.transform("raw_sections", lambda x: x["raw"]))
    names = F.transform(_surface_list("normal"), lambda h: T.apply_synonyms(_after_surface(h)))
    sections = F.transform(F.arrays_zip(names.alias("n"), F.col("raw_sections").alias("r")), lambda z: F.struct(z["n"].alias("canon"), z["r"]["paras"].alias("paras")))
    long = F.length(F.coalesce("abstract", F.lit(""))) >= T.SUBSTANTIVE_CHARS
    rows = rows.select("corpusid", F.coalesce("title", F.lit("")).alias("title"), F.when(long, F.concat_ws(" ", "title", "abstract")).otherwise("").alias("text"), F.lit(1).alias("n_paragraphs"), F.array("abstract").alias("pre"), sections.alias("sections"))
    return sectionize(docs, english=english, rows=rows, conclusion_breaks=False)


@F.pandas_udf(ArrayType(StringType()))
def _surface_list(headers: pd.Series) -> pd.Series:
    return headers.map(lambda hs: [T._surface(h) for h in hs])


def doc_report(done: DataFrame) -> DataFrame:
    """Per document: kept, dropped and total sections, paragraphs, words and characters, empty parents, drops by reason."""
    kept = F.filter("detail", lambda r: r["outcome"].isin("kept", "empty_parent"))
    gone = F.filter("detail", lambda r: ~r["outcome"].isin("kept", "empty_parent"))
    add = lambda xs, f: F.aggregate(xs, F.lit(0).cast("long"), lambda a, r: a + r[f])
    has = (F.size("pre") > 0).cast("long")
    pre = {"paragraphs": F.size("pre").cast("long"), "words": F.aggregate("pre", F.lit(0).cast("long"), lambda a, t: a + F.size(F.split(t, " "))), "chars": F.length(F.array_join("pre", " ")).cast("long")}
    cols = [(F.size(kept) + has).alias("kept_sections"), F.size(gone).cast("long").alias("dropped_sections")]
    for f in ("paragraphs", "words", "chars"):
        cols += [(add(kept, f) + pre[f]).alias(f"kept_{f}"), add(gone, f).alias(f"dropped_{f}")]
    cols.append(F.size(F.filter("detail", lambda r: r["outcome"] == "empty_parent")).cast("long").alias("empty_parent_sections"))

    def per_reason(o: Column) -> Column:
        own = F.filter(gone, lambda r: r["outcome"] == o)
        return F.struct(F.size(own).cast("long").alias("sections"), *(add(own, f).alias(f) for f in ("paragraphs", "words", "chars")))

    names = F.array_distinct(F.transform(gone, lambda r: r["outcome"]))
    reasons = F.map_from_entries(F.transform(names, lambda o: F.struct(o.alias("reason"), per_reason(o).alias("sums"))))
    out = done.select("corpusid", "outcome", *cols, reasons.alias("dropped_sections_by_reason"))
    return out.select("*", *((F.col(f"kept_{f}") + F.col(f"dropped_{f}")).alias(f"total_{f}") for f in ("sections", "paragraphs", "words", "chars")))


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole <= 0, 0.0).otherwise(F.try_divide(100.0 * part, whole))


def average(part: Column, whole: Column) -> Column:
    return F.when(whole <= 0, 0.0).otherwise(F.try_divide(part.cast("double"), whole))


def corpus_report(reports: DataFrame) -> DataFrame:
    """One row: documents, a count and share per outcome, sums, shares kept and dropped, and average lengths of sections.

    Averages are over all sections (before_) and those kept (after_), sections without content left out.
    """
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in reports.columns if c.split("_")[0] in ("kept", "total", "empty") or (c.startswith("dropped_") and not c.endswith("reason"))]
    counts = [F.count(F.when(F.col("outcome") == o, 1)).alias(f"n_{o}") for o in OUTCOMES]
    one = reports.agg(F.count(F.lit(1)).alias("docs"), *counts, *sums)
    fields = ("sections", "paragraphs", "words", "chars")
    shares = [percent(F.col(f"{k}_{f}"), F.col(f"total_{f}")).alias(f"{k}_{f}_pct") for f in fields for k in ("kept", "dropped")]
    shares += [percent(F.col(f"n_{o}"), F.col("docs")).alias(f"pct_{o}") for o in OUTCOMES]
    one = one.withColumn("before_sections", F.greatest(F.col("total_sections") - F.col("empty_parent_sections"), F.lit(0))).withColumn("after_sections", F.greatest(F.col("kept_sections") - F.col("empty_parent_sections"), F.lit(0)))
    lengths = [average(F.col(f"{of}_{f}"), F.col(f"{k}_sections")).alias(f"{k}_{f}_per_section") for k, of in (("before", "total"), ("after", "kept")) for f in fields[1:]]
    return one.select("*", *shares, *lengths)


def summary_document(report: DataFrame, drops: DataFrame, pipeline: str, source: str, previously_written: int = 0) -> dict:
    """The summary of a run as a nested dictionary for a JSON file, from the one row of :func:`corpus_report` and the rows of :func:`drops_by_reason`."""
    r = report.first().asDict()
    fields = ("chars", "words", "paragraphs", "sections")
    stripped = {f: {k: r[f"{k}_{f}"] for k in ("kept", "dropped", "total")} | ({"empty_parent": r["empty_parent_sections"]} if f == "sections" else {}) | {"pct_dropped": r[f"dropped_{f}_pct"]} for f in fields}
    lengths = {k: {"sections": r[f"{k}_sections"]} | {f"{f}_per_section": r[f"{k}_{f}_per_section"] for f in fields[:3]} for k in ("before", "after")}
    by = {x.reason: {f: x[f] for f in ("sections", "paragraphs", "words", "chars")} for x in drops.collect()}  # one row per reason
    totals = {"documents_processed": r["docs"], "previously_written": previously_written, "outcomes": {o: {"count": r[f"n_{o}"], "pct": r[f"pct_{o}"]} for o in OUTCOMES}, "content_stripped": stripped, "avg_section_length": {"note": "Averages exclude empty parent headers (zero-content keys)."} | lengths, "drops_by_reason": by}
    return {"pipeline": pipeline, "source": source, "totals": totals}


def drops_by_reason(reports: DataFrame) -> DataFrame:
    """reason, sections, paragraphs, words, chars for every reason, zeros included."""
    each = reports.select(F.explode("dropped_sections_by_reason").alias("reason", "v")).groupBy("reason").agg(*(F.sum(f"v.{f}").alias(f) for f in ("sections", "paragraphs", "words", "chars")))
    dim = reports.sparkSession.createDataFrame([(r,) for r in REASONS], "reason string")
    return dim.join(each, "reason", "left").fillna(0)


_TRUTH = ArrayType(StructType([StructField(n, k) for n, k in (("idx", IntegerType()), ("raw", StringType()), ("paras", ArrayType(StringType())), ("probe", StringType()), ("chars", IntegerType()), ("words", IntegerType()))]))
#: Characters of a section's first paragraph that are looked for.
PROBE = 50


@F.pandas_udf(_TRUTH)
def _true_sections(text: pd.Series, headers: pd.Series, paragraphs: pd.Series) -> pd.Series:
    """Per header the paragraphs between its end and the next header's start; those before the first header have idx -1. Headers without any are left out."""
    out = []
    for t, hs, ps in zip(text, headers, paragraphs, strict=True):
        starts = [p["s"] for p in ps]  # ascending
        bounds = [(-1, "", 0, hs[0]["s"] if len(hs) else len(t))]
        bounds += [(i, t[h["s"] : h["e"]], h["e"], hs[i + 1]["s"] if i + 1 < len(hs) else len(t)) for i, h in enumerate(hs)]
        found = []
        for i, raw, a, b in bounds:
            paras = [t[p["s"] : p["e"]] for p in ps[bisect.bisect_left(starts, a) : bisect.bisect_right(starts, b)] if p["e"] <= b]
            if paras:
                found.append({"idx": i, "raw": raw, "paras": paras, "probe": T.normalized(paras[0])[:PROBE].strip(), "chars": sum(map(len, paras)), "words": sum(len(x.split()) for x in paras)})
        out.append(found)
    return pd.Series(out)


def ground_truth(docs: DataFrame) -> DataFrame:
    """The audit's own reading, by containment rather than by a pointer: corpusid, idx, raw header and paragraphs of each true section that has some."""
    return docs.select("corpusid", F.inline(_true_sections("text", "headers", "paragraphs"))).select("corpusid", "idx", "raw", "paras")


#: What :func:`missing_reason` may say.
MISSING = ("noise_header", "unneeded_skip_remaining", "unknown_after_break", "unneeded_no_skip", "non_substantive", "non_english_or_invalid")


def missing_reason(raw: Column, header: Column, content: Column, english=_is_english) -> Column:
    """Why a section isn't there, by the header and content rules in their order; the header's enumeration isn't stripped here."""
    compact = F.lower(F.regexp_replace(header, r"\s+", ""))
    return (
        F.when(T.header_noise(raw), "noise_header")
        .when(T.contains_any(compact, T.SKIP_REMAINING), "unneeded_skip_remaining")
        .when(F.contains(compact, F.lit("conclusion")), "unknown_after_break")
        .when(T.contains_any(compact, T.NO_SKIP), "unneeded_no_skip")
        .when((content != "") & ~T.substantive(T.normalize_text(content)), "non_substantive")
        .when((content != "") & ~(english(content) & T.string_valid(content)), "non_english_or_invalid")
        .otherwise("unknown_after_break")
    )


def audit(docs: DataFrame, done: DataFrame, sample: int = 0, seed: int = 0, english=_is_english) -> DataFrame:
    """corpusid, idx, raw, chars, words, present, reason of each true section.

    present: the first 50 characters of the section's first paragraph are in the written text. reason says why a missing
    one may be missing. ``sample`` documents (0: all), the lowest by a digest of seed and corpusid. Documents without
    written sections are left out; :func:`audit_summary` counts them.
    """
    if sample:
        docs = sampled(docs, "corpusid", sample, seed)
    # joined before Python sees a row, so that tables bucketed by corpusid are joined as they lie
    both = docs.select("corpusid", "text", "headers", "paragraphs").join(done.where("size(sections) > 0").select("corpusid", "sections"), "corpusid")
    written = T.normalize_text(F.array_join(F.transform("sections", lambda s: s["text"]), " "))
    both = both.select("corpusid", _true_sections("text", "headers", "paragraphs").alias("truth"), written.alias("written"))
    # the written text meets the probes of a document in one row, and only the verdicts are unfolded
    judged = F.transform("truth", lambda s: F.struct(*(s[c].alias(c) for c in ("idx", "raw", "chars", "words")), F.array_join(s["paras"], " ").alias("content"), ((s["probe"] != "") & F.contains(F.col("written"), s["probe"])).alias("present")))
    rows = both.select("corpusid", F.inline(judged))
    rows = rows.withColumn("present", F.coalesce("present", F.lit(False)))
    rows = T.with_canonical_header(rows, "raw")
    reason = F.when(~F.col("present"), missing_reason(F.col("raw"), F.col("header"), F.col("content"), english))
    return rows.select("corpusid", "idx", "raw", "chars", "words", "present", reason.alias("reason"))


def audit_summary(audited: DataFrame) -> DataFrame:
    """One row: audited documents, sections, missing, chars and words with their missing parts, loss_pct (characters), word_loss_pct, section_loss_pct, and a count missing_<reason> of each reason."""
    gone = F.when(~F.col("present"), 1)
    add = lambda c, name, test=F.lit(True): F.coalesce(F.sum(F.when(test, F.col(c))), F.lit(0)).cast("long").alias(name)
    by = [F.count(F.when(F.col("reason") == r, 1)).alias(f"missing_{r}") for r in MISSING]
    one = audited.agg(F.count_distinct("corpusid").alias("audited"), F.count(F.lit(1)).alias("sections"), F.count(gone).alias("missing"), add("chars", "chars"), add("chars", "missing_chars", ~F.col("present")), add("words", "words"), add("words", "missing_words", ~F.col("present")), *by)
    shares = [percent(F.col("missing_chars"), F.col("chars")).alias("loss_pct"), percent(F.col("missing_words"), F.col("words")).alias("word_loss_pct"), percent(F.col("missing"), F.col("sections")).alias("section_loss_pct")]
    return one.select("*", *shares)


def unwritten(docs: DataFrame, done: DataFrame, patterns: list[str] | None = None) -> DataFrame:
    """corpusid and matched patterns of the documents without written sections; those without a match were skipped."""
    missing = docs.join(done.where("size(sections) > 0").select("corpusid"), "corpusid", "left_anti")
    return missing.select("corpusid", matched_patterns(patterns or [], F.col("title"), F.col("text")).alias("matched"))


def verify(docs: DataFrame, done: DataFrame, sample: int = 0, seed: int = 0, patterns: list[str] | None = None, fail_threshold: float | None = None) -> dict:
    """The audit of a corpus as a dictionary for a JSON file; an error if nothing is there, or if more content than ``fail_threshold`` % is lost."""
    if docs.isEmpty():
        raise LookupError("no raw documents")
    docs = sampled(docs, "corpusid", sample, seed) if sample else docs
    out = audit_summary(audit(docs, done)).first().asDict()
    gone = unwritten(docs, done, patterns)
    counts = gone.agg(F.count(F.when(F.size("matched") > 0, 1)).alias("excluded"), F.count(F.lit(1)).alias("n")).first()
    hits = gone.select(F.explode("matched").alias("p")).groupBy("p").count().orderBy(F.desc("count"), "p").collect()  # a row per pattern
    out |= {"sampled": docs.count(), "excluded_by_pattern": counts.excluded, "skipped_missing_sect": counts.n - counts.excluded, "excluded_by_pattern_reasons": {r.p: r["count"] for r in hits}}
    if fail_threshold is not None and out["loss_pct"] > fail_threshold:
        raise ValueError(f"content loss {out['loss_pct']:.2f}% exceeds threshold {fail_threshold:.2f}%")
    return out


@F.pandas_udf(StructType([StructField(x, ArrayType(StructType([StructField("s", IntegerType()), StructField("e", IntegerType())]))) for x in ("paragraphs", "headers")]))
def _line_spans(text: pd.Series, least: pd.Series) -> pd.DataFrame:
    rows: dict[str, list] = {"paragraphs": [], "headers": []}
    for t, n in zip(text, least, strict=True):
        at, found = 0, {"paragraphs": [], "headers": []}
        for line in t.split("\n"):
            if line:
                found["paragraphs" if len(line) >= n else "headers"].append({"s": at, "e": at + len(line)})
            at += len(line) + 1
        for k, v in found.items():
            rows[k].append(v)
    return pd.DataFrame(rows)


def from_lines(docs: DataFrame, least: int = 40) -> DataFrame:
    """Raw documents out of plain ones: lines of at least ``least`` characters are paragraphs, shorter non-empty ones headers."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("string").alias("corpusid"), F.lit("").alias("title"), text.alias("text"), _line_spans(text, F.lit(least)).alias("s"))
    return rows.select("corpusid", "title", "text", "s.paragraphs", "s.headers")
