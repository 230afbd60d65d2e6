"""Sectionizer and audit queries over the documents table, with SQL.

Each document becomes a raw one: its lines are paragraphs, and before every third line, from the second on, stands a header
of ``HEADERS``. What a header is to the rules is stated beside it, so the SQL says independently what must come out.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quarry.functions import text as T
from quarry.operators import judge, sections
from quarry.scratch import bounded_batches

#: Raw header, canonical form, what it is: a section ('', 'end' if it ends a document), markup, noise, skipped with the rest, skipped.
HEADERS = (
    ("1. Introduction", "1. introduction", ""),
    ("Results and Discussions", "results and discussion", ""),
    ("IV. METHODS", "iv. methods", ""),
    ("RE SULTS", "results", ""),
    ("Study sites ", "study area", ""),
    ("* Policy Implications", "implications", ""),
    ("iv)", "iv", "markup"),
    ("Table 2", "table 2", "noise"),
    ("References", "references", "noise"),
    ("Author contributions to the present study of rivers", "author contributions to the present study of rivers", "no_skip"),
    ("Materials & Methods", "materials and methods", ""),
    ("Concluding remarks", "conclusion", "end"),
    ("[2.3] Data and Methodology", "data and methods", ""),
    ("Results and Discussions", "results and discussion", ""),
    ("Case studies", "case study", ""),
    ("Acknowledgements", "acknowledgements", "skip"),
)
_RAW = StructType([StructField("text", StringType()), StructField("paragraph", StringType()), StructField("header", StringType())])


@F.pandas_udf(_RAW)
def _annotated(doc_id: pd.Series, text: pd.Series) -> pd.DataFrame:
    rows = []
    for d, t in zip(doc_id, text, strict=True):
        at, out, heads, paras = 0, [], [], []
        for i, line in enumerate((t or "").split("\n")):
            for own, x in ((heads, HEADERS[(d * 7 + i) % len(HEADERS)][0]) if i % 3 == 1 else (None, ""), (paras, line)):
                if own is not None:
                    if x:
                        own.append({"start": str(at) if own is heads else at, "end": at + len(x)})
                    out.append(x)
                    at += len(x) + 1
        rows.append(("\n".join(out), json.dumps(paras[::-1]), json.dumps(heads)))
    return pd.DataFrame(rows, columns=["text", "paragraph", "header"])


def raw_documents(spark: SparkSession, d: str) -> DataFrame:
    """Raw documents in the v2 layout; spans of paragraphs come unsorted, those of headers as text."""
    bounded_batches(spark)
    made = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", _annotated("doc_id", "text").alias("a"))
    body = F.struct(F.col("a.text").alias("text"), F.create_map(F.lit("paragraph"), F.col("a.paragraph"), F.lit("section_header"), F.col("a.header")).alias("annotations"))
    return made.select(F.col("doc_id").alias("corpusid"), F.concat(F.lit("Title "), F.col("doc_id")).alias("title"), body.alias("body"))


def normal(spark: SparkSession, d: str) -> DataFrame:
    return sections.normalise_schema(raw_documents(spark, d))


def _done(spark: SparkSession, d: str) -> DataFrame:
    return sections.sectionize(normal(spark, d))


def sectionize(spark: SparkSession, d: str) -> DataFrame:
    text = F.array_join(F.transform("sections", lambda s: F.concat(s["header"], F.lit("="), s["text"])), "|")
    return _done(spark, d).select(F.col("corpusid").cast("long").alias("doc_id"), "outcome", F.size("sections").cast("long").alias("n_sections"), F.md5(text).alias("sections_md5"))


def sectionize_excluding(spark: SparkSession, d: str) -> DataFrame:
    return sections.sectionize(normal(spark, d), ["license", r"tion\b.*scum"]).groupBy("outcome").agg(F.count(F.lit(1)).alias("docs"))


def section_rules_report(spark: SparkSession, d: str) -> DataFrame:
    rows = _done(spark, d).select(F.col("corpusid").cast("long").alias("doc_id"), F.inline("detail"))
    return rows.select("doc_id", F.col("idx").cast("long").alias("idx"), "header", "outcome", F.col("chars").cast("long").alias("chars"), F.col("paragraphs").cast("long").alias("paragraphs"), F.col("words").cast("long").alias("words"))


def doc_report(spark: SparkSession, d: str) -> DataFrame:
    report = sections.doc_report(_done(spark, d))
    return report.select(F.col("corpusid").cast("long").alias("doc_id"), "outcome", *(c for c in report.columns if c.split("_")[0] in ("kept", "total", "empty") or c == "dropped_chars"))


def drops_by_reason(spark: SparkSession, d: str) -> DataFrame:
    return sections.drops_by_reason(sections.doc_report(_done(spark, d)))


def corpus_summary(spark: SparkSession, d: str) -> DataFrame:
    one = sections.corpus_report(sections.doc_report(_done(spark, d)))
    return one.select("docs", *(f"n_{o}" for o in sections.OUTCOMES), *(F.round(c, 6).alias(c) for c in ("kept_chars_pct", "dropped_sections_pct", "before_chars_per_section", "after_words_per_section", "after_paragraphs_per_section", "pct_unfiltered")))


def header_cases(spark: SparkSession, d: str) -> DataFrame:
    """What the header functions say of a header of each document, and of the sign of torn bullets in place of every ninth."""
    heads = F.array(*(F.lit(h) for h, _, _ in HEADERS))
    rows = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", F.element_at(heads, (F.col("doc_id") * 7 % len(HEADERS) + 1).cast("int")).alias("raw"))
    canon = F.when(F.col("doc_id") % 9 == 0, F.concat(F.lit("part \u00e2\u0080\u00a2 "), F.col("doc_id"))).otherwise(T.apply_synonyms(T.normalize_header(F.col("raw"))))
    rows = rows.withColumn("canon", canon)
    return rows.select("doc_id", "canon", T.structural_noise(F.col("canon")).alias("markup"), T.header_noise(F.col("canon")).alias("noise"))


def ground_truth_sections(spark: SparkSession, d: str) -> DataFrame:
    rows = sections.ground_truth(normal(spark, d))
    return rows.select(F.col("corpusid").cast("long").alias("doc_id"), F.col("idx").cast("long").alias("idx"), F.size("paras").cast("long").alias("paragraphs"), F.md5(F.array_join("paras", "|")).alias("paras_md5"))


def audit_presence(spark: SparkSession, d: str) -> DataFrame:
    raw = normal(spark, d)
    rows = sections.audit(raw, sections.sectionize(raw))
    return rows.select(F.col("corpusid").cast("long").alias("doc_id"), F.col("idx").cast("long").alias("idx"), F.col("chars").cast("long").alias("chars"), F.col("words").cast("long").alias("words"), "present", "reason")


def audit_totals(spark: SparkSession, d: str) -> DataFrame:
    raw = normal(spark, d)
    one = sections.audit_summary(sections.audit(raw, sections.sectionize(raw)))
    return one.select("audited", "sections", "missing", "chars", "missing_chars", "words", "missing_words", *(F.round(c, 6).alias(c) for c in ("loss_pct", "word_loss_pct", "section_loss_pct")), "missing_noise_header", "missing_non_english_or_invalid")


def prompt_truncate(spark: SparkSession, d: str) -> DataFrame:
    text = lambda s: s["header"] == "abstract"
    first = F.coalesce(F.try_element_at(F.filter("sections", text), F.lit(1))["text"], F.lit(""))
    rest = F.filter("sections", lambda s: ~text(s))
    prompt = judge.truncated(F.col("title"), first, judge.ordered_sections(rest), 1500)
    return _done(spark, d).select(F.col("corpusid").cast("long").alias("doc_id"), F.length(prompt).cast("long").alias("chars"), F.md5(prompt).alias("prompt_md5"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (sectionize, sectionize_excluding, section_rules_report, doc_report, drops_by_reason, corpus_summary, header_cases, ground_truth_sections, audit_presence, audit_totals, prompt_truncate)
    return {f.__name__: f for f in own}


def decomposed(x: str) -> str:
    """SQL for the canonical decomposition of the letters that occur in the test tables."""
    for c in "ÄÇÈÉÊÍÑÓÖÜäçèéêíñóöü":
        x = f"replace({x}, '{c}', '{unicodedata.normalize('NFD', c)}')"
    return x


def english() -> str:
    """SQL for whether the words ``w`` are English by the stand-in detector."""
    count = {lang: f"len(list_filter(w, lambda x: x IN ({', '.join(repr(x) for x in ws)})))" for lang, ws in T.FREQUENT.items()}
    return f"({count['en']} > 0 AND {count['en']} >= greatest({', '.join(count.values())}))"


def oracle_sql() -> dict[str, str]:
    quote = lambda x: x.replace("'", "''")
    letters = lambda x: f"length(regexp_replace({x}, '[^A-Za-z]', '', 'g'))"
    words = lambda x: f"len(list_filter(string_split({x}, ' '), lambda v: v <> ''))"
    valid = r"""CASE WHEN NOT regexp_matches(x, '\p{Nd}') THEN true
        ELSE length(regexp_replace(x, '\P{Nd}', '', 'g')) <= 0.3 * length(x) AND length(regexp_replace(x, '[a-zA-Z0-9]', '', 'g')) <= 0.3 * length(x) END"""
    base = rf"""
        h(k, raw, canon, cls) AS (VALUES {', '.join(f"({i}, '{quote(a)}', '{quote(b)}', '{c}')" for i, (a, b, c) in enumerate(HEADERS))}),
        l0 AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS t, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents),
        l AS (SELECT doc_id, i, t, CASE WHEN i % 3 = 1 THEN (doc_id * 7 + i) % {len(HEADERS)} END AS k, trim(regexp_replace({decomposed('t')}, '\s+', ' ', 'g')) AS n FROM l0),
        p AS (SELECT l.*, h.cls, h.canon, h.raw, count(*) FILTER (h.k IS NOT NULL AND h.cls <> 'markup') OVER w - 1 AS sec, count(*) FILTER (h.k IS NOT NULL) OVER w - 1 AS truth
          FROM l LEFT JOIN h ON h.k = l.k WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
        pre AS (SELECT doc_id, string_agg(n, ' ' ORDER BY i) AS x, count(*) AS m FROM p WHERE sec = -1 AND n <> '' GROUP BY doc_id),
        doc AS (SELECT d.doc_id, d.text, coalesce(pre.m, 0) AS pre_m, coalesce(pre.x, '') AS pre_x, NOT EXISTS (SELECT 1 FROM l WHERE l.doc_id = d.doc_id AND l.t <> '') AS early FROM documents d LEFT JOIN pre USING (doc_id)),
        heads AS (SELECT p.doc_id, p.sec AS idx, p.canon, p.cls FROM p JOIN doc USING (doc_id) WHERE p.k IS NOT NULL AND p.cls <> 'markup' AND NOT doc.early),
        bodies AS (SELECT doc_id, sec AS idx, string_agg(n, ' ' ORDER BY i) AS x, count(*) AS m FROM p WHERE n <> '' GROUP BY ALL),
        s0 AS (SELECT heads.*, coalesce(bodies.x, '') AS x, coalesce(bodies.m, 0) AS m FROM heads LEFT JOIN bodies USING (doc_id, idx)),
        s1 AS (SELECT *, regexp_split_to_array(lower(x), '[^\p{{L}}]+') AS w FROM s0),
        s2 AS (SELECT doc_id, idx, canon, cls, x, m, CASE cls WHEN 'noise' THEN 'noise_header' WHEN 'skip' THEN 'unneeded_skip_remaining' WHEN 'no_skip' THEN 'unneeded_no_skip' ELSE
            CASE WHEN m = 0 THEN 'empty_parent' WHEN NOT (length(x) >= 40 AND {letters('x')} >= 20) THEN 'non_substantive' WHEN {english()} AND {valid} THEN 'kept' ELSE 'non_english_or_invalid' END END AS kind FROM s1),
        e AS (SELECT doc_id, min(idx) AS stop, arg_min(CASE WHEN kind IN ('kept', 'non_english_or_invalid') THEN 'post_conclusion_truncation' ELSE 'post_break_truncated' END, idx) AS tail FROM s2 WHERE cls IN ('skip', 'end') GROUP BY doc_id),
        s AS (SELECT s2.*, CASE WHEN idx > stop THEN tail ELSE kind END AS outcome, length(x) AS chars, {words('x')} AS words FROM s2 LEFT JOIN e USING (doc_id)),
        o AS (SELECT doc.*, CASE WHEN early THEN 'structural_failure'
            WHEN pre_m = 0 AND coalesce(a.kept, 0) = 0 THEN CASE WHEN coalesce(a.n, 0) > 0 THEN 'fully_filtered' ELSE 'structural_failure' END
            WHEN a.gone > 0 THEN 'partially_filtered' ELSE 'unfiltered' END AS outcome
          FROM doc LEFT JOIN (SELECT doc_id, count(*) AS n, count(*) FILTER (outcome = 'kept') AS kept, count(*) FILTER (outcome NOT IN ('kept', 'empty_parent')) AS gone FROM s GROUP BY doc_id) a USING (doc_id)),
        out1 AS (SELECT doc_id, -1 AS idx, 'abstract' AS header, pre_x AS x FROM doc WHERE pre_m > 0 AND NOT early UNION ALL SELECT doc_id, idx, canon, x FROM s WHERE outcome IN ('kept', 'empty_parent')),
        merged AS (SELECT doc_id, header, min(idx) AS idx, string_agg(x, ' ' ORDER BY idx) AS x FROM out1 JOIN o USING (doc_id) WHERE o.outcome IN ('unfiltered', 'partially_filtered') GROUP BY ALL),
        rep AS (SELECT o.doc_id, o.outcome, {', '.join(f"(coalesce(sum(s.{f}) FILTER (s.outcome IN ('kept', 'empty_parent')), 0) + CASE WHEN pre_m > 0 AND NOT early THEN {p} ELSE 0 END)::BIGINT AS kept_{g}, (coalesce(sum(s.{f}) FILTER (s.outcome NOT IN ('kept', 'empty_parent')), 0))::BIGINT AS dropped_{g}" for g, f, p in (("sections", "one", "1"), ("paragraphs", "m", "pre_m"), ("words", "words", words("pre_x")), ("chars", "chars", "length(pre_x)")))},
            count(*) FILTER (s.outcome = 'empty_parent') AS empty_parent_sections
          FROM o LEFT JOIN (SELECT *, 1 AS one FROM s) s USING (doc_id) GROUP BY o.doc_id, o.outcome, pre_m, early, pre_x),
        truth AS (SELECT p.doc_id, p.truth AS idx, count(*) AS m, string_agg(t, '|' ORDER BY i) AS bar, string_agg(t, ' ' ORDER BY i) AS body, sum(length(t)) AS chars, sum({words("regexp_replace(t, '\\s+', ' ', 'g')")}) AS words, arg_min(n, i) AS first FROM p WHERE t <> '' GROUP BY ALL),
        theads AS (SELECT doc_id, truth AS idx, raw, canon, cls FROM p WHERE k IS NOT NULL),
        written AS (SELECT doc_id, trim(regexp_replace(string_agg(x, ' ' ORDER BY idx), '\s+', ' ', 'g')) AS joined FROM merged GROUP BY doc_id),
        aud0 AS (SELECT t.doc_id, t.idx, t.chars, t.words, t.body AS x, trim(left(t.first, 50)) <> '' AND contains(w.joined, trim(left(t.first, 50))) AS present, coalesce(theads.cls, 'noise') AS cls, regexp_split_to_array(lower(t.body), '[^\p{{L}}]+') AS w
          FROM truth t JOIN written w USING (doc_id) LEFT JOIN theads USING (doc_id, idx)),
        aud AS (SELECT doc_id, idx, chars::BIGINT AS chars, words::BIGINT AS words, present, CASE WHEN present THEN NULL WHEN cls IN ('noise', 'markup') THEN 'noise_header' WHEN cls = 'skip' THEN 'unneeded_skip_remaining' WHEN cls = 'end' THEN 'unknown_after_break' WHEN cls = 'no_skip' THEN 'unneeded_no_skip'
            WHEN NOT (length(trim(regexp_replace({decomposed('x')}, '\s+', ' ', 'g'))) >= 40 AND {letters(decomposed('x'))} >= 20) THEN 'non_substantive' WHEN NOT ({english()} AND {valid}) THEN 'non_english_or_invalid' ELSE 'unknown_after_break' END AS reason FROM aud0)"""
    pct = lambda a, b: f"CASE WHEN {b} <= 0 THEN 0.0 ELSE 100.0 * {a} / {b} END"
    marks = "'introduction', 'abstract', 'results', 'results and discussion', 'materials and methods', 'methodology', 'background', 'overview', 'summary', 'conclusion', 'discussion'"
    own = {
        "sectionize": "SELECT o.doc_id, o.outcome, count(m.header) AS n_sections, md5(coalesce(string_agg(m.header || '=' || m.x, '|' ORDER BY m.idx), '')) AS sections_md5 FROM o LEFT JOIN merged m USING (doc_id) GROUP BY o.doc_id, o.outcome",
        "sectionize_excluding": r"SELECT CASE WHEN early AND coalesce(text, '') = '' THEN 'structural_failure' WHEN regexp_matches(doc.text, '(?i)license') OR regexp_matches(doc.text, '(?i)tion\b.*scum') THEN 'excluded_by_pattern' ELSE o.outcome END AS outcome, count(*) AS docs FROM o JOIN doc USING (doc_id) GROUP BY 1".replace("early AND coalesce(text", "o.early AND coalesce(o.text"),
        "section_rules_report": "SELECT doc_id, idx, canon AS header, outcome, chars, m AS paragraphs, words FROM s",
        "doc_report": "SELECT doc_id, outcome, kept_sections, kept_paragraphs, kept_words, kept_chars, dropped_chars, empty_parent_sections, kept_sections + dropped_sections AS total_sections, kept_paragraphs + dropped_paragraphs AS total_paragraphs, kept_words + dropped_words AS total_words, kept_chars + dropped_chars AS total_chars FROM rep",
        "drops_by_reason": f"SELECT r.reason, count(s.idx) AS sections, coalesce(sum(s.m), 0)::BIGINT AS paragraphs, coalesce(sum(s.words), 0)::BIGINT AS words, coalesce(sum(s.chars), 0)::BIGINT AS chars FROM (VALUES {', '.join(f'({x!r})' for x in sections.REASONS)}) r(reason) LEFT JOIN s ON s.outcome = r.reason GROUP BY r.reason",
        "corpus_summary": f"""SELECT count(*) AS docs, {', '.join(f"count(*) FILTER (outcome = '{x}') AS n_{x}" for x in sections.OUTCOMES)}, round({pct('sum(kept_chars)', 'sum(kept_chars + dropped_chars)')}, 6) AS kept_chars_pct, round({pct('sum(dropped_sections)', 'sum(kept_sections + dropped_sections)')}, 6) AS dropped_sections_pct,
            round(sum(kept_chars + dropped_chars) / sum(kept_sections + dropped_sections - empty_parent_sections), 6) AS before_chars_per_section, round(sum(kept_words) / sum(kept_sections - empty_parent_sections), 6) AS after_words_per_section, round(sum(kept_paragraphs) / sum(kept_sections - empty_parent_sections), 6) AS after_paragraphs_per_section,
            round(100.0 * count(*) FILTER (outcome = 'unfiltered') / count(*), 6) AS pct_unfiltered FROM rep""",
        "header_cases": f"SELECT d.doc_id, CASE WHEN torn THEN 'part ' || chr(226) || chr(128) || chr(162) || ' ' || d.doc_id ELSE canon END AS canon, NOT torn AND cls = 'markup' AS markup, torn OR cls IN ('markup', 'noise') AS noise FROM (SELECT doc_id, doc_id % 9 = 0 AS torn FROM documents) d JOIN h ON h.k = d.doc_id * 7 % {len(HEADERS)}",
        "ground_truth_sections": "SELECT doc_id, idx, m AS paragraphs, md5(bar) AS paras_md5 FROM truth",
        "audit_presence": "SELECT doc_id, idx, chars, words, present, reason FROM aud",
        "audit_totals": f"SELECT count(DISTINCT doc_id) AS audited, count(*) AS sections, count(*) FILTER (NOT present) AS missing, sum(chars)::BIGINT AS chars, (sum(chars) FILTER (NOT present))::BIGINT AS missing_chars, sum(words)::BIGINT AS words, (sum(words) FILTER (NOT present))::BIGINT AS missing_words, round({pct('sum(chars) FILTER (NOT present)', 'sum(chars)')}, 6) AS loss_pct, round({pct('sum(words) FILTER (NOT present)', 'sum(words)')}, 6) AS word_loss_pct, round({pct('count(*) FILTER (NOT present)', 'count(*)')}, 6) AS section_loss_pct, count(*) FILTER (reason = 'noise_header') AS missing_noise_header, count(*) FILTER (reason = 'non_english_or_invalid') AS missing_non_english_or_invalid FROM aud",
        "prompt_truncate": f"""SELECT doc_id, length(full_text) AS chars, md5(full_text) AS prompt_md5 FROM (
            SELECT d.doc_id, CASE WHEN 1500 - length(d.prelude) <= 0 THEN left(d.prelude, 1500) ELSE d.prelude || coalesce(string_agg(q.piece, '' ORDER BY q.r) FILTER (q.upto <= 1500 - length(d.prelude)), '')
                || coalesce(max(CASE WHEN q.upto > 1500 - length(d.prelude) AND q.upto - q.size <= 1500 - length(d.prelude) AND 1500 - length(d.prelude) - (q.upto - q.size) - length(q.head) > 20 THEN q.head || regexp_replace(left(q.x, (1500 - length(d.prelude) - (q.upto - q.size) - length(q.head))::INT), '\\s+$', '') END), '') END AS full_text
            FROM (SELECT o.doc_id, 'Title: Title ' || o.doc_id || chr(10) || chr(10) || 'Abstract:' || chr(10) || coalesce(m.x, '') || chr(10) || chr(10) || 'Sections:' AS prelude FROM o LEFT JOIN merged m ON m.doc_id = o.doc_id AND m.header = 'abstract') d
            LEFT JOIN (SELECT *, row_number() OVER v AS r, sum(size) OVER v AS upto FROM (
                SELECT *, chr(10) || chr(10) || '## ' || header || chr(10) AS head, chr(10) || chr(10) || '## ' || header || chr(10) || x AS piece, length(header) + 6 + length(x) AS size,
                  coalesce(list_min(list_transform(list_filter(range(1, 12), lambda j: contains(lower(header), ([{marks}])[j])), lambda j: j)), 99) AS rank FROM merged WHERE header <> 'abstract') WINDOW v AS (PARTITION BY doc_id ORDER BY rank, idx)) q USING (doc_id)
            GROUP BY d.doc_id, d.prelude)""",
    }
    return {k: f"WITH {base} {v}" for k, v in own.items()}
