"""Text functions as Columns; Arrow UDFs only for Unicode decomposition, entities and header repair."""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType

from quarry.functions import noise
from quarry.plans.keyword import balanced

# Fixed values that results depend on.
NO_SKIP = ("caption", "figure", "table", "authorcontribution", "authoraffiliation", "keyword", "disclaimer", "fig", "deleted", "http", "et al", "equation", "â¢", "geofluids", "scientificreports|plosone", "acsomega", "www.intechopen.com", "www.frontiersin.org", "dovepress", "advancesinmeteorology", "frontiersin", "author", "authorsummary", "publicintereststatement", "backclose", "viewarticleonline", "asshownin", "scheme", "box", "reviewer", "continuedfromprevpage", "informedconsentstatement", "references")
SKIP_REMAINING = ("acknowledgment", "acknowledgement", "workscited", "bibliography", "dataavailability", "codeavailability", "funding", "pre-publicationhistory", "ethicstatement", "ethicsstatement", "grantinformation", "competinginterests", "conflictsofinterest", "supplementarymaterial", "disclosurestatement", "abbreviation", "appendix", "howtoreference", "cited", "contributionstatement", "modelavailability", "codeavailability", "supportinginformation", "declarationofinterest", "citationinformation", "orcid", "notesoncontributors", "forpeerreview", "appendice", "nomenclature", "glossary", "openaccess")
#: Variant of a header -> its canonical form.
SYNONYMS = {
    "resumo": "abstract",
    "resumen": "abstract",
    "introduccion": "introduction",
    "result": "results",
    "discussions": "discussion",
    "conclusions": "conclusion",
    "concluding remarks": "conclusion",
    "concluding remark": "conclusion",
    "final remarks": "conclusion",
    "final remark": "conclusion",
    "final considerations": "conclusion",
    "final consideration": "conclusion",
    "results and discussions": "results and discussion",
    "result and discussion": "results and discussion",
    "result and discussions": "results and discussion",
    "results & discussion": "results and discussion",
    "result & discussion": "results and discussion",
    "results and analysis": "results and discussion",
    "result and analysis": "results and discussion",
    "discussion and conclusion": "discussion and conclusions",
    "conclusions and discussion": "discussion and conclusions",
    "conclusion and discussion": "discussion and conclusions",
    "discussions and conclusions": "discussion and conclusions",
    "discussions and conclusion": "discussion and conclusions",
    "materials & methods": "materials and methods",
    "material & methods": "materials and methods",
    "materials & method": "materials and methods",
    "material & method": "materials and methods",
    "material and methods": "materials and methods",
    "materials and method": "materials and methods",
    "material and method": "materials and methods",
    "methods and materials": "materials and methods",
    "methods and material": "materials and methods",
    "method and materials": "materials and methods",
    "method and material": "materials and methods",
    "materials and methodology": "materials and methods",
    "material and methodology": "materials and methods",
    "methods & materials": "materials and methods",
    "materials and methods section": "materials and methods",
    "materials and reagents": "materials and methods",
    "materials and chemicals": "materials and methods",
    "reagents and materials": "materials and methods",
    "chemicals and materials": "materials and methods",
    "method": "methods",
    "experimental methods": "methods",
    "experimental": "methods",
    "experimental section": "methods",
    "experimental procedures": "methods",
    "experimental procedure": "methods",
    "methodology": "methodology",
    "methodologies": "methodology",
    "research methodology": "methodology",
    "research method": "methodology",
    "research methods": "methodology",
    "research design": "methodology",
    "research design and methods": "methodology",
    "statistical analyses": "statistical analysis",
    "statistical methods": "statistical analysis",
    "statistical method": "statistical analysis",
    "statistical data analysis": "statistical analysis",
    "statistical data analyses": "statistical analysis",
    "statistics": "statistical analysis",
    "statistical": "statistical analysis",
    "analysis of variance": "statistical analysis",
    "data analyses": "data analysis",
    "data and method": "data and methods",
    "data and methodology": "data and methods",
    "data and methodologies": "data and methods",
    "data & methods": "data and methods",
    "data collection and analysis": "data collection",
    "data collection and processing": "data collection",
    "data collection methods": "data collection",
    "study areas": "study area",
    "study site": "study area",
    "study sites": "study area",
    "study region": "study area",
    "study regions": "study area",
    "study location": "study area",
    "the study area": "study area",
    "site": "study area",
    "site description": "study area",
    "site descriptions": "study area",
    "site characteristics": "study area",
    "study site description": "study area",
    "description of the study area": "study area",
    "description of study area": "study area",
    "description of the study site": "study area",
    "overview of the study area": "study area",
    "study area description": "study area",
    "study area and data": "study area",
    "study area and datasets": "study area",
    "study area and dataset": "study area",
    "study area and sampling": "study area",
    "study area and data collection": "study area",
    "study area and materials": "study area",
    "study area and data sources": "study area",
    "area of study": "study area",
    "related works": "related work",
    "literature search": "literature review",
    "literature survey": "literature review",
    "review of literature": "literature review",
    "summary and conclusions": "summary",
    "summary and conclusion": "summary",
    "summary and discussion": "summary",
    "summary and outlook": "summary",
    "plant materials": "plant material",
    "plant material and growth conditions": "plant material",
    "plant materials and growth conditions": "plant material",
    "plant material and experimental design": "plant material",
    "plant materials and experimental design": "plant material",
    "plant materials and treatments": "plant material",
    "plant material and treatments": "plant material",
    "plant materials and stress treatments": "plant material",
    "plant materials and growing conditions": "plant material",
    "plant material and growing conditions": "plant material",
    "plant growth conditions": "plant material",
    "experimental designs": "experimental design",
    "design of experiments": "experimental design",
    "experiment design": "experimental design",
    "experimental design and treatments": "experimental design",
    "experimental design and statistical analysis": "experimental design",
    "treatments and experimental design": "experimental design",
    "experimental set-up": "experimental setup",
    "sensitivity analyses": "sensitivity analysis",
    "model description": "model",
    "model development": "model",
    "model setup": "model",
    "model structure": "model",
    "model overview": "model",
    "model calibration": "model validation",
    "model calibration and validation": "model validation",
    "calibration and validation": "model validation",
    "sampling design": "sampling",
    "sampling procedure": "sampling",
    "sampling procedures": "sampling",
    "sampling methods": "sampling",
    "sampling method": "sampling",
    "sampling strategy": "sampling",
    "study design and setting": "study design",
    "study design and participants": "study design",
    "study design and population": "study design",
    "subjects": "participants",
    "patients": "participants",
    "animals": "participants",
    "study population": "participants",
    "study subjects": "participants",
    "limitation": "limitations",
    "limitations of the study": "limitations",
    "limitations of this study": "limitations",
    "study limitations": "limitations",
    "limitation of the study": "limitations",
    "strengths and limitations": "limitations",
    "case studies": "case study",
    "objective": "objectives",
    "objectives of the study": "objectives",
    "research objectives": "objectives",
    "policy implications": "implications",
    "practical implications": "implications",
    "conclusions and recommendations": "recommendations",
    "conclusion and recommendations": "recommendations",
    "conclusions and recommendation": "recommendations",
    "conclusion and recommendation": "recommendations",
    "characterizations": "characterization",
    "chemicals and reagents": "chemicals",
    "reagents": "chemicals",
    "treatments": "treatment",
    "procedures": "procedure",
    "measures": "measurements",
    "experiments": "experiment",
    "datasets": "dataset",
    "samples": "sample",
}
STOPWORDS = frozenset("and or of the in for to a an with by".split())
JOURNAL_TERMS = ("journal of", "trans.", "intl.", "conf.", "univ.", "press", "adv.", "sci.", "lett.", "rev.", "res.", "phys.", "chem.", "biol.", "geophys.", "ann.", "bull.", "j.", "am.", "soc.", "ieee", "acm", "nature", "science", "cell", "publishing", "publisher", "editors", "ed.", "eds.", "ltd", "inc", "literature cited", "ph.d. thesis", "doctoral thesis", "springer")
PROSE_MARKERS = ("however", "therefore", "although", "furthermore", "in conclusion", "we found", "results show", "discussion", "abstract", "introduction", "as shown in", "the figure", "the table", "section")
# Enumeration markers before a header.
ROMAN, LETTER, DIGIT = r"^\s*(?:\([IVXLCDMivxlcdm]+\)|\[[IVXLCDMivxlcdm]+\]|[IVXLCDMivxlcdm]+\s*[.\-:)])\s*(?=[A-Za-z])", r"^\s*[A-Za-z]\s*[.\-:)\]]\s*(?=[A-Za-z])", r"^\s*(?:\(\d+(?:\.\d+)*\)|\[\d+(?:\.\d+)*\]|\d+(?:\.\d+)*)\s*[.\-:)]?\s*(?=[A-Za-z])"
MARKER = r"^\s*[(\[]?\s*(\d+(?:\.\d+)*|[IVXLCDMivxlcdm]+)\s*[.\-:)\]]*\s*([A-Za-z].*)$"
SUBSTANTIVE_CHARS, SUBSTANTIVE_LETTERS, MOST_SPECIAL = 40, 20, 0.3
#: Frequent words of the languages that the stand-in detector tells apart.
FREQUENT = {"en": ("the", "and", "of", "to", "in", "that", "is", "was", "for"), "fr": ("le", "la", "les", "de", "des", "et", "un", "que", "pas"), "de": ("der", "die", "und", "in", "das", "ist", "von", "mit", "ein"), "es": ("el", "la", "de", "que", "los", "en", "y", "una", "las")}

_PY_SPACE = r"[\s\x1c-\x1f\x85   -     　]+"


def contains_any(text: Column, terms) -> Column:
    """Whether a text holds any of the terms: a balanced OR of literal searches, which code generation sees."""
    return balanced([F.contains(text, F.lit(t)) for t in terms], lambda a, b: a | b)


def evaluated_once(value: Column) -> Column:
    """``value``, in a form that the optimizer copies neither into other columns nor into filters below: for costly ones that are read several times."""
    return F.when(F.rand(0) * 0.0 == 0.0, value)  # always true, but not deterministic in the eyes of the optimizer


def normalize_ws(text: Column) -> Column:
    """Runs of white space (as Unicode has it) become one space; ends are trimmed. Null stays null."""
    return F.trim(F.regexp_replace(text, _PY_SPACE, " "))


def normalized(text: str | None) -> str:
    return re.sub(r"\s+", " ", html.unescape(unicodedata.normalize("NFD", text))).strip() if text else ""


@F.pandas_udf(StringType())
def _normalize_any(text: pd.Series) -> pd.Series:
    return text.map(normalized, na_action=None)


def normalize_text(text: Column) -> Column:
    """Canonical decomposition, entities, then :func:`normalize_ws`; null becomes empty. ASCII without & stays in the JVM."""
    some = F.coalesce(text, F.lit(""))
    return F.when(some.rlike(r"[^\x00-\x7f]|&"), _normalize_any(text)).otherwise(normalize_ws(some))


def string_valid(text: Column) -> Column:
    """True without digits; else at most 30 % digits and at most 30 % characters that aren't ASCII letters or digits."""
    n = F.length(text)
    digits, special = n - F.length(F.regexp_replace(text, r"\p{Nd}+", "")), F.length(F.regexp_replace(text, "[a-zA-Z0-9]+", ""))
    return F.when(~text.rlike(r"\p{Nd}"), True).otherwise((digits <= n * MOST_SPECIAL) & (special <= n * MOST_SPECIAL))


def substantive(normal: Column) -> Column:
    """Of a normalised text: at least 40 characters, 20 of them ASCII letters."""
    return (F.length(normal) >= SUBSTANTIVE_CHARS) & normal.rlike(rf"^[^A-Za-z]*+(?:[A-Za-z][^A-Za-z]*+){{{SUBSTANTIVE_LETTERS}}}")


def word_count(text: Column) -> Column:
    """How many runs of characters other than spaces a text has; no list of them is made."""
    tidy = F.trim(F.regexp_replace(text, "  +", " "))
    return F.when(tidy == "", 0).otherwise(F.length(tidy) - F.length(F.replace(tidy, F.lit(" "))) + 1)


def strip_enumeration(header: Column) -> Column:
    """Without a leading roman, letter or digit marker: the first of the three forms that is there."""
    out = header
    for p in (DIGIT, LETTER, ROMAN):
        out = F.when(header.rlike(p), F.regexp_replace(header, p, "")).otherwise(out)
    return out


def keep_marker(header: Column, bare: Column | None = None) -> Column:
    """``marker. rest`` when something readable follows the marker, else what is left of it (``bare``: without the marker)."""
    bare = strip_enumeration(header) if bare is None else bare
    tidy = F.when(header.rlike(MARKER), F.concat(F.regexp_extract(header, MARKER, 1), F.lit(". "), F.regexp_extract(header, MARKER, 2))).otherwise(header)
    return F.when(bare == header, header).when(bare.rlike("[A-Za-z]{2,}"), tidy).otherwise(bare)


def apply_synonyms(header: Column) -> Column:
    """Canonical form of a normalised header, looked up as it is, then without its marker; else unchanged."""
    known = F.create_map(*(F.lit(x) for kv in SYNONYMS.items() for x in kv))
    return F.coalesce(F.try_element_at(known, header), F.try_element_at(known, F.trim(strip_enumeration(header))), header)


def structural_noise(header: Column) -> Column:
    """Markup within a section: no word of two letters, a lone marker, or a single token of at most three characters."""
    h = F.lower(F.trim(header))
    return ~h.rlike("[a-z]{2}") | h.rlike(r"^[ivxlcdm]+[.)]?$") | (~h.contains(" ") & (F.length(h) <= 3))


def header_noise(header: Column) -> Column:
    """A header whose section is dropped: structural noise, a label of a table or figure, an invalid string, or a short one with a term of NO_SKIP."""
    h = F.lower(F.trim(header))
    compact = F.regexp_replace(h, " ", "")
    listed = contains_any(compact, NO_SKIP) & (F.size(F.split(F.trim(h), r"\s+")) <= 3)
    return structural_noise(header) | h.rlike(r"^(table|fig|figure)\s*[-.]?\s*\d*$") | ~string_valid(header) | listed


def _fragmented(tokens: list[str]) -> bool:
    """Whether tokens look like one word that text recognition has torn apart."""
    n = len(tokens)
    if n < 2 or not all(t.isascii() and t.isalpha() for t in tokens):
        return False
    sizes = [len(t) for t in tokens]
    caps = sum(t.isupper() for t in tokens)
    if caps == n and min(sizes) <= 3 and sum(sizes) <= 12:
        return True
    short = sum(s <= 4 for s in sizes)
    most = max(2, n - 1)
    return short >= 2 and caps >= most and (min(sizes) <= 2 or short >= most)


def _repaired(text: str) -> str:
    """Torn words joined, within the runs between stop words; these are lower-cased."""
    out: list[str] = []
    run: list[str] = []
    for t in [*text.split(), None]:
        if t is not None and t.lower() not in STOPWORDS:
            run.append(t)
            continue
        if run:
            out.append("".join(run) if _fragmented(run) else " ".join(run))
        run = []
        if t is not None:
            out.append(t.lower())
    return " ".join(out)


_GARBAGE = re.compile("[�­​-‍﻿]")
_MOJIBAKE = re.compile(r"(?:(?<=^)|(?<=\s))[âÃïÂ][^\sA-Za-z0-9]*(?=\s|$)")
_EDGES = " \t\n\r\f\v.,;:!?-[](){}\"'`"


def _surface(header: str | None) -> str:
    """A header up to the repair of torn words: garbage and bullets gone, dashes and white space unified."""
    h = _MOJIBAKE.sub("", _GARBAGE.sub("", (header or "").strip().replace(" ", " ")))
    h = normalized(h.translate({0x2013: "-", 0x2014: "-", 0x2212: "-"}))
    return _repaired(re.sub(r"^\s*[|*#]+\s*", "", h))


@F.pandas_udf(StringType())
def _surface_any(header: pd.Series) -> pd.Series:
    return header.map(_surface, na_action=None)


def normalize_header(header: Column) -> Column:
    """Cleaned, lower-cased header; an enumeration marker stays when words follow it."""
    edge = r"""[\s.,;:!?\-\[\](){}"'`]+"""
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(keep_marker(_surface_any(header)), f"^{edge}", ""), f"{edge}$", "")))


def with_canonical_header(rows: DataFrame, raw: str, out: str = "header") -> DataFrame:
    """``rows`` with the canonical form of a raw header, as by :func:`normalize_header` and :func:`apply_synonyms`, each step computed once a row."""
    edge = r"""[\s.,;:!?\-\[\](){}"'`]+"""
    rows = rows.withColumn("__h", evaluated_once(_surface_any(F.col(raw))))
    rows = rows.withColumn("__b", evaluated_once(strip_enumeration(F.col("__h"))))
    rows = rows.withColumn("__k", evaluated_once(keep_marker(F.col("__h"), F.col("__b"))))
    rows = rows.withColumn("__n", evaluated_once(F.lower(F.trim(F.regexp_replace(F.regexp_replace("__k", f"^{edge}", ""), f"{edge}$", "")))))
    return rows.withColumn(out, evaluated_once(apply_synonyms(F.col("__n")))).drop("__h", "__b", "__k", "__n")


# Fixed values of the reference score: patterns and points.
DOI, STARTS_NUMBERED, YEAR_IN_BRACKETS, YEAR_AT_END, YEAR = r"10\.\d{4,}/", r"^(\[\d+\]|\d+\.)", r"[(,]\s*(19|20)\d{2}[).]", r"\b(19|20)\d{2}[a-z]?\s*[).]", r"\b(19|20)\d{2}\b"
VOLUME, PAGES, LAST_FIRST, FIRST_LAST, NOT_A_NAME = r"\b(vol\.|no\.|pp\.|p\.)\s*\d+", r"\d+\s*:\s*\d+[-–]\d+", r"^[A-Z][a-z]+,\s+[A-Z]\.", r"^[A-Z]\.([A-Z]\.)?\s+[A-Z][a-z]+", r"^(fig\.|table|vol\.|p\.|pp\.|u\.s\.)"
FIRST_PERSON, CAPTION = r"\b(we|our)\b", r"^(figure|fig\.|table|tab\.)\s*\d+"


def _points(t: Column, low: Column, bare: Column, low_bare: Column) -> Column:
    """The score before the rules that look at it or at the length."""
    def gain(test: Column, points: int) -> Column:
        return F.when(test, points).otherwise(0)

    parts = [
        gain(t.rlike(DOI), 8),
        gain(contains_any(t, ("http://", "https://")) | contains_any(low, ("retrieved from", "accessed:", "accessed,", "available at:")), 4),
        gain(bare.rlike(STARTS_NUMBERED), 6),
        gain(contains_any(low, ("et al.", "et al,")), 4),
        gain(contains_any(low, ("arxiv", "ssrn", "proc.")), 5),
        gain(contains_any(low, JOURNAL_TERMS), 3),
        F.when(t.rlike(YEAR_IN_BRACKETS) | t.rlike(YEAR_AT_END), 2).when(t.rlike(YEAR), 1).otherwise(0),
        gain(low.rlike(VOLUME) | t.rlike(PAGES), 3),
        gain(bare.rlike(LAST_FIRST), 3),
        gain(bare.rlike(FIRST_LAST) & ~low_bare.rlike(NOT_A_NAME), 1),
        gain(contains_any(low, PROSE_MARKERS), -5),
        gain(low.rlike(FIRST_PERSON), -3),
        gain(low_bare.rlike(CAPTION), -10),
    ]
    return balanced(parts, lambda a, b: a + b)


def _final(t: Column, bare: Column, points: Column) -> Column:
    long = t.rlike(r"\S++(?:\s++\S++){15}")
    lone = F.regexp_count(t, F.lit(r"(?<![^ ])[^ ]\.?(?![^ ])"))
    return points + F.when((points < 2) & bare.endswith(".") & long, -2).otherwise(0) + F.when(lone / (F.length(t) - F.length(F.replace(t, F.lit(" "))) + 1) > 0.10, 3).otherwise(0)


def reference_score(text: Column) -> Column:
    """How much a paragraph looks like an entry of a reference list. For whole tables :func:`with_reference_score` does less."""
    low, bare = F.lower(text), normalize_edges(text)
    return _final(text, bare, _points(text, low, bare, normalize_edges(low)))


def with_reference_score(rows: DataFrame, text: str, out: str = "score") -> DataFrame:
    """``rows`` with :func:`reference_score`; its parts are computed once a row, in projections of their own."""
    t = F.col(text)
    staged = rows.withColumns({"__low": evaluated_once(F.lower(t)), "__bare": evaluated_once(normalize_edges(t))})
    staged = staged.withColumn("__points", evaluated_once(_points(t, F.col("__low"), F.col("__bare"), F.lower("__bare"))))
    return staged.withColumn(out, _final(t, F.col("__bare"), F.col("__points"))).drop("__low", "__bare", "__points")


def normalize_edges(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


@F.pandas_udf(BooleanType())
def _dominant(text: pd.Series) -> pd.Series:
    return text.map(noise.or_none(noise.dominant))


@F.pandas_udf(StringType())
def _stripped(text: pd.Series) -> pd.Series:
    return text.map(noise.or_none(noise.strip))


@F.pandas_udf(ArrayType(StringType()))
def _cleaned(parts: pd.Series) -> pd.Series:
    return parts.map(noise.or_none(lambda x: noise.cleaned(list(x))))


def url_dominant(text: Column) -> Column:
    """Whether URLs make up more than a third of a text."""
    return _dominant(text)


def strip_noise(text: Column) -> Column:
    """Without URLs and phone numbers, every place where their text occurs; runs of three or more other signs become a space."""
    return _stripped(text)


def clean_subsections(parts: Column) -> Column:
    """Subsections with their lines trimmed and joined; empty ones and those mostly of URLs go, others lose noise."""
    return _cleaned(F.transform(parts, lambda p: F.array_join(F.transform(F.split(p, "\n"), normalize_edges), "")))


def stopword_language(text: Column) -> Column:
    """The language with most frequent words in a text, ties in the order of FREQUENT; null without any. Stands in for a detector."""
    low = F.lower(F.coalesce(text, F.lit("")))

    def found(own: tuple[str, ...]) -> Column:
        return F.regexp_count(low, F.lit(rf"(?<!\p{{L}})(?:{'|'.join(sorted(own, key=len, reverse=True))})(?!\p{{L}})"))

    # each count is named once: within conditions, what is named several times is computed as often
    one = lambda n, place, lang: F.named_struct(F.lit("n"), n, F.lit("place"), F.lit(place), F.lit("lang"), F.lit(lang).cast("string"))
    each = [one(found(own), -i, lang) for i, (lang, own) in enumerate(FREQUENT.items())]
    return F.array_max(F.array(one(F.lit(0), 1, None), *each))["lang"]
