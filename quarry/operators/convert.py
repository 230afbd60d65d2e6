"""Conversion of markup and recognised text to sections."""

from __future__ import annotations

import contextlib
from html import entities
from xml.parsers import expat

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from quarry.functions.text import clean_subsections, evaluated_once, normalize_edges, normalize_text, stopword_language
from quarry.plans.keyword import balanced


def merge_paragraphs(paras: Column) -> Column:
    """Paragraphs joined by blank lines; one that goes on after a line without . ! ? is joined by a space."""
    def step(out: Column, p: Column) -> Column:
        return F.when(out == "", p).when(~out.rlike(r"[.!?]$"), F.concat(out, F.lit(" "), p)).otherwise(F.concat(out, F.lit("\n\n"), p))

    return F.aggregate(F.filter(paras, lambda p: F.trim(p) != ""), F.lit(""), step)


def html_sections(pages: DataFrame) -> DataFrame:
    """page_id, title (first h1), n_paragraphs, chars of the paragraphs; unclosed tags end at the next block tag."""
    body = F.regexp_replace(F.coalesce("html", F.lit("")), r"(?s)<(script|style)\b.*?</\1>|<!--.*?-->", "")
    text = lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, r"<[^>]*>", " "), r"\s+", " "))
    title = text(F.regexp_extract(body, r"(?s)<h1[^>]*>(.*?)(?:</h1>|<p\b|$)", 1))
    paras = F.filter(F.transform(F.regexp_extract_all(body, F.lit(r"(?s)<p(?:\s[^>]*)?>(.*?)(?=</p>|<p[\s>]|</article>|</body>|$)"), F.lit(1)), text), lambda p: p != "")
    return pages.select("page_id", title.alias("title"), F.size(paras).cast("long").alias("n_paragraphs"), F.length(F.array_join(paras, "")).cast("long").alias("chars"))


# Heads that open no section of a TEI document, and how paragraphs that are left out begin.
HEADS = ("abstract", "caption", "figure", "table", "acknowledgments", "acknowledgements", "references", "bibliography", "author contributions", "author affiliations", "keywords")
BEGINNINGS = ("acknowledgments", "acknowledgements", "references", "bibliography", "author contributions")


def _is_english(text: Column) -> Column:
    return F.coalesce(stopword_language(text) == "en", F.lit(False))


class _Blocks:
    """Abstract and blocks of a TEI document as a parser comes upon them; names count without their namespaces' prefixes.

    A block is a ``div`` of the first ``body`` in document order, with its first head and all its paragraphs, those of divs
    within it too. A document that breaks off or isn't well formed gives what stands before that place.
    """

    def __init__(self, xml: str):
        self.abstract: list[str] | None = None
        self.blocks: list[tuple[list[list[str]], list[list[str]]]] = []
        self._open: list[tuple[str, list[str] | None]] = []
        self._divs: list[tuple[list[list[str]], list[list[str]]]] = []
        self._place = None  # body or abstract, while in the first of them
        self._seen: set[str] = set()
        parser = expat.ParserCreate()
        parser.UseForeignDTD(True)  # so that entities of HTML, which no declaration names, are told instead of an error
        parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = self._start, self._end, self._text
        parser.SkippedEntityHandler = lambda name, parameter: self._text(entities.html5.get(f"{name};", ""))
        with contextlib.suppress(expat.ExpatError):
            parser.Parse(xml.lstrip("\ufeff \t\r\n").encode("utf-8", "replace"), True)

    def _start(self, tag: str, _: dict) -> None:
        name, text = tag.rsplit(":", 1)[-1], None
        if name in ("body", "abstract") and name not in self._seen:
            self._seen.add(name)
            self._place = name
        elif self._place == "body" and name == "div":
            self._divs.append(([], []))
            self.blocks.append(self._divs[-1])
        elif self._place == "body" and name in ("head", "p") and self._divs:
            text = []
            for heads, paragraphs in self._divs:
                (heads if name == "head" else paragraphs).append(text)
        elif self._place == "abstract" and name == "p" and self.abstract is None:
            text = self.abstract = []
        self._open.append((name, text))

    def _end(self, tag: str) -> None:
        name, _ = self._open.pop()
        if name == "div" and self._place == "body":
            self._divs.pop()
        elif name == self._place:
            self._place = None

    def _text(self, data: str) -> None:
        for _, text in self._open:
            if text is not None:
                text.append(data)


_STRINGS = ArrayType(StringType())
_TEI = StructType([StructField("abstract", StringType()), StructField("blocks", ArrayType(StructType([StructField("head", StringType()), StructField("ps", _STRINGS)])))])
_TEI_ROWS = StructType([StructField("path", StringType()), StructField("idx", IntegerType()), StructField("head", StringType()), StructField("paragraphs", _STRINGS)])


def _parsed(xml: str | None) -> tuple[str | None, list[tuple[str, list[str]]]]:
    found = _Blocks(xml or "")
    join = lambda parts: "".join(parts).strip()
    return None if found.abstract is None else join(found.abstract), [(join(heads[0]) if heads else "", [join(p) for p in ps]) for heads, ps in found.blocks]


@F.pandas_udf(_TEI)
def _tei(value: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([(a, [{"head": h, "ps": ps} for h, ps in blocks]) for a, blocks in map(_parsed, value)], columns=["abstract", "blocks"])


@F.udtf(returnType=_TEI_ROWS)
class TeiSections:
    """Table function: the blocks of TEI documents (path, value) as they stand; idx -1 is the abstract."""

    def eval(self, row):
        abstract, blocks = _parsed(row["value"])
        if abstract:
            yield row["path"], -1, "abstract", [abstract]
        for idx, (head, paragraphs) in enumerate(blocks):
            yield row["path"], idx, head, paragraphs


def tei_sections(files: DataFrame, english=_is_english) -> DataFrame:
    """path, idx, header, text of the abstract (idx -1) and of each ``div`` of TEI documents (path, value).

    Divs are numbered in document order, and one has the paragraphs of those within it, too. A section's header is its
    head, else the first sentence of its first paragraph, which that paragraph then loses; a div with neither is left out,
    and so is one whose header holds a word of ``HEADS``. Paragraphs that begin like ``BEGINNINGS`` or aren't English are
    left out, the others merged (see :func:`merge_paragraphs`). Comments are no text, CDATA is.
    """
    parsed = files.select("path", evaluated_once(_tei("value")).alias("t"))
    rows = parsed.select("path", F.posexplode("t.blocks").alias("idx", "d"))
    rows = rows.select("path", "idx", normalize_text(F.col("d.head")).alias("head"), F.posexplode_outer("d.ps").alias("at", "p"))
    rows = rows.withColumn("p", normalize_text(F.coalesce("p", F.lit(""))))
    sentence = F.regexp_extract("p", r"^(.+?[.!?])\s", 1)
    first = (F.col("head") == "") & (F.col("at") == 0)
    rows = rows.withColumn("key", F.when(first, sentence)).withColumn("p", F.when(first & (sentence != ""), normalize_edges(F.expr("substring(p, length(key) + 1)"))).otherwise(F.col("p")))
    begins = lambda t: F.lower(t).rlike("^(" + "|".join(BEGINNINGS) + ")")
    kept = F.when(F.col("at").isNotNull() & ~begins(F.col("p")) & english(F.col("p")), F.struct("at", "p"))
    docs = rows.groupBy("path", "idx", "head").agg(F.max("key").alias("key"), F.array_sort(F.collect_list(kept)).alias("ps"))
    header = F.when(F.col("head") != "", F.col("head")).otherwise(F.coalesce("key", F.lit("")))
    found = docs.select("path", "idx", header.alias("header"), merge_paragraphs(F.transform("ps", lambda x: x["p"])).alias("text"))
    found = found.where((F.col("header") != "") & ~F.col("header").rlike(r"(?i)\b(?:" + "|".join(HEADS) + r")\b"))
    top = parsed.select("path", F.lit(-1).alias("idx"), F.lit("abstract").alias("header"), normalize_text(F.col("t.abstract")).alias("text")).where("text <> ''")
    return top.unionByName(found)


def recognised_text(files: DataFrame) -> DataFrame:
    """path, parts of recognised text files (path, value): split at two blank lines and cleaned."""
    return files.select("path", clean_subsections(F.split("value", "\n\n\n")).alias("parts"))


def read_recognised(spark: SparkSession, path: str, charset: str = "UTF-8") -> DataFrame:
    """path, value of recognised text files of a folder; bytes that aren't valid UTF-8 are read as Latin-1, the other common case."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).select("path", "content")
    text = F.try_validate_utf8(F.col("content").cast("string")) if charset.upper() == "UTF-8" else F.decode("content", charset)
    return files.select("path", F.coalesce(text, F.decode("content", "iso-8859-1")).alias("value"))


def recognised_documents(files: DataFrame, source: str) -> DataFrame:
    """Packaged documents (see ``metadata.package``) of recognised text files (path, value), and path.

    Title, abstract, authors, publisher, year and number come from tags at the top; the body is the cleaned text with the
    number taken out of its first part. A file without one of the tags (authors may lack) is left out.
    """
    tag = lambda name: F.regexp_extract("value", f"<{name}>(.*?)</{name}>", 1)
    has = [F.col("value").rlike(f"<{name}>.*?</{name}>") for name in ("pubnumber", "title", "abstract", "publisher")] + [F.col("value").rlike(r"<pubyear>\s*\d+\s*</pubyear>")]
    authors = F.regexp_extract_all("value", F.lit("<author>(.*?)</author>"), F.lit(1))
    rows = files.where(balanced(has, lambda a, b: a & b)).select("path", tag("title").alias("title"), tag("abstract").alias("abstract"), authors.alias("authors"), tag("publisher").alias("publisher"), F.trim(tag("pubyear")).alias("date"), tag("pubnumber").alias("unique_id"), clean_subsections(F.split(F.regexp_replace("value", "<[^>]+>", ""), "\n\n\n")).alias("parts"))
    body = F.array_join(F.transform("parts", lambda p, i: F.when(i == 0, F.replace(p, F.col("unique_id"), F.lit(""))).otherwise(p)), " ")
    return rows.select("path", F.lit(source).alias("source"), "title", F.create_map(F.lit("body"), body).alias("text"), "abstract", "authors", "publisher", "date", "unique_id", F.lit("").alias("doi"), F.lit("").alias("references"))
