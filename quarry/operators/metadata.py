"""Metadata of documents from CSV files or a database, and the packaged form of a document."""

from __future__ import annotations

import ast

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

#: The fields of a packaged document, in order.
FIELDS = ("source", "title", "text", "abstract", "authors", "publisher", "date", "unique_id", "doi", "references")


def read_csv(spark: SparkSession, path: str, key: str = "paper_id") -> DataFrame:
    """Rows of CSV files with a header; of several rows with one key the last, by file and line."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    names = [c for c in rows.columns if c != key]
    # a file is one task, so rows of a file keep their order
    at = rows.select(F.trim(key).alias(key), F.struct(*names).alias("__m"), F.struct(F.col("_metadata.file_path").alias("f"), F.monotonically_increasing_id().alias("i")).alias("__at"))
    last = at.where(F.col(key) != "").groupBy(key).agg(F.max_by("__m", "__at").alias("m"))
    return last.select(key, *(F.col(f"m.{c}").alias(c) for c in names))


def read_csv_ids(spark: SparkSession, path: str, position: int = 6) -> DataFrame:
    """Distinct ids (doc_id) at a position of CSV files, header skipped."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return rows.select(F.trim(F.col(f"`{rows.columns[position]}`")).alias("doc_id")).where("doc_id <> ''").distinct()


def read_jdbc(spark: SparkSession, url: str, table: str, key: str = "corpus_id", order: tuple[str, ...] = (), **options: str) -> DataFrame:
    """A metadata table of a database, one row per key; read once and in parallel where ``options`` partition it.

    Of rows with one key the least by ``order``, then by all columns in their order, nulls first, so every run gives the same.
    """
    rows = spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    every = F.struct(*rows.columns)
    one = rows.groupBy(key).agg(F.min_by(every, F.struct(*order, every)).alias("__m"))
    return one.select(*(F.col(f"__m.{c}").alias(c) for c in rows.columns))


@F.pandas_udf(ArrayType(StringType()))
def authors(listed: pd.Series) -> pd.Series:
    """Names out of the text of a list of {first, last}; anything else gives none."""
    def names(text: str | None) -> list[str]:
        try:
            found = ast.literal_eval(text or "[]")
            return [n for n in (f"{a.get('first', '')} {a.get('last', '')}".strip() for a in found) if n]
        except (ValueError, SyntaxError, AttributeError, TypeError):
            return []

    return listed.map(names, na_action=None)


def _taken(sections: Column, name: str) -> Column:
    return F.coalesce(F.try_element_at(sections, F.lit(name)), F.lit(""))


def packaged(docs: DataFrame, source: str, meta: DataFrame | None = None, key: str = "corpus_id", titled: bool = False) -> DataFrame:
    """Documents (``key``, sections: map of header to text) in the form of ``FIELDS``.

    Without ``meta`` title, abstract and references are taken out of the sections (lower-case headers). With it the
    title, author, publisher, date and doi of the least row of a key count, documents without a row are left out, and with ``titled`` the
    capitalised Abstract and References are taken out of the sections; otherwise those keep everything and the abstract
    and authors come from ``meta`` as well.
    """
    sections = F.coalesce("sections", F.create_map().cast("map<string,string>"))
    if meta is None:
        names = ("title", "abstract", "references")
        kept = F.map_filter(sections, lambda k, v: ~k.isin(*names))
        field = {n: _taken(sections, n) for n in names} | {"authors": F.array().cast("array<string>"), "publisher": F.lit(""), "date": F.lit("0"), "doi": F.lit("")}
        rows = docs
    else:
        have = set(meta.columns)
        get = lambda c, default="": F.coalesce(F.col(f"__m.{c}").cast("string"), F.lit(default)) if c in have else F.lit(default)
        one = meta.groupBy(F.col(key).cast("string").alias(key)).agg(F.min(F.struct(*meta.columns)).alias("__m"))
        rows = docs.withColumn(key, F.col(key).cast("string")).join(one, key)
        kept = F.map_filter(sections, lambda k, v: ~k.isin("Abstract", "References") | (v == "")) if titled else sections
        people = authors(F.col("__m.authors")) if "authors" in have else F.when(get("author") != "", F.array(get("author"))).otherwise(F.array().cast("array<string>"))
        field = {"title": get("title"), "abstract": _taken(sections, "Abstract") if titled else get("abstract"), "references": _taken(sections, "References") if titled else F.lit(""), "authors": people, "publisher": get("publisher"), "date": get("year" if "year" in have else "date", "0"), "doi": get("doi")}
    field |= {"source": F.lit(source), "text": kept, "unique_id": F.col(key).cast("string")}
    return rows.select(*(field[n].alias(n) for n in FIELDS))
