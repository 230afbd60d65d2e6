"""Readers and writers of document dumps: explicit schemas, a quarantine for bad rows, a ledger for resumed runs."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import normalize_edges
from quarry.sources.discovery import listed
from quarry.sources.members import gzip_lines

#: Names that hold a run's own records, not documents.
ARTIFACTS = ("batch_checkpoint.json", "duckdb_checkpoint.json", "failures.json", "filter_report.json", "judge_checkpoint.json", "judge_summary.json", "sectionization_report.json")
_TEXT = "struct<text:string,annotations:map<string,string>,source:struct<pdfurls:array<string>,pdfsha:string,oainfo:struct<license:string,openaccessurl:string,status:string>>>"
RAW = f"corpusid string, title string, externalids map<string,string>, body {_TEXT}, content {_TEXT}, _corrupt string"
LEGACY = "corpus_id array<string>, title array<string>, abstract array<string>, paragraph array<string>, sectionheader array<string>"


def bucket(doc_id: Column) -> Column:
    """The last two characters of an id, or all of a shorter one: the folder of its files."""
    return F.when(F.length(doc_id) >= 2, F.right(doc_id, F.lit(2))).otherwise(doc_id)


def read_shards(spark: SparkSession, paths: str | list[str], by_member: bool = False) -> tuple[DataFrame, DataFrame]:
    """Documents of (gzip) NDJSON shards in either layout, and the lines that don't parse.

    A gzip shard is one task: repartition after. ``by_member`` reads a list of gzip files by the members that they are made
    of, in as many tasks as they have ranges.
    """
    if by_member:
        lines = gzip_lines(spark, paths).select(F.col("path").alias("shard"), "value")
    else:
        lines = spark.read.text(paths).where("trim(value) <> ''").select(F.col("_metadata.file_path").alias("shard"), "value")
    rows = lines.select("shard", "value", F.from_json("value", RAW, {"columnNameOfCorruptRecord": "_corrupt"}).alias("d"))
    good = rows.where("d._corrupt is null").select("d.*", "shard").drop("_corrupt")
    return good, rows.where("d._corrupt is not null").select("shard", F.col("value").alias("line"))


def read_strict(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """As :func:`read_shards`, but a line that doesn't parse is an error; for audits."""
    return spark.read.schema(RAW.rsplit(",", 1)[0]).option("mode", "FAILFAST").json(paths)


def read_legacy(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Multi-valued documents, alone or as the first of ``response.docs``."""
    rows = spark.read.schema(f"{LEGACY}, response struct<docs:array<struct<{LEGACY.replace(' array', ':array')}>>>".replace(", ", ",")).json(paths)
    names = [c.split()[0] for c in LEGACY.split(", ")]
    return rows.select(*(F.coalesce(F.try_element_at("response.docs", F.lit(1))[c], F.col(c)).alias(c) for c in names))


def read_exports(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(path, pos, item) of JSON files that hold a list, ``response.docs`` or one document; and the files that hold neither."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.try_parse_json("value").alias("v"))
    as_list = F.try_variant_get("v", "$", "array<variant>")
    inner = F.try_variant_get("v", "$.response.docs", "array<variant>")
    one = F.when(F.try_variant_get("v", "$.corpus_id", "variant").isNotNull() | F.try_variant_get("v", "$.corpusid", "variant").isNotNull(), F.array("v"))
    rows = files.withColumn("items", F.coalesce(as_list, inner, one))
    return rows.select("path", F.posexplode("items").alias("pos", "item")), rows.where("items is null").select("path")


def read_sectionized(spark: SparkSession, path: str) -> DataFrame:
    """(path, header, text) of sectionized JSON files, artifacts skipped, white space unified, empty sections left out."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(path, wholetext=True)
    files = files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"), "value").where(~F.col("name").isin(*ARTIFACTS))
    return files.select("path", F.explode(F.from_json("value", "map<string,string>")).alias("header", "text")).where("trim(text) <> ''")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct ids from a JSON array file or a text file with one id a line."""
    if path.endswith(".json"):
        ids = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "array<string>")).alias("doc_id"))
    else:
        ids = spark.read.text(path).select(F.trim("value").alias("doc_id"))
    return ids.where("doc_id <> ''").distinct()


def count_numeric_stems(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    """Distinct numeric stems of the files under a folder, in folders whose names begin with ``prefix``, sorted; empty files count as well."""
    names = [p.rsplit("/", 2)[-2:] for p in listed(spark, path)]  # a name per file
    stems = sorted({n.split(".")[0] for folder, n in names if folder.startswith(prefix) and re.fullmatch("[0-9]+", n.split(".")[0])})
    return spark.createDataFrame([(x,) for x in stems], "stem string")


def write_documents(docs: DataFrame, path: str, id_col: str, shard: str, line: str) -> None:
    """Bucketed JSON, one document per id; of several the first by shard and line."""
    one = docs.groupBy(id_col).agg(F.min_by(F.struct(*(c for c in docs.columns if c != id_col)), F.struct(shard, line)).alias("d")).select(id_col, "d.*")
    one.withColumn("bucket", bucket(F.col(id_col).cast("string"))).write.partitionBy("bucket").mode("append").json(path)


def write_report(reports: DataFrame, path: str) -> None:
    """Per-document rows as gzip JSON lines, null fields left out."""
    reports.write.mode("append").option("compression", "gzip").json(path)


def write_summary(one_row: DataFrame, path: str) -> None:
    """One row as a JSON file, put in place by a rename."""
    import os
    import tempfile

    row = one_row.toJSON().first() if one_row.columns else "{}"
    with tempfile.NamedTemporaryFile("w", dir=os.path.dirname(path) or ".", delete=False) as f:
        json.dump(json.loads(row or "{}"), f, indent=2, sort_keys=True)
    os.replace(f.name, path)


def write_matches(found: DataFrame, path: str, terms: str = "terms", paths: bool = True) -> None:
    """CSV of matches, terms sorted and joined by ``; ``."""
    out = found.withColumn(terms, F.concat_ws("; ", F.array_sort(terms)))
    (out if paths else out.drop("path")).write.mode("overwrite").option("header", True).csv(path)


#: Annotations that may hold a title, in the order they are tried.
TITLES = ("title", "papertitle", "paper_title", "doctitle")


def best_title(title: Column, text: Column, annotations: Column | None = None) -> Column:
    """A document's title, else the first non-empty span of a title annotation, else the first line of its text with something in it."""
    lines = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"), lambda x: F.trim(x)), lambda x: x != "")
    found = [F.when(F.trim(title) != "", F.trim(title))]
    for key in TITLES if annotations is not None else ():
        cut = F.transform(spans(F.try_element_at(annotations, F.lit(key))), lambda s: normalize_edges(F.substring(F.coalesce(text, F.lit("")), s["s"] + 1, F.greatest(s["e"] - s["s"], F.lit(0)))))
        found.append(F.try_element_at(F.filter(cut, lambda x: x != ""), F.lit(1)))
    return F.coalesce(*found, F.try_element_at(lines, F.lit(1)), F.lit(""))


def spans(annotation: Column) -> Column:
    """[(s, e)] sorted by start (stable) from a JSON list of {start, end}; numbers in quotes count, others drop the span."""
    raw = F.from_json(annotation, "array<struct<start:string,end:string>>")
    cast = F.transform(F.coalesce(raw, F.array().cast("array<struct<start:string,end:string>>")), lambda x, i: F.struct(x["start"].try_cast("int").alias("s"), i.alias("i"), x["end"].try_cast("int").alias("e")))
    good = F.filter(cast, lambda x: x["s"].isNotNull() & x["e"].isNotNull() & (x["s"] >= 0) & (x["e"] >= 0))
    return F.transform(F.array_sort(good), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))


def external_ids(*maps: Column) -> Column:
    """The first of the maps (in their spellings externalids, external_ids, externalIds) with an id in it, empty values left out; else an empty map."""
    kept = [F.map_filter(m, lambda k, v: v.isNotNull() & (v != "")) for m in maps]
    return F.coalesce(*(F.when(F.size(m) > 0, m) for m in kept), F.create_map().cast("map<string,string>"))


def full_text(docs: DataFrame) -> Column:
    """Title and body text (else content text) of raw documents, joined by a space; what exclusion patterns look at."""
    own = [F.when(F.col(f"{c}.text") != "", F.col(f"{c}.text")) for c in ("body", "content") if c in docs.columns]
    return F.concat_ws(" ", F.when(F.col("title") != "", F.col("title")), F.coalesce(*own, F.lit(None).cast("string")))


def failures(lines: DataFrame, error: str = "invalid JSON") -> DataFrame:
    """Failure records (corpus_id, title, external_ids, batch_file, line_number, error) of numbered lines (path, line_number, value) that don't parse."""
    rows = lines.withColumn("d", F.from_json("value", RAW, {"columnNameOfCorruptRecord": "_corrupt"})).where("d._corrupt is not null")
    return rows.select(F.lit(None).cast("string").alias("corpus_id"), F.lit("").alias("title"), F.create_map().cast("map<string,string>").alias("external_ids"), F.col("path").alias("batch_file"), "line_number", F.lit(error).alias("error"))


def open_access_urls(docs: DataFrame) -> Column:
    """Distinct URLs of a document's sources, body before content."""
    parts = [F.array(F.col(f"{c}.source.oainfo.openaccessurl")) if k == 0 else F.coalesce(F.col(f"{c}.source.pdfurls"), F.array().cast("array<string>")) for c in ("body", "content") if c in docs.columns for k in (0, 1)]
    return F.array_distinct(F.filter(F.concat(*parts), lambda u: u.isNotNull() & (u != "")))
