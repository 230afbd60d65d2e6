"""Which files a run reads, and rewriting whole datasets file by file.

Listings go through Hadoop's file systems, so any store that Spark reads will do; what the driver holds is a row per file.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.operators.requests import send_all
from quarry.operators.search import matched_patterns
from quarry.scratch import saved, split_join

#: Requests a second that an id service takes (a fixed value of the service).
FETCH_RATE = 180.0
#: Blocks of files whose offsets are broadcast (some 200 bytes each).
MOST_BLOCKS = 200_000


def listed(spark: SparkSession, folder: str, depth: int | None = None) -> list[str]:
    """Paths of the files under a folder, sorted; names that begin with a dot are skipped. ``depth`` 0 is the folder alone."""
    jvm = spark._jvm
    top = jvm.org.apache.hadoop.fs.Path(folder)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    out, level, n = [], [top], 0
    while level:
        below = []
        for place in level:
            for s in fs.listStatus(place):
                if not s.getPath().getName().startswith("."):
                    (below if s.isDirectory() else out).append(s.getPath() if s.isDirectory() else s.getPath().toString())
        level, n = (below, n + 1) if depth is None or n < depth else ([], n)
    return sorted(out)


def _root(spark: SparkSession, folder: str) -> str:
    """The path of a folder in its file system, with a slash at its end."""
    top = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return top.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(top).toUri().getPath().rstrip("/") + "/"


def _within(spark: SparkSession, folder: str, path: str) -> list[str]:
    """Names of the folders and the file on the way from ``folder`` to ``path``."""
    return path.split(_root(spark, folder), 1)[-1].split("/")


def document_files(spark: SparkSession, folder: str) -> list[str]:
    """The JSON files of a folder and of its direct child folders."""
    return [p for p in listed(spark, folder, 1) if p.lower().endswith(".json")]


def batch_files(spark: SparkSession, folder: str) -> list[str]:
    """The .jsonl.gz files of a folder, then those of the folders named batches in its child folders."""
    found = [(_within(spark, folder, p), p) for p in listed(spark, folder, 2) if p.endswith(".jsonl.gz")]
    return [p for x, p in found if len(x) == 1] + [p for x, p in found if len(x) == 3 and x[1] == "batches"]


def dataset_files(spark: SparkSession, folder: str) -> tuple[list[str], list[str]]:
    """(files of JSON lines: .jsonl and .gz, files of one JSON document) anywhere under a folder."""
    every = listed(spark, folder)
    lines = [p for p in every if p.endswith(".jsonl")]
    return lines + [p for p in every if p.endswith(".gz")], [p for p in every if p.endswith(".json")]


def apart(source: str, output: str) -> None:
    """An output must not be its source nor lie within it, or a next run would read it."""
    a, b = (x.rstrip("/") for x in (source, output))
    if b == a or b.startswith(a + "/"):
        raise ValueError(f"the output {output} must not be within the source {source}")


def numbered_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, line_number, value) of the lines of text files, numbered from 1 within a file; blank lines are numbered but left out.

    A file that can be split is read in blocks, a gzip file as a whole; :func:`quarry.sources.members.gzip_lines` splits those too.
    """
    files = spark.read.text(paths, lineSep="\n").select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    # lines of a block have consecutive ids; the counts of the blocks before give the rest
    count = files.groupBy("path", "block").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offset = saved(count.select("path", "block", "first", before.alias("before")), "block-offsets")
    small = offset.count() <= MOST_BLOCKS  # a row per block of a file
    rows = files.join(F.broadcast(offset), ["path", "block"]) if small else split_join(files, offset, ["path", "block"])
    return rows.where("trim(value) <> ''").select("path", (F.col("at") - F.col("first") + F.col("before") + 1).alias("line_number"), "value")


def _matched(value: Column, patterns: list[str]) -> tuple[Column, Column]:
    """Whether a JSON text is a document, and the patterns found in its title, abstract, body and paragraphs."""
    v = F.try_parse_json(value)
    get = lambda path: F.coalesce(F.try_variant_get(v, path, "string"), F.lit(""))
    first = lambda name: F.coalesce(F.try_variant_get(v, f"$.{name}[0]", "string"), F.try_variant_get(v, f"$.{name}", "string"), F.lit(""))
    body = F.when(get("$.body.text") != "", get("$.body.text")).otherwise(get("$.content.text"))
    paragraphs = F.array_join(F.coalesce(F.try_variant_get(v, "$.paragraph", "array<string>"), F.array().cast("array<string>")), " ")
    is_document = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    return is_document, matched_patterns(patterns, first("title"), first("abstract"), body, paragraphs)


def filter_dataset(spark: SparkSession, source: str, output: str, patterns: list[str]) -> dict:
    """Copy a dataset without the documents that a pattern matches; returns the report.

    Files of JSON lines become folders of text files, each named by its file's path below ``source``; lines that don't parse are kept as they are and
    counted as kept and as failed. Files of one document are kept byte for byte as rows of ``documents`` (path, value); one
    that doesn't parse is counted as failed alone. ``output`` is written anew, so a document that is excluded now is gone.
    """
    apart(source, output)
    lines, single = dataset_files(spark, source)
    report = {"source": source, "output_dir": output, "patterns": patterns, "files_copied": 0, "files_excluded": 0, "batch_files_processed": len(lines), "documents_kept": 0, "documents_excluded": 0, "documents_failed_parse": 0}
    hits = []
    if lines:
        rows = spark.read.text(lines).where("trim(value) <> ''").select(F.col("_metadata.file_path").alias("path"), "value")
        good, found = _matched(F.col("value"), patterns)
        marked = saved(rows.withColumn("ok", good).withColumn("found", F.when(F.col("ok"), found).otherwise(F.array().cast("array<string>"))), "filtered-lines")
        name = F.regexp_replace(F.col("path"), "^.*?" + re.escape(_root(spark, source)), "")
        marked.where("size(found) = 0").select(name.alias("file"), "value").write.mode("overwrite").partitionBy("file").option("compression", "gzip").text(f"{output}/lines")
        n = marked.agg(F.count(F.when(F.size("found") == 0, 1)), F.count(F.when(F.size("found") > 0, 1)), F.count(F.when(~F.col("ok"), 1))).first()
        report |= dict(zip(("documents_kept", "documents_excluded", "documents_failed_parse"), n, strict=True))
        hits.append(marked.select(F.explode("found").alias("pattern")))
    if single:
        rows = spark.read.text(single, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
        good, found = _matched(F.col("value"), patterns)
        marked = saved(rows.withColumn("ok", good).withColumn("found", found), "filtered-files")
        marked.where("ok and size(found) = 0").select("path", "value").write.mode("overwrite").parquet(f"{output}/documents")
        n = marked.agg(F.count(F.when(F.col("ok") & (F.size("found") == 0), 1)), F.count(F.when(F.col("ok") & (F.size("found") > 0), 1)), F.count(F.when(~F.col("ok"), 1))).first()
        report |= {"files_copied": n[0], "files_excluded": n[1], "documents_failed_parse": report["documents_failed_parse"] + n[2]}
        hits.append(marked.where("ok").select(F.explode("found").alias("pattern")))
    counts: dict[str, int] = {}
    for h in hits:
        for r in h.groupBy("pattern").count().collect():  # a row per pattern
            counts[r.pattern] = counts.get(r.pattern, 0) + r["count"]
    return report | {"matched_counts": dict(sorted(counts.items(), key=lambda x: (-x[1], x[0])))}


def fetched(ids: DataFrame, client: Callable[[str], str | None], id_col: str = "doc_id", rate: float | None = FETCH_RATE, ledger: str | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """(id, response) of the ids that the client knows, and (id, error) of those that it failed on; each id is asked for once.

    At most ``rate`` requests a second are sent by all tasks together; with ``ledger`` an interrupted run goes on where it was.
    ``options`` are those of :func:`quarry.operators.requests.send_all`.
    """
    keys = ids.select(F.trim(F.col(id_col).cast("string")).alias("key")).where("key <> ''")
    got = send_all(keys.withColumn("prompt", F.col("key")), client, ledger, rate, **options)
    got = saved(got, "fetched")
    return got.where("reply is not null").select(F.col("key").alias(id_col), F.col("reply").alias("response")), got.where("error is not null").select(F.col("key").alias(id_col), "error")


def counted(counts: DataFrame, name: str, number: str) -> DataFrame:
    """Counts by name and a last row Total."""
    return counts.groupBy(name).agg(F.sum(number).alias(number)).unionByName(counts.agg(F.lit("Total").alias(name), F.coalesce(F.sum(number), F.lit(0)).alias(number)))


