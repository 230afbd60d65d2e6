"""Queries over services, committed runs, chunk files and samples, with SQL. The services stand over the given tables, as files that Spark writes."""

from __future__ import annotations

import bisect
import contextlib
import gzip
import json
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import section_queries
from quarry.operators import batches, judge, sampling, sections, workflow
from quarry.operators.requests import send_all
from quarry.scratch import shared_dir
from quarry.sources import bucketed, cursor, files, members

#: Rows of a page of the paging service; bytes of a chunk file, and of a gzip member before compression.
PAGE, CHUNK, MEMBER = 60, 4000, 2000
#: Pages in a file of the paging service.
FILE = 100


def _place(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/quarry/{name}-{uuid.uuid4().hex}"


class PageFiles:
    """A paging client over folders of JSON lines, one for each query and ``FILE`` pages, a file each; raises at the page ``broken``.

    A line has its page's number and row. A task's copy of the client lists a query's files once and keeps the pages of the last file.
    """

    def __init__(self, folder: str, broken: tuple[str, int] | None = None):
        self.folder, self.broken = folder, broken
        self.files: dict[str, list[int]] = {}
        self.last: tuple[str, dict[int, list[dict]]] = ("", {})

    def pages(self, query: str, file: int) -> dict[int, list[dict]]:
        found = f"{self.folder}/query={query}/file={file}"
        if self.last[0] != found:
            pages: dict[int, list[dict]] = {}
            for name in files.names(found):
                for line in (files.get(f"{found}/{name}") or b"").splitlines():
                    x = json.loads(line)
                    pages.setdefault(x["page"], []).append(x["row"])
            self.last = found, pages
        return self.last[1]

    def __call__(self, query: str, at: str, rows: int, fields: list[str]) -> tuple[list[dict], str]:
        if query not in self.files:
            self.files[query] = sorted(int(n.split("=")[1]) for n in files.names(f"{self.folder}/query={query}"))
        own, first = self.files[query], at == cursor.START
        for file in own if first else own[bisect.bisect_left(own, int(at) // FILE) :]:
            later = [p for p in self.pages(query, file) if first or p > int(at)]
            if later:
                page = min(later)
                if (query, page) == self.broken:
                    raise ConnectionError("the service is gone")
                return [{k: v for k, v in x.items() if k in fields} for x in self.pages(query, file)[page]], str(page)
        return [], at


def cursor_pages(spark: SparkSession, d: str) -> DataFrame:
    """All pages read through a paging client by format name; the service breaks off in the midst, and the stream is resumed.

    The three queries of the service overlap: even ids are found twice.
    """
    pages = spark.read.parquet(f"{d}/pages.parquet")
    service, target, checkpoint = _place(spark, "service"), _place(spark, "cursor"), _place(spark, "cursor-checkpoint")
    own = F.array_compact(F.array((F.col("page_id") % 2).cast("string"), F.when(F.col("page_id") % 2 == 0, F.lit("even"))))
    row = F.struct("page_id", "url", F.md5("html").alias("html_md5"))
    rows = pages.select(F.explode(own).alias("query"), F.floor(F.col("page_id") / PAGE).alias("page"), row.alias("row"))
    rows.withColumn("file", F.floor(F.col("page") / FILE)).repartition("query", "file").write.partitionBy("query", "file").json(service)
    name, settings = "quarry_pages", {"rows": PAGE, "flush": 2, "attempts": 1, "ledger": _place(spark, "cursor-ledger")}
    for broken in (("1", 2), None):
        cursor.register(spark, name, PageFiles(service, broken), ["0", "1", "even"], "page_id long, url string, html_md5 string", **settings)
        with contextlib.suppress(StreamingQueryException) if broken else contextlib.nullcontext():
            got = cursor.collect(spark, name, target, checkpoint, "page_id")
    return got


def sample_by_source(spark: SparkSession, d: str) -> DataFrame:
    """Five documents of each source with their texts, and how many documents it has, from one scan."""
    docs = spark.read.parquet(f"{d}/documents.parquet")
    drawn = sampling.rows_of(docs, sampling.stratified(docs, "source", "doc_id", 5, 7), "doc_id")
    return drawn.select("source", "doc_id", F.col("rank").cast("long").alias("rank"), "seen", F.md5("text").alias("text_md5"))


def _digest(text: str) -> str:
    import hashlib

    return hashlib.md5(text.encode()).hexdigest()


def request_replies(spark: SparkSession, d: str) -> DataFrame:
    """Every document's text sent to a client that answers with its digest, a ledger beside it; sent again, all answers are on file."""
    docs = spark.read.parquet(f"{d}/documents.parquet")
    jobs, ledger = docs.select(F.col("doc_id").cast("string").alias("key"), F.coalesce("text", F.lit("")).alias("prompt")), _place(spark, "requests")
    send_all(jobs, _digest, ledger, each=500).write.format("noop").mode("overwrite").save()
    return send_all(jobs, _refuse, ledger).select(F.col("key").cast("long").alias("doc_id"), "reply", "error")


def _refuse(text: str) -> str:
    raise AssertionError("this was answered before")


def chunk_files(spark: SparkSession, d: str) -> DataFrame:
    """A request line for every document in chunk files that tasks write, read back: each line's file by its number, as the run's folder lists them."""
    docs, run = spark.read.parquet(f"{d}/documents.parquet"), _place(spark, "chunks")
    lines = docs.select("doc_id", F.to_json(F.struct(F.col("doc_id").alias("custom_id"), F.md5(F.coalesce("text", F.lit(""))).alias("body"))).alias("line"), F.lit("run").alias("run"))
    packed = judge.pack_chunks(lines.withColumn("bytes", F.octet_length("line") + 1), "bytes", "run", "doc_id", CHUNK)
    batches.write_chunks(packed, run, order="doc_id")
    found = batches.found_chunks(run)
    index = spark.createDataFrame([(c["path"].rsplit("/", 1)[-1], c["index"] or 0, c["num_requests"], c["num_bytes"]) for c in found], "file string, chunk long, requests long, bytes long")
    read = spark.read.text([c["path"] for c in found]).select(F.col("_metadata.file_name").alias("file"), F.get_json_object("value", "$.custom_id").cast("long").alias("doc_id"), F.get_json_object("value", "$.body").alias("text_md5"))
    return read.join(index, "file").select("doc_id", "text_md5", "chunk", "requests", "bytes")


def committed_runs(spark: SparkSession, d: str) -> DataFrame:
    """Sections of all documents as three runs leave them: of half of them, one that breaks off before its commit, and one of all."""
    raw, source, output = section_queries.raw_documents(spark, d), _place(spark, "raw"), _place(spark, "sectioned")

    class BrokenOff(Exception):
        pass

    def crash(part: str) -> None:
        if part == workflow.FAILURES:
            raise BrokenOff

    raw.where("corpusid % 2 = 0").write.option("compression", "gzip").json(f"{source}/even")
    workflow.section_dataset(spark, source, output)
    raw.where("corpusid % 2 = 1").write.option("compression", "gzip").json(f"{source}/odd")
    with contextlib.suppress(BrokenOff):
        workflow.section_dataset(spark, source, output, after=crash)
    workflow.section_dataset(spark, source, output)
    text = F.array_join(F.transform("sections", lambda s: F.concat(s["header"], F.lit("="), s["text"])), "|")
    return workflow.written(spark, output).select(F.col("corpusid").cast("long").alias("doc_id"), F.size("sections").cast("long").alias("n_sections"), F.md5(text).alias("sections_md5"))


def gzip_members(spark: SparkSession, d: str) -> DataFrame:
    """Documents as gzip files that were appended to bit by bit, an end of a member anywhere in a line, read back by ranges: file, number, line.

    A file has the lines of 500 documents, an empty one after every ninth; members and ranges have few bytes, so a file is many tasks.
    """
    docs, folder = spark.read.parquet(f"{d}/documents.parquet"), _place(spark, "members")
    line = F.to_json(F.struct(F.col("doc_id").alias("corpusid"), F.coalesce("text", F.lit("")).alias("title")))

    def write(key: tuple, table: pa.Table) -> pa.Table:
        rows = table.sort_by("doc_id").to_pylist()
        data = "".join(r["line"] + ("\n\n" if r["doc_id"] % 9 == 0 else "\n") for r in rows).encode()
        path = f"{folder}/{key[0].as_py():06d}.gz"
        files.put(path, b"".join(gzip.compress(data[k : k + MEMBER]) for k in range(0, len(data), MEMBER)))
        return pa.table({"path": [path]})

    made = docs.select("doc_id", line.alias("line"), F.floor(F.col("doc_id") / 500).alias("k")).groupBy("k").applyInArrow(write, "path string").collect()
    found = members.gzip_lines(spark, [r.path for r in made], 16 * MEMBER)
    file = F.regexp_extract("path", r"([0-9]+)\.gz$", 1).cast("long")
    return found.select(file.alias("file"), "line_number", F.get_json_object("value", "$.corpusid").cast("long").alias("doc_id"), F.md5(F.get_json_object("value", "$.title")).alias("text_md5"))


def bucketed_audit(spark: SparkSession, d: str) -> DataFrame:
    """The audit of all documents from bucketed tables of raw and written ones."""
    name = f"quarry_{uuid.uuid4().hex}"
    raw = bucketed.save(section_queries.normal(spark, d), f"{name}_raw", 16, path=_place(spark, "bucketed-raw"))
    bucketed.save(sections.sectionize(raw), f"{name}_written", 16, path=_place(spark, "bucketed-written"))
    rows = bucketed.audit(spark, f"{name}_raw", f"{name}_written")
    return rows.select(F.col("corpusid").cast("long").alias("doc_id"), F.col("idx").cast("long").alias("idx"), F.col("chars").cast("long").alias("chars"), F.col("words").cast("long").alias("words"), "present", "reason")


def bucketed_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Documents of a bucketed table by the ids of the labels and others, and the ids without a document."""
    name = f"quarry_{uuid.uuid4().hex}"
    bucketed.save(spark.read.parquet(f"{d}/documents.parquet"), name, 16, "doc_id", _place(spark, "bucketed"))
    ids = spark.read.parquet(f"{d}/labels.parquet").select("doc_id").unionByName(spark.read.parquet(f"{d}/embeddings.parquet").select((F.col("vec_id") * 3).alias("doc_id")))
    found, missing = bucketed.lookup(spark, name, ids, "doc_id")
    return found.select("doc_id", F.md5("text").alias("text_md5")).unionByName(missing.select("doc_id", F.lit(None).cast("string").alias("text_md5")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (cursor_pages, sample_by_source, request_replies, chunk_files, committed_runs, gzip_members, bucketed_audit, bucketed_lookup)}


def oracle_sql() -> dict[str, str]:
    return {
        "cursor_pages": "SELECT page_id, url, md5(html) AS html_md5 FROM pages",
        "sample_by_source": """
            SELECT source, doc_id, rank, seen, text_md5 FROM (
              SELECT source, doc_id, md5(text) AS text_md5, count(*) OVER (PARTITION BY source) AS seen, row_number() OVER (PARTITION BY source ORDER BY md5(concat(7, ':', doc_id)), doc_id) AS rank FROM documents) WHERE rank <= 5""",
        "bucketed_audit": section_queries.oracle_sql()["audit_presence"],
        "bucketed_lookup": """
            SELECT i.doc_id::VARCHAR AS doc_id, md5(d.text) AS text_md5 FROM (SELECT doc_id FROM labels UNION SELECT vec_id * 3 FROM embeddings) i LEFT JOIN documents d USING (doc_id)""",
        "gzip_members": """
            SELECT doc_id // 500 AS file, doc_id, md5(coalesce(text, '')) AS text_md5, row_number() OVER w + (count(*) FILTER (doc_id % 9 = 0) OVER w) - CASE WHEN doc_id % 9 = 0 THEN 1 ELSE 0 END AS line_number
            FROM documents WINDOW w AS (PARTITION BY doc_id // 500 ORDER BY doc_id)""",
        "request_replies": "SELECT doc_id, md5(coalesce(text, '')) AS reply, NULL::VARCHAR AS error FROM documents",
        "chunk_files": f"""
            WITH RECURSIVE o AS (SELECT doc_id, md5(coalesce(text, '')) AS text_md5, (length(doc_id::VARCHAR) + 57)::BIGINT AS n, row_number() OVER (ORDER BY doc_id) AS r FROM documents),
            g AS (SELECT r, 0::BIGINT AS chunk, n AS used FROM o WHERE r = 1 UNION ALL SELECT o.r, CASE WHEN g.used + o.n > {CHUNK} THEN g.chunk + 1 ELSE g.chunk END, CASE WHEN g.used + o.n > {CHUNK} THEN o.n ELSE g.used + o.n END FROM g JOIN o ON o.r = g.r + 1)
            SELECT doc_id, text_md5, chunk, count(*) OVER (PARTITION BY chunk) AS requests, (sum(n) OVER (PARTITION BY chunk))::BIGINT AS bytes FROM o JOIN g USING (r)""",
        "committed_runs": f"SELECT doc_id, n_sections, sections_md5 FROM ({section_queries.oracle_sql()['sectionize']}) WHERE n_sections > 0",
    }
