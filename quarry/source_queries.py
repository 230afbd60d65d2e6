"""Round trips through readers, writers, converters and the batch collector over the test tables, with SQL.

Each query writes the documents in the form that a reader takes, reads them back and shows what it found; scratch files go to
the shared folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import registry
from quarry.operators import batches, convert, judge, metadata, search, sections
from quarry.plans import keyword
from quarry.scratch import bounded_batches, shared_dir
from quarry.section_queries import decomposed, english
from quarry.sources import discovery, documents

GROUP_FILE = '''
(
(
-- GROUP 1: Frequent words
"the"
"und" OR
-- a comment
"les"
)
OR
(
-- GROUP 2: Licenses
"apache license" OR
"license"
)
)
AND
(
"of" OR
"der" OR
"de"
)
NOT
(
"idiot" OR
"moron"
)
'''


def docs(spark: SparkSession, d: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{d}/documents.parquet")


def place(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/quarry/{name}-{uuid.uuid4().hex}"


def _shards(spark: SparkSession, d: str) -> str:
    """NDJSON gz shards: every third document in the older layout, and a broken line after every tenth."""
    target = place(spark, "shards")
    ann = F.create_map(F.lit("title"), F.lit('[{"start": 0, "end": 5}]'), F.lit("note"), F.lit(None).cast("string"))
    source = F.struct(F.array(F.concat(F.lit("http://a.test/"), F.col("doc_id")), F.lit("")).alias("pdfurls"), F.struct(F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("http://o.test/"), F.col("doc_id"))).alias("openaccessurl")).alias("oainfo"))
    own = F.struct("text", ann.alias("annotations"), source.alias("source"))
    old = F.col("doc_id") % 3 == 0
    ids = F.create_map(F.lit("doi"), F.when(F.col("doc_id") % 4 == 0, "").otherwise(F.concat(F.lit("10.1/"), F.col("doc_id"))), F.lit("mag"), F.lit(None).cast("string"))
    row = F.to_json(F.struct(F.col("doc_id").alias("corpusid"), F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit(" Named "), F.col("doc_id"))).alias("title"), ids.alias("externalids"), F.when(~old, own).alias("body"), F.when(old, own).alias("content")), {"ignoreNullFields": "true"})
    lines = docs(spark, d).select(F.explode(F.when(F.col("doc_id") % 10 == 0, F.array(row, F.concat(F.lit("{broken "), F.col("doc_id")))).otherwise(F.array(row, F.lit("")))).alias("value"))
    lines.write.option("compression", "gzip").text(target)
    return target


def read_shards(spark: SparkSession, d: str) -> DataFrame:
    good, _ = documents.read_shards(spark, _shards(spark, d))
    text = F.coalesce("body.text", "content.text", F.lit(""))
    title = documents.best_title(F.col("title"), text, F.coalesce("body.annotations", "content.annotations"))
    return good.select(F.col("corpusid").cast("long").alias("doc_id"), F.md5(text).alias("text_md5"), title.alias("title"))


def shard_quarantine(spark: SparkSession, d: str) -> DataFrame:
    _, bad = documents.read_shards(spark, _shards(spark, d))
    return bad.select("line")


def failure_records(spark: SparkSession, d: str) -> DataFrame:
    """Broken lines as failures; their numbers count all lines of a file."""
    rows = documents.failures(discovery.numbered_lines(spark, _shards(spark, d)))
    return rows.select("title", "error", (F.col("line_number") >= 2).alias("numbered"), F.size("external_ids").cast("long").alias("ids"))


def line_numbers(spark: SparkSession, d: str) -> DataFrame:
    """One file of one document's lines each: numbers start at 1 and count blank lines."""
    target = place(spark, "lines")
    rows = docs(spark, d).select((F.col("doc_id") % 16).alias("part"), F.concat(F.lit("x"), F.col("doc_id")).alias("value"), "doc_id")
    lines = rows.select("part", F.explode(F.when(F.col("doc_id") % 6 == 0, F.array("value", F.lit(" "))).otherwise(F.array("value"))).alias("value"), "doc_id")
    lines.repartition("part").sortWithinPartitions("part", "doc_id", F.desc("value")).select("part", "value").write.partitionBy("part").text(target)
    found = discovery.numbered_lines(spark, [f"{target}/part={k}" for k in range(16)])
    return found.select(F.substring("value", 2, 20).cast("long").alias("doc_id"), F.col("line_number").cast("long").alias("line_number"))


def external_ids(spark: SparkSession, d: str) -> DataFrame:
    good, _ = documents.read_shards(spark, _shards(spark, d))
    found = documents.external_ids(F.col("externalids"))
    return good.select(F.col("corpusid").cast("long").alias("doc_id"), F.array_join(F.map_values(found), ";").alias("ids"), F.array_join(documents.open_access_urls(good), ";").alias("urls"), F.md5(documents.full_text(good)).alias("full_md5"))


def exports_read(spark: SparkSession, d: str) -> DataFrame:
    """Exports that hold a list, a response or one document, a file each, and broken ones."""
    target = place(spark, "exports")
    one = F.concat(F.lit('{"corpus_id": ["'), F.col("doc_id"), F.lit('"]}'))
    shape = F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("["), one, F.lit(", "), one, F.lit("]"))).when(F.col("doc_id") % 4 == 1, F.concat(F.lit('{"response": {"docs": ['), one, F.lit("]}}"))).when(F.col("doc_id") % 4 == 2, one).otherwise(F.lit('{"other": 1}'))
    rows = docs(spark, d).select("doc_id", shape.alias("value"))
    rows.groupBy((F.col("doc_id") % 64).alias("k"), (F.col("doc_id") % 4).alias("form")).agg(F.min_by("value", "doc_id").alias("value")).select("k", "value").write.partitionBy("k").text(target)
    items, unknown = documents.read_exports(spark, f"{target}/k=*")
    ids = items.select(F.try_variant_get("item", "$.corpus_id[0]", "string").alias("id"))
    return ids.groupBy("id").agg(F.count(F.lit(1)).alias("items")).unionByName(unknown.agg(F.lit("unknown").alias("id"), F.count(F.lit(1)).alias("items")))


def ids_source(spark: SparkSession, d: str) -> DataFrame:
    """Ids from a text file with blanks and repeats."""
    target = place(spark, "ids")
    spark.read.parquet(f"{d}/labels.parquet").select(F.explode(F.array(F.concat(F.lit(" "), "doc_id"), F.col("doc_id").cast("string"), F.lit(""))).alias("value")).write.text(target)
    return documents.read_ids(spark, target)


def first_write_wins(spark: SparkSession, d: str) -> DataFrame:
    """Bucketed documents, first by shard and line, read back with their buckets."""
    target = place(spark, "written")
    twice = docs(spark, d).select(F.md5("text").alias("id"), F.col("source").alias("shard"), F.col("doc_id").alias("line"), "lang")
    documents.write_documents(twice, target, "id", "shard", "line")
    return spark.read.schema("id string, shard string, line long, lang string").json(target).select("id", "shard", "line", "lang", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("folder"))


def filter_dataset_report(spark: SparkSession, d: str) -> DataFrame:
    """The filter workflow over shards of JSON lines with broken ones; its report as a row per figure."""
    report = discovery.filter_dataset(spark, _shards(spark, d), place(spark, "filtered"), ["license", r"tion\b", "stupid|moron"])
    rows = [(k, report[k]) for k in ("documents_kept", "documents_excluded", "documents_failed_parse", "files_copied")] + list(report["matched_counts"].items())
    return spark.createDataFrame(rows, "figure string, n long")


def filter_dataset_kept(spark: SparkSession, d: str) -> DataFrame:
    """The lines that the filter workflow keeps: documents without a match, and broken lines as they are."""
    target = place(spark, "filtered")
    discovery.filter_dataset(spark, _shards(spark, d), target, ["license", r"tion\b", "stupid|moron"])
    kept = spark.read.text(f"{target}/lines")
    return kept.select(F.coalesce(F.get_json_object("value", "$.corpusid"), F.col("value")).alias("id"))


def metadata_csv(spark: SparkSession, d: str) -> DataFrame:
    """Packaged documents from sections and a CSV of metadata; a later row of a key replaces an earlier one."""
    target = place(spark, "csv")
    meta = spark.read.parquet(f"{d}/labels.parquet").groupBy("doc_id").agg(F.max("quality").alias("q"), F.max("toxic").alias("t"))
    named = F.concat(F.lit("[{'first': 'A', 'last': 'L"), F.col("doc_id"), F.lit("'}, {'last': 'Only'}]"))
    rows = meta.select(F.explode(F.array(F.struct(F.lit(0).alias("k"), F.lit("old, \"title\"").alias("title")), F.struct(F.lit(1).alias("k"), F.concat(F.lit('T, "'), F.col("doc_id"), F.lit('"')).alias("title")))).alias("v"), F.col("doc_id").alias("paper_id"), F.col("q").alias("abstract"), F.when(F.col("t") == 1, "2001").alias("year"), F.when(F.col("doc_id") % 3 == 0, "oops").otherwise(named).alias("authors"))
    rows.repartition("paper_id").sortWithinPartitions("paper_id", "v.k").select("paper_id", "v.title", "abstract", "year", "authors").write.option("header", True).option("escape", '"').csv(target)
    found = metadata.read_csv(spark, target).withColumnRenamed("paper_id", "corpus_id")
    sectioned = docs(spark, d).select(F.col("doc_id").alias("corpus_id"), F.create_map(F.lit("body"), F.col("lang")).alias("sections"))
    packed = metadata.packaged(sectioned, "csv", found)
    return packed.select(F.col("unique_id").cast("long").alias("doc_id"), "title", "abstract", "date", F.array_join("authors", ";").alias("authors"), F.element_at("text", "body").alias("body"), "source")


def metadata_from_sections(spark: SparkSession, d: str) -> DataFrame:
    rows = docs(spark, d).select(F.col("doc_id").alias("corpus_id"), F.create_map(F.lit("title"), F.col("lang"), F.lit("abstract"), F.col("source"), F.lit("body"), F.col("lang")).alias("sections"))
    packed = metadata.packaged(rows, "own")
    return packed.select(F.col("unique_id").cast("long").alias("doc_id"), "title", "abstract", "references", F.array_join(F.map_keys("text"), ";").alias("headers"))


def group_file_tags(spark: SparkSession, d: str) -> DataFrame:
    groups = {f"{g['group']} {g['name']}": g["query"] for g in keyword.parse_group_file(GROUP_FILE)}
    return search.tag_groups(docs(spark, d), groups).select("doc_id", F.array_join("groups", ";").alias("groups"))


def _tei_files(spark: SparkSession, d: str) -> DataFrame:
    """Documents as TEI: an abstract, and a div for each line, whose head is missing, listed or plain; a comment in each, and in every sixth a div with CDATA."""
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x != "")
    safe = lambda x: F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    head = lambda i: F.when(i % 3 == 0, F.concat(F.lit("<head n='1'>Part "), i, F.lit("</head>"))).when(i % 3 == 1, F.lit("<head>List of References</head>")).otherwise(F.lit(""))
    inner = lambda i: F.when(i % 6 == 0, F.concat(F.lit("<div><head>Within "), i, F.lit("</head><p><![CDATA[The end of the < and of & it.]]></p></div>"))).otherwise(F.lit(""))
    div = lambda x, i: F.concat(F.lit("<div>"), head(i), F.lit("<!-- <p>no text</p> --><p>It is the end of it. "), safe(x), F.lit("</p><p>References the of the and of</p>"), inner(i), F.lit("</div>"))
    xml = F.concat(F.lit("<TEI xmlns='http://www.tei-c.org/ns/1.0'><teiHeader><abstract><div><p>About "), F.col("doc_id"), F.lit("</p></div></abstract></teiHeader><text><body>"), F.array_join(F.transform(lines, div), ""), F.lit("</body></text></TEI>"))
    return docs(spark, d).select(F.col("doc_id").cast("string").alias("path"), xml.alias("value"))


def tei_documents(spark: SparkSession, d: str) -> DataFrame:
    found = convert.tei_sections(_tei_files(spark, d))
    return found.select(F.col("path").cast("long").alias("doc_id"), F.col("idx").cast("long").alias("idx"), "header", F.md5("text").alias("text_md5"))


def tei_table_function(spark: SparkSession, d: str) -> DataFrame:
    """The blocks of TEI documents by a table function over a table argument, in SQL alone."""
    registry.register(spark)
    _tei_files(spark, d).createOrReplaceTempView("quarry_tei_files")
    return spark.sql("SELECT CAST(path AS BIGINT) AS doc_id, count(*) AS blocks, sum(size(paragraphs)) AS paragraphs, max(idx) AS last FROM quarry_tei_sections(TABLE(SELECT path, value FROM quarry_tei_files)) GROUP BY path")


def recognised_documents(spark: SparkSession, d: str) -> DataFrame:
    """Recognised text with its tags; every seventh document lacks one."""
    tags = F.concat(F.when(F.col("doc_id") % 7 == 0, "").otherwise("<title>T</title>"), F.lit("<pubnumber>N"), F.col("doc_id"), F.lit("</pubnumber><author>A</author><author>B</author><abstract>Ab</abstract><publisher>P</publisher><pubyear>1999</pubyear>"))
    value = F.concat(tags, F.lit("\n\n\nAlpha beta 555-123-4567 N"), F.col("doc_id"), F.lit("\n\n\n"), F.col("lang"), F.lit(" ... end\nnext"))
    found = convert.recognised_documents(docs(spark, d).select(F.col("doc_id").cast("string").alias("path"), value.alias("value")), "scan")
    return found.select(F.col("path").cast("long").alias("doc_id"), "unique_id", "date", F.array_join("authors", ";").alias("authors"), F.element_at("text", "body").alias("body"))


def batch_collect(spark: SparkSession, d: str) -> DataFrame:
    """Batch output of the labelled documents (answers, errors, unknown ids, broken lines) against the manifest of all documents."""
    labels = spark.read.parquet(f"{d}/labels.parquet").groupBy("doc_id").agg(F.max("quality").alias("q"))
    answer = F.concat(F.lit('{"decision": "'), F.when(F.col("q") == 1, "relevant").otherwise("other"), F.lit('", "score": 1}'))
    ok = F.to_json(F.struct(F.col("doc_id").cast("string").alias("custom_id"), F.struct(F.struct(F.array(F.struct(F.struct(answer.alias("content")).alias("message"))).alias("choices")).alias("body")).alias("response")))
    line = F.when(F.col("doc_id") % 11 == 0, F.concat(F.lit('{"custom_id": "'), F.col("doc_id"), F.lit('", "error": "late"}'))).when(F.col("doc_id") % 13 == 0, F.lit("{broken")).otherwise(ok)
    extra = spark.read.parquet(f"{d}/embeddings.parquet").select(F.concat(F.lit('{"custom_id": "v'), F.col("vec_id"), F.lit('"}')).alias("line"))
    text = F.col("doc_id").cast("string")
    manifest = docs(spark, d).select(text.alias("custom_id"), text.alias("doc_id"), F.col("source").alias("source_path"), F.lit("").alias("title"), F.md5("text").alias("input_sha256"))
    results, failures = batches.collect(labels.select(line.alias("line")).unionByName(extra), manifest)
    good = results.groupBy(F.coalesce("decision", "parse_error").alias("what")).agg(F.count(F.lit(1)).alias("n"))
    bad = failures.groupBy(F.when(F.col("error").startswith("custom_id not"), "unknown").otherwise(F.col("error")).alias("what")).agg(F.count(F.lit(1)).alias("n"))
    return good.unionByName(bad)


def judge_run_summary(spark: SparkSession, d: str) -> DataFrame:
    """Judge rows of conversations: of each input's first row in the run of model m, what was said."""
    t = spark.read.parquet(f"{d}/conversations.parquet")
    said = F.when(F.col("turn") % 3 == 0, "maybe").when(F.col("conv_id") % 5 == 0, F.lit(None).cast("string")).otherwise("relevant")
    rows = t.select(F.concat(F.lit("c"), F.col("conv_id")).alias("source_path"), F.lit("h").alias("input_sha256"), F.when(F.col("turn") == 0, "other").otherwise("m").alias("model"), F.lit("u").alias("base_url"), F.lit("p").alias("prompt_sha256"), said.alias("decision"), said.isNotNull().alias("parsed"), "turn")
    expected = t.select(F.concat(F.lit("c"), F.col("conv_id")).alias("source_path"), F.when(F.col("conv_id") % 4 == 1, "changed").otherwise("h").alias("input_sha256"))
    one = judge.run_summary(judge.of_run(rows, expected, "m", "u", "p"), "turn")
    return one.select("succeeded", "parse_failures", F.coalesce(F.element_at("decision_counts", "maybe"), F.lit(0)).alias("maybe"), F.coalesce(F.element_at("decision_counts", "relevant"), F.lit(0)).alias("relevant"))


def kept_documents(spark: SparkSession, d: str) -> DataFrame:
    results = spark.read.parquet(f"{d}/labels.parquet").select("doc_id", (F.col("toxic") == 0).alias("parsed"), F.when(F.col("quality") == 1, "relevant").otherwise("maybe").alias("decision"))
    return judge.kept_documents(docs(spark, d), results, " Maybe", "doc_id").select("doc_id", "lang")


def request_lines(spark: SparkSession, d: str) -> DataFrame:
    """Request lines of all documents, packed into chunks of at most 60,000 bytes."""
    prompt = judge.judge_prompt("Be brief.", F.col("source"), F.lit(""), F.array(F.struct(F.lit("body").alias("header"), F.coalesce("text", F.lit("")).alias("text"))), 900)
    lines = docs(spark, d).select("doc_id", F.lit(0).alias("run"), F.md5(prompt).alias("prompt_md5"), F.length(prompt).cast("long").alias("bytes"))
    packed = judge.pack_chunks(lines, "bytes", "run", "doc_id", 60_000)
    return packed.select("doc_id", "prompt_md5", F.col("chunk").cast("long").alias("chunk"))


def slugs_and_times(spark: SparkSession, d: str) -> DataFrame:
    rows = docs(spark, d)
    return rows.select("doc_id", batches.slug(F.coalesce("text", F.lit(""))).alias("slug"), batches.duration(F.col("doc_id") * 997).alias("age"))


def counts_with_total(spark: SparkSession, d: str) -> DataFrame:
    per = docs(spark, d).groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"))
    return discovery.counted(per, "source", "n")


def legacy_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Multi-valued documents: the lines are paragraphs, headers by their place; an abstract of 40 characters is required."""
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x != "")
    heads = F.transform(lines, lambda x, i: F.when(i % 3 == 2, "Conclusions").when(i % 3 == 1, "Keywords").otherwise("Methods in use"))
    rows = docs(spark, d).select(F.array(F.col("doc_id").cast("string")).alias("corpus_id"), F.array(F.lit("T")).alias("title"), F.array(F.get(lines, 0)).alias("abstract"), lines.alias("paragraph"), F.concat(heads, F.array(F.lit("Unpaired"))).alias("sectionheader"))
    done = sections.sectionize_legacy(rows)
    return done.select(F.col("corpusid").cast("long").alias("doc_id"), "outcome", F.size("detail").cast("long").alias("sections"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (read_shards, shard_quarantine, failure_records, line_numbers, external_ids, exports_read, ids_source, first_write_wins, filter_dataset_report, filter_dataset_kept, metadata_csv, metadata_from_sections, group_file_tags, tei_documents, tei_table_function, recognised_documents, batch_collect, judge_run_summary, kept_documents, request_lines, slugs_and_times, counts_with_total, legacy_outcomes)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    has = lambda *ts: "(" + " OR ".join(rf"regexp_matches(lower(coalesce(text, '')), '\b{t}\b')" for t in ts) + ")"
    hit = {p: f"regexp_matches(text, '(?i){p}')" for p in ("license", r"tion\b", "stupid|moron")}
    any_hit = f"coalesce({' OR '.join(hit.values())}, false)"
    normal = lambda x: rf"trim(regexp_replace({decomposed(x)}, '\s+', ' ', 'g'))"
    quote = lambda x: x.replace("'", "''")
    edges = r"'^\s+|\s+$', '', 'g'"
    slug = lambda x: rf"regexp_replace({x}, '^[._-]+|[._-]+$', '', 'g')"
    valid = r"(NOT regexp_matches(x, '\p{Nd}') OR (length(regexp_replace(x, '\P{Nd}', '', 'g')) <= 0.3 * length(x) AND length(regexp_replace(x, '[a-zA-Z0-9]', '', 'g')) <= 0.3 * length(x)))"
    common = "has_group AND " + has("of", "der", "de") + " AND NOT " + has("idiot", "moron")
    return {
        "read_shards": rf"""SELECT doc_id, md5(coalesce(text, '')) AS text_md5, CASE WHEN doc_id % 5 = 0 THEN 'Named ' || doc_id WHEN regexp_replace(left(coalesce(text, ''), 5), {edges}) <> '' THEN regexp_replace(left(text, 5), {edges})
            ELSE coalesce(list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x)), lambda x: x <> '')[1], '') END AS title FROM documents""",
        "shard_quarantine": "SELECT '{broken ' || doc_id AS line FROM documents WHERE doc_id % 10 = 0",
        "failure_records": "SELECT '' AS title, 'invalid JSON' AS error, true AS numbered, 0 AS ids FROM documents WHERE doc_id % 10 = 0",
        "line_numbers": "SELECT doc_id, (row_number() OVER w + count(*) FILTER (doc_id % 6 = 0) OVER w - CASE WHEN doc_id % 6 = 0 THEN 1 ELSE 0 END) AS line_number FROM documents WINDOW w AS (PARTITION BY doc_id % 16 ORDER BY doc_id)",
        "external_ids": "SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN '' ELSE '10.1/' || doc_id END AS ids, concat_ws(';', CASE WHEN doc_id % 2 = 0 THEN 'http://o.test/' || doc_id END, 'http://a.test/' || doc_id) AS urls, md5(concat_ws(' ', CASE WHEN doc_id % 5 = 0 THEN ' Named ' || doc_id END, nullif(text, ''))) AS full_md5 FROM documents",
        "exports_read": "WITH m AS (SELECT doc_id % 64 AS k, min(doc_id) AS d FROM documents GROUP BY 1) SELECT d::VARCHAR AS id, CASE d % 4 WHEN 0 THEN 2 ELSE 1 END AS items FROM m WHERE d % 4 <> 3 UNION ALL SELECT 'unknown', count(*) FROM m WHERE d % 4 = 3",
        "ids_source": "SELECT DISTINCT doc_id::VARCHAR AS doc_id FROM labels",
        "first_write_wins": "SELECT id, shard, line, lang, 'bucket=' || right(id, 2) AS folder FROM (SELECT md5(text) AS id, source AS shard, doc_id AS line, lang, row_number() OVER (PARTITION BY text ORDER BY source, doc_id) AS r FROM documents) WHERE r = 1",
        "filter_dataset_report": f"""SELECT 'documents_kept' AS figure, count(*) FILTER (NOT {any_hit}) + count(*) FILTER (doc_id % 10 = 0) AS n FROM documents UNION ALL SELECT 'documents_excluded', count(*) FILTER ({any_hit}) FROM documents
            UNION ALL SELECT 'documents_failed_parse', count(*) FROM documents WHERE doc_id % 10 = 0 UNION ALL SELECT 'files_copied', 0 {' '.join(f"UNION ALL SELECT '{p}', count(*) FROM documents WHERE {h} HAVING count(*) > 0" for p, h in hit.items())}""",
        "filter_dataset_kept": f"SELECT doc_id::VARCHAR AS id FROM documents WHERE NOT {any_hit} UNION ALL SELECT '{{broken ' || doc_id FROM documents WHERE doc_id % 10 = 0",
        "metadata_csv": """SELECT d.doc_id, 'T, "' || d.doc_id || '"' AS title, coalesce(l.q::VARCHAR, '') AS abstract, CASE WHEN l.t = 1 THEN '2001' ELSE '0' END AS date, CASE WHEN d.doc_id % 3 = 0 THEN '' ELSE 'A L' || d.doc_id || ';Only' END AS authors, d.lang AS body, 'csv' AS source
            FROM documents d JOIN (SELECT doc_id, max(quality) AS q, max(toxic) AS t FROM labels GROUP BY 1) l USING (doc_id)""",
        "metadata_from_sections": "SELECT doc_id, coalesce(lang, '') AS title, coalesce(source, '') AS abstract, '' AS \"references\", 'body' AS headers FROM documents",
        "group_file_tags": f"SELECT doc_id, string_agg(g, ';' ORDER BY g) AS groups FROM (SELECT doc_id, '1 Frequent words' AS g FROM documents WHERE {common.replace('has_group', has('the', 'und', 'les'))} UNION ALL SELECT doc_id, '2 Licenses' FROM documents WHERE {common.replace('has_group', has('apache license', 'license'))}) GROUP BY doc_id",
        "tei_documents": rf"""
            WITH l0 AS (SELECT doc_id, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: x <> '') AS ls FROM documents),
            l AS (SELECT doc_id, unnest(ls) AS t, unnest(range(len(ls))) AS i FROM l0),
            p AS (SELECT doc_id, i, CASE WHEN i % 3 = 0 THEN 'Part ' || i ELSE 'It is the end of it.' END AS header, CASE WHEN i % 3 = 0 THEN {normal("'It is the end of it. ' || t")} ELSE {normal('t')} END AS x FROM l WHERE i % 3 <> 1),
            w AS (SELECT *, regexp_split_to_array(lower(x), '[^\p{{L}}]+') AS w FROM p),
            e AS (SELECT *, CASE WHEN {english()} THEN x ELSE '' END AS y, 'The end of the < and of & it.' AS z FROM w)
            SELECT doc_id, i + (i + 5) // 6 AS idx, header, md5(CASE WHEN i % 6 <> 0 THEN y WHEN y = '' THEN z WHEN regexp_matches(y, '[.!?]$') THEN y || chr(10) || chr(10) || z ELSE y || ' ' || z END) AS text_md5 FROM e
            UNION ALL SELECT doc_id, i + (i + 5) // 6 + 1, 'Within ' || i, md5(z) FROM e WHERE i % 6 = 0 UNION ALL SELECT doc_id, -1, 'abstract', md5('About ' || doc_id) FROM documents""",
        "tei_table_function": """
            WITH n AS (SELECT doc_id, len(list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: x <> '')) AS n FROM documents)
            SELECT doc_id, 1 + n + (n + 5) // 6 AS blocks, 1 + 2 * n + 2 * ((n + 5) // 6) AS paragraphs, n + (n + 5) // 6 - 1 AS last FROM n""",
        "recognised_documents": "SELECT doc_id, 'N' || doc_id AS unique_id, '1999' AS date, 'A;B' AS authors, 'TABAbP1999 Alpha beta  N' || doc_id || ' ' || lang || ' endnext' AS body FROM documents WHERE doc_id % 7 <> 0",
        "batch_collect": """
            WITH l AS (SELECT doc_id, max(quality) AS q FROM labels GROUP BY 1), k AS (SELECT *, CASE WHEN doc_id % 11 = 0 THEN 'late' WHEN doc_id % 13 = 0 THEN 'no custom_id or no JSON' WHEN q = 1 THEN 'relevant' ELSE 'invalid decision' END AS what FROM l)
            SELECT what, count(*) AS n FROM (SELECT what FROM k UNION ALL SELECT 'unknown' FROM embeddings UNION ALL SELECT 'no batch output row found for custom_id' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM k WHERE what <> 'no custom_id or no JSON')) GROUP BY 1""",
        "judge_run_summary": """
            WITH f AS (SELECT conv_id, min(turn) AS turn FROM conversations WHERE turn <> 0 AND conv_id % 4 <> 1 GROUP BY 1), s AS (SELECT CASE WHEN turn % 3 = 0 THEN 'maybe' WHEN conv_id % 5 = 0 THEN NULL ELSE 'relevant' END AS said FROM f)
            SELECT count(*) AS succeeded, count(*) FILTER (said IS NULL) AS parse_failures, count(*) FILTER (said = 'maybe') AS maybe, count(*) FILTER (said = 'relevant') AS relevant FROM s""",
        "kept_documents": "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 0 AND quality IS DISTINCT FROM 1)",
        "request_lines": rf"""
            WITH RECURSIVE a AS (SELECT doc_id, coalesce(text, '') AS t, 'Title: ' || source || chr(10) || chr(10) || 'Abstract:' || chr(10) || chr(10) || chr(10) || 'Sections:' AS prelude FROM documents),
            b AS (SELECT doc_id, prelude || CASE WHEN 10 + length(t) <= 900 - length(prelude) THEN chr(10) || chr(10) || '## body' || chr(10) || t WHEN 900 - length(prelude) - 10 > 20 THEN chr(10) || chr(10) || '## body' || chr(10) || regexp_replace(left(t, 890 - length(prelude)), '\s+$', '') ELSE '' END AS x FROM a),
            c AS (SELECT doc_id, regexp_replace('{quote(judge.PROMPT.format(rubric="Be brief."))}' || x, {edges}) AS x FROM b),
            o AS (SELECT doc_id, md5(x) AS prompt_md5, length(x) AS n, row_number() OVER (ORDER BY doc_id) AS r FROM c),
            g AS (SELECT r, 0 AS chunk, n AS used FROM o WHERE r = 1 UNION ALL SELECT o.r, CASE WHEN g.used + o.n > 60000 THEN g.chunk + 1 ELSE g.chunk END, CASE WHEN g.used + o.n > 60000 THEN o.n ELSE g.used + o.n END FROM g JOIN o ON o.r = g.r + 1)
            SELECT doc_id, prompt_md5, chunk::BIGINT AS chunk FROM o JOIN g USING (r)""",
        "slugs_and_times": rf"""
            WITH a AS (SELECT doc_id, {slug("regexp_replace(coalesce(text, ''), '[^A-Za-z0-9._-]+', '-', 'g')")} AS s, doc_id * 997 AS t FROM documents),
            b AS (SELECT doc_id, t, {slug("left(CASE WHEN s = '' THEN 'run' ELSE s END, 64)")} AS s FROM a)
            SELECT doc_id, CASE WHEN s = '' THEN 'run' ELSE s END AS slug, CASE WHEN t >= 86400 THEN (t // 86400) || 'd ' ELSE '' END || printf('%02d:%02d:%02d', t % 86400 // 3600, t % 3600 // 60, t % 60) AS age FROM b""",
        "counts_with_total": "SELECT source, count(*) AS n FROM documents GROUP BY 1 UNION ALL SELECT 'Total', count(*) FROM documents",
        "legacy_outcomes": rf"""
            WITH a AS (SELECT doc_id, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: x <> '') AS ls FROM documents),
            b AS (SELECT doc_id, len(ls) AS n, coalesce(ls[1], '') AS x, regexp_split_to_array(lower(coalesce(ls[1], '')), '[^\p{{L}}]+') AS w FROM a)
            SELECT doc_id, CASE WHEN length(x) < 40 THEN 'structural_failure' WHEN n > 1 OR NOT (length(regexp_replace(x, '[^A-Za-z]', '', 'g')) >= 20 AND {english()} AND {valid}) THEN 'partially_filtered' ELSE 'unfiltered' END AS outcome, CASE WHEN length(x) < 40 THEN 0 ELSE n END AS sections FROM b""",
    }
