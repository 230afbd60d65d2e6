"""Whole runs: raw documents of a folder to sectionized ones with reports, resumable.

A run's documents, report, failures and summary become visible together, when its manifest is renamed into place
(:mod:`quarry.sources.commits`); a run that breaks off leaves nothing that readers see, and its documents are pending still.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import sections
from quarry.operators.search import compile_patterns, pending
from quarry.scratch import saved
from quarry.sources import commits, discovery, documents

#: Parts of a run's output, and the file with the last run's summary.
DOCUMENTS, REPORT, FAILURES, SUMMARY = "documents", "report", "failures", "sectionization_report.json"
_WRITTEN = "corpusid string, title string, sections array<struct<header:string,text:string>>"


def written(spark: SparkSession, output: str) -> DataFrame:
    """corpusid, title and sections of the documents that committed runs into ``output`` have written; empty before the first."""
    return commits.read_json(spark, output, DOCUMENTS, _WRITTEN)


def reports(spark: SparkSession, output: str) -> DataFrame:
    """Report rows of all committed runs."""
    return commits.read_json(spark, output, REPORT)


def failed(spark: SparkSession, output: str) -> DataFrame:
    """Failure records of all committed runs."""
    return commits.read_json(spark, output, FAILURES, "corpus_id string, title string, external_ids map<string,string>, batch_file string, line_number long, error string")


def summary(spark: SparkSession, output: str) -> dict | None:
    """The summary of the last committed run; None before the first."""
    return done[-1]["note"] if (done := commits.committed(spark, output)) else None


def _show_summary(spark: SparkSession, output: str) -> None:
    """Write the last commit's summary to its file, unless it is there: a run may have ended just before it did."""
    text = json.dumps(summary(spark, output), indent=2, ensure_ascii=False)
    if commits.read_text(spark, f"{output}/{SUMMARY}") != text:
        commits.write_text(spark, f"{output}/{SUMMARY}", text)


def section_dataset(spark: SparkSession, source: str, output: str, exclude: str = "", exclude_lines: list[str] | None = None, pipeline: str = "v2", detail: bool = False, after: Callable[[str], None] = lambda part: None) -> dict:
    """Sectionize the documents under ``source`` that ``output`` doesn't hold yet; returns the summary, which is also written.

    v2 reads shards of raw documents (either layout); v1 reads multi-valued documents, a JSON file each or lines of
    .jsonl.gz, and takes no exclusion patterns. Documents with sections go to ``documents`` by bucket, a report row for
    each one seen (with its sections if ``detail``) to ``report``, lines that don't parse and documents that fail to
    ``failures``; read them by :func:`written`, :func:`reports` and :func:`failed`. The summary is of this run alone,
    with the number of documents written before. ``after`` is told when a part has been written, and of ``commit``.
    """
    if pipeline not in ("v1", "v2"):
        raise ValueError("pipeline must be v1 or v2")
    discovery.apart(source, output)
    patterns = compile_patterns(exclude, exclude_lines)
    output = output.rstrip("/")
    run, before = commits.Run(spark, output), written(spark, output)
    if run.before:
        _show_summary(spark, output)
    if pipeline == "v2":
        shards = [p for p in discovery.listed(spark, source) if p.endswith((".gz", ".json", ".jsonl"))]
        if not shards:
            raise LookupError(f"no shards under {source}")
        good, _ = documents.read_shards(spark, shards)
        broken = documents.failures(discovery.numbered_lines(spark, shards))
        done = sections.sectionize(pending(sections.normalise_schema(good), before, "corpusid"), patterns)
    else:
        if patterns:
            raise ValueError("v1 takes no exclusion patterns")
        files = discovery.batch_files(spark, source) or discovery.document_files(spark, source)
        if not files:
            raise LookupError(f"no documents under {source}")
        good = documents.read_legacy(spark, files)
        broken = None
        done = sections.sectionize_legacy(good.join(before.select(F.col("corpusid").alias("__id")), F.element_at("corpus_id", 1) == F.col("__id"), "left_anti"))
    done = saved(done, "sectionized")
    previously = sum(m["note"]["totals"]["written"] for m in run.before)
    kept = done.where("size(sections) > 0").select("corpusid", "title", "sections", documents.bucket(F.col("corpusid")).alias("bucket"))
    kept.write.partitionBy("bucket").json(run.place(DOCUMENTS))
    after(DOCUMENTS)
    report = sections.doc_report(done)
    rows = report.join(done.select("corpusid", F.col("detail").alias("sections")), "corpusid") if detail else report
    documents.write_report(rows, run.place(REPORT))
    after(REPORT)
    lost = done.where("outcome = 'structural_failure'").select(F.col("corpusid").alias("corpus_id"), "title", F.create_map().cast("map<string,string>").alias("external_ids"), F.lit(None).cast("string").alias("batch_file"), F.lit(None).cast("long").alias("line_number"), F.lit("no content").alias("error"))
    (lost if broken is None else lost.unionByName(broken)).write.json(run.place(FAILURES))
    after(FAILURES)
    found = sections.summary_document(sections.corpus_report(report), sections.drops_by_reason(report), pipeline, source, previously)
    found["totals"]["written"] = kept.count()
    run.commit(found)
    after("commit")
    _show_summary(spark, output)
    return found
