"""A training corpus from ``documents``: language ID, exact and near deduplication, decontamination, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import stages
from quarry.llm._shared import saved, table

STAGES = [
    ("language ID", stages.language),
    ("exact dedup", stages.exact),
    ("MinHash near-dedup", stages.near),
    ("benchmark decontamination", stages.leaks),
    ("packing", stages.packed),
]

#: Language models, signatures and the dynamic program have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequences of ``packing.pack`` for all documents that the first four stages keep.

    Null and empty texts don't pass the first stage; rows without doc_id pass all of them, and of repeated rows the
    copies go by the rules of the stages. An empty table gives an empty result.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
