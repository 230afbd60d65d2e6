"""Raw and written documents as tables bucketed by id, so that audits and lookups join them without moving a text.

Two tables of one number of buckets are joined bucket by bucket. Ids that are looked up are dealt out to the buckets;
what moves is the ids. A bucket is a task, so a corpus wants as many as keep a bucket within a task's memory, and both its
tables the same number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import sections


def save(docs: DataFrame, table: str, buckets: int, key: str = "corpusid", path: str | None = None) -> DataFrame:
    """Write ``docs`` as a table of ``buckets`` buckets by ``key`` (as text), each one file, sorted; this is the one time that texts are moved.

    The files go to ``path``, else into the warehouse.
    """
    rows = docs.withColumn(key, F.col(key).cast("string")).repartition(buckets, key)
    writer = rows.write.bucketBy(buckets, key).sortBy(key).mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return docs.sparkSession.table(table)


def buckets_of(spark: SparkSession, table: str) -> int:
    """How many buckets a table has; an error if it isn't bucketed."""
    found = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    if "Num Buckets" not in found:
        raise ValueError(f"{table} isn't bucketed")
    return int(found["Num Buckets"])


def lookup(spark: SparkSession, table: str, ids: DataFrame, key: str = "corpusid") -> tuple[DataFrame, DataFrame]:
    """Documents of a bucketed table whose id is in ``ids`` (a column ``key``), and the ids without a document; repeated and null ids count once and not at all."""
    wanted = ids.select(F.col(key).cast("string").alias(key)).where(f"{key} is not null").repartition(buckets_of(spark, table), key).distinct()
    docs = spark.table(table)
    # the documents are the larger side; a hint keeps a short list of ids from being sent to every task
    return docs.join(wanted.hint("merge"), key, "left_semi"), wanted.join(docs.select(key).hint("merge"), key, "left_anti")


def audit(spark: SparkSession, raw: str, written: str, **options) -> DataFrame:
    """:func:`quarry.operators.sections.audit` of two bucketed tables, in which no text is moved."""
    if buckets_of(spark, raw) != buckets_of(spark, written):
        raise ValueError("the tables of raw and written documents must have the same number of buckets")
    return sections.audit(spark.table(raw), spark.table(written), **options)


def verify(spark: SparkSession, raw: str, written: str, **options) -> dict:
    """:func:`quarry.operators.sections.verify` of two bucketed tables."""
    if buckets_of(spark, raw) != buckets_of(spark, written):
        raise ValueError("the tables of raw and written documents must have the same number of buckets")
    return sections.verify(spark.table(raw), spark.table(written), **options)
