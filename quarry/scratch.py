"""Tables that an operator writes and reads again, in the folder that driver and executors share; joins that survive hot keys."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where it is unset, a local master gets one of its own; a cluster must set it."""
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        place = "file://" + tempfile.mkdtemp(prefix="quarry-")
        spark.conf.set("spark.checkpoint.dir", place)
    return place.rstrip("/")


#: Arrow batches of whole texts are bounded by bytes rather than by 10,000 rows: bounds a Python worker's memory.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


def bounded_batches(spark: SparkSession) -> None:
    """Set ``BATCHES`` for the session; for queries whose lazy result still runs Python, which must be called by them alone."""
    for k, v in BATCHES.items():
        spark.conf.set(k, v)


@contextlib.contextmanager
def batches(spark: SparkSession):
    """``BATCHES`` for the jobs within, the caller's settings after."""
    old = {k: spark.conf.get(k, None) for k in BATCHES}
    bounded_batches(spark)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


_written: list[tuple[SparkSession, str]] = []


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it again: cuts the lineage, survives lost executors.

    Results are lazy and may read such a table, so it stays until :func:`forget` or :func:`tidy`.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quarry/{name}-{uuid.uuid4().hex}"
    with batches(spark):
        df.write.parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Delete the files of tables made by :func:`saved` that nothing will read any more."""
    for df in tables:
        spark = df.sparkSession
        for parent in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            _delete(spark, parent)
            _written[:] = [x for x in _written if not parent.endswith(x[1].split("://")[-1])]


def tidy(spark: SparkSession) -> int:
    """Delete all tables that this process has saved; for when its results have been written. Returns how many."""
    gone, _written[:] = _written[:], []
    for own, path in gone:
        if own.sparkContext._jsc is not None:
            _delete(own, path)
    return len(gone)


def split_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join whose two sides always get an exchange of their own, so that adaptive execution can split a hot key.

    A side that was just aggregated by ``on`` would otherwise keep its partitioning, which rules the split out.
    The extra key is a function of ``on`` and changes no match. Null keys match nothing.
    """
    extra = F.xxhash64(*on).alias("__split")
    return left.select("*", extra).join(right.select("*", extra), [*on, "__split"], how).drop("__split")
