"""Runs whose outputs become visible together, on any Hadoop file system.

A run writes its parts into a folder of its own. It counts once its manifest lies among the commits, under the next
number, where one rename puts it that overwrites nothing: of two runs at once one fails and is called again. Readers read the
folders that manifests name, so what a run has left that broke off is never seen, and :func:`sweep` deletes it.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

#: Folders of an output: manifests by number, and the runs' own folders.
COMMITS, RUNS = "_commits", "_runs"


class Conflict(RuntimeError):
    """Another run has committed since this one began."""


def _at(spark: SparkSession, path: str):
    """The file system of a path, and the path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under a temporary name and rename it into place, in place of one that is there."""
    folder, _, name = path.rpartition("/")
    own = f"{folder}/.{name}.{uuid.uuid4().hex}"
    fs, where = _at(spark, own)
    out = fs.create(where, True)
    out.write(bytearray(text.encode()))
    out.close()
    _rename(spark, own, path, True)


def _rename(spark: SparkSession, source: str, target: str, overwrite: bool) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs, target_path = _at(spark, target)
    kinds = spark._sc._gateway.new_array(hadoop.Options.Rename, 1)
    kinds[0] = hadoop.Options.Rename.OVERWRITE if overwrite else hadoop.Options.Rename.NONE
    context = hadoop.FileContext.getFileContext(fs.makeQualified(target_path).toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(_at(spark, source)[1]), fs.makeQualified(target_path), kinds)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is none."""
    fs, where = _at(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, where = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def committed(spark: SparkSession, output: str) -> list[dict]:
    """The manifests of an output's runs, oldest first: number, run, parts (name -> folder below the output), note."""
    names = [n for n in _names(spark, f"{output}/{COMMITS}") if n.endswith(".json") and not n.startswith(".")]
    return [json.loads(read_text(spark, f"{output}/{COMMITS}/{n}")) for n in names]


def folders(spark: SparkSession, output: str, part: str) -> list[str]:
    """Where the committed runs have a part."""
    return [f"{output}/{m['parts'][part]}" for m in committed(spark, output) if part in m["parts"]]


def read_json(spark: SparkSession, output: str, part: str, schema: str | None = None) -> DataFrame:
    """All committed rows of a part of JSON lines; an empty table of ``schema`` before the first commit."""
    if not (where := folders(spark, output, part)):
        return spark.createDataFrame([], schema or "value string")
    reader = spark.read.option("recursiveFileLookup", True)  # several folders with partition folders below them
    return (reader.schema(schema) if schema else reader).json(where)


class Run:
    """A run into ``output`` that has not been committed yet."""

    def __init__(self, spark: SparkSession, output: str):
        self.spark, self.output, self.name = spark, output.rstrip("/"), uuid.uuid4().hex
        self.before, self.parts = committed(spark, self.output), {}

    def place(self, part: str) -> str:
        """The folder to write a part to."""
        self.parts[part] = f"{RUNS}/{self.name}/{part}"
        return f"{self.output}/{self.parts[part]}"

    def commit(self, note: dict) -> dict:
        """Make all parts visible, with ``note``; raises :class:`Conflict` if another run was quicker."""
        number = self.before[-1]["number"] + 1 if self.before else 1
        manifest = {"number": number, "run": self.name, "parts": self.parts, "note": note}
        own, target = f"{self.output}/{RUNS}/{self.name}/manifest.json", f"{self.output}/{COMMITS}/{number:08d}.json"
        write_text(self.spark, own, json.dumps(manifest, ensure_ascii=False))
        fs, folder = _at(self.spark, f"{self.output}/{COMMITS}")
        fs.mkdirs(folder)
        try:
            _rename(self.spark, own, target, False)
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" in str(e.java_exception.getClass().getName()):
                raise Conflict(f"{target} is there already") from None
            raise
        return manifest


def sweep(spark: SparkSession, output: str) -> int:
    """Delete the folders of runs that were never committed; only while no run is under way. Returns how many."""
    output = output.rstrip("/")
    known = {m["run"] for m in committed(spark, output)}
    lost = [n for n in _names(spark, f"{output}/{RUNS}") if n not in known]
    for name in lost:
        fs, where = _at(spark, f"{output}/{RUNS}/{name}")
        fs.delete(where, True)
    return len(lost)
