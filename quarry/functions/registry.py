"""The engine's functions under SQL names, for sessions that work in SQL.

A column function becomes an SQL-defined function, whose body is the function's own expression as the analyser prints it; so it
is inlined into a query's plan and optimised with it. What needs Python is registered as an Arrow UDF that bodies may call.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import convert
from quarry.plans.keyword import compile_query

#: Column functions by name.
COLUMNS = {
    "string_valid": T.string_valid, "substantive": T.substantive, "normalize_ws": T.normalize_ws, "normalize_text": T.normalize_text, "normalize_header": T.normalize_header,
    "apply_synonyms": T.apply_synonyms, "structural_noise": T.structural_noise, "header_noise": T.header_noise, "reference_score": T.reference_score,
    "url_dominant": T.url_dominant, "strip_noise": T.strip_noise, "stopword_language": T.stopword_language,
}
#: What their expressions call, by the names that these print.
_PYTHON = {"_normalize_any": T._normalize_any, "_surface_any": T._surface_any, "_dominant": T._dominant, "_stripped": T._stripped}


def define(spark: SparkSession, name: str, function: Callable[[Column], Column]) -> str:
    """Make ``name(text)`` in SQL the column function ``function``; returns the body.

    A body that SQL doesn't read back is an error: functions with lambdas, or with literals as arguments of a Python UDF.
    """
    one = spark.sql("SELECT CAST(NULL AS STRING) AS text").select(function(F.col("text")).alias("y"))
    body = one._jdf.queryExecution().analyzed().expressions().head().child().sql()
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(text STRING) RETURN {body}")
    return body


def define_search(spark: SparkSession, name: str, query: str) -> str:
    """Make ``name(text)`` in SQL whether a text matches a boolean keyword query; the query is read now."""
    return define(spark, name, lambda text: compile_query(query, text))


def register(spark: SparkSession) -> list[str]:
    """Register all functions of ``COLUMNS`` as quarry_<name>, and the table functions; returns the names."""
    for name, f in _PYTHON.items():
        spark.udf.register(name, f)
    for name, f in COLUMNS.items():
        define(spark, f"quarry_{name}", f)
    spark.udtf.register("quarry_tei_sections", convert.TeiSections)
    return [f"quarry_{name}" for name in COLUMNS] + ["quarry_tei_sections"]


def add_columns(rows: DataFrame, text: str, **wanted: str) -> DataFrame:
    """``rows`` with a column for each ``name=function`` of ``COLUMNS``, applied to the column ``text``."""
    return rows.withColumns({name: COLUMNS[f](F.col(text)) for name, f in wanted.items()})


def keyword_match(text: str, query: str):
    """Whether a column matches a boolean keyword query; the query is read when the plan is made."""
    return compile_query(query, F.col(text))
