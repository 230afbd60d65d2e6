"""Splitting a trailing reference list off a text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.text import reference_score


def split_references(text: Column) -> Column:
    """struct(content, refs): paragraphs are read from the end; one that scores moves the cut, more than two low ones in a row stop it."""
    parts = F.filter(F.split(F.coalesce(text, F.lit("")), "\n\n+"), lambda p: F.trim(p) != "")
    good = F.reverse(F.transform(parts, lambda p: reference_score(p) >= 1))
    start = F.struct(F.lit(0).alias("seen"), F.lit(0).alias("cut"), F.lit(0).alias("low"))
    walk = F.aggregate(good, start, lambda a, ok: F.when(a["low"] > 2, a).otherwise(F.struct((a["seen"] + 1).alias("seen"), F.when(ok, a["seen"] + 1).otherwise(a["cut"]).alias("cut"), F.when(ok, 0).otherwise(a["low"] + 1).alias("low"))))
    cut, n = walk["cut"], F.size(parts)
    content = F.array_join(F.slice(parts, 1, n - cut), "\n\n")
    refs = F.when(cut > 0, F.array_join(F.slice(parts, n - cut + 1, cut), "\n\n"))
    return F.struct(content.alias("content"), refs.alias("refs"))
