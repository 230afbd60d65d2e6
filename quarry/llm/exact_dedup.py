"""Exact deduplication by content-defined chunk recipes (operator 10); DataFrame functions only.

A normalised text is cut where its content says so, every chunk gets an identifier, and a document becomes the ordered
list of its chunk identifiers, its recipe. Equal recipes mean equal texts because identifiers are verified: an
identifier is a chunk's hash wherever all chunks with that hash have one SHA-256, and the hash with a rank otherwise.

Scale: texts are read once and never move. A pass writes the recipes (40 bytes a chunk, some 3 % of the text);
verification combines two digests an identifier, groups are formed on recipes of 8 bytes a chunk as partial
aggregates, and the join back splits a hot recipe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm._shared import saved, split_join

#: A chunk has LEAST to MOST code points and ends after the first match of CUT in between (the last chunk ends with the text).
LEAST, MOST, CUT = 512, 4096, "(?<=[aeint][dhlrsu])(?=[b-t])(?=.[aeor][lnst])"


def normalised(text: Column) -> Column:
    """The text without the characters of ``[\\x20\\x09-\\x0D]``; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def chunks(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """Content-defined chunks of a text, in order; together they are the text."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{{least},{most}}}?{CUT}|.{{1,{most}}}"), F.lit(0))


def _hash(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def recipes(docs: DataFrame, least: int = LEAST, most: int = MOST, identify=_hash) -> DataFrame:
    """doc_id, points (code points of the original text), text_sha256 and recipe [(h, check)] of every row: the one pass over texts.

    h is the identifier of a chunk, check a 256-bit digest that verifies it.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text")).alias("norm"), F.length(F.coalesce("text", F.lit(""))).alias("points"))
    recipe = F.transform(chunks(F.col("norm"), least, most), lambda c: F.struct(identify(c).cast("long").alias("h"), F.unhex(F.sha2(c, 256)).alias("check")))
    return rows.select("doc_id", "points", F.sha2("norm", 256).alias("text_sha256"), recipe.alias("recipe"))


def collisions(known: DataFrame) -> DataFrame:
    """(h, check, rank) of identifiers that stand for more than one chunk in ``known``; empty when all are verified.

    The two ends of the digests tell whether an identifier has one chunk, so what is combined and shuffled is a row per
    identifier. Only the chunks of colliding ones are listed.
    """
    every = known.select(F.explode("recipe").alias("c")).select("c.h", "c.check")
    clash = every.groupBy("h").agg(F.min("check").alias("low"), F.max("check").alias("high")).where("low <> high").select("h")
    distinct = split_join(every, clash, ["h"], "left_semi").distinct()
    alone = distinct.groupBy("h").agg(F.array_sort(F.collect_set("check")).alias("checks"))  # chunks with one 64-bit hash
    return alone.select("h", F.posexplode("checks").alias("rank", "check"))


def exact_duplicates(docs: DataFrame, least: int = LEAST, most: int = MOST, identify=_hash) -> DataFrame:
    """Groups of documents whose texts are equal after white space is deleted.

    Of a group the row with the most code points in its original text stays, of those the one with the smallest
    doc_id. Returns one row per input row: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text).
    A null text counts as empty, and all empty texts form one group. Other columns are not looked at. Of rows that
    repeat the staying doc_id each is kept. A null doc_id orders after all others; a group of nothing else has
    keep_id null and keeps its rows. An empty table gives an empty result.
    """
    known = saved(recipes(docs, least, most, identify), "recipes")
    clash = collisions(known)
    if clash.isEmpty():
        named = known.withColumn("recipe", F.transform("recipe", lambda c: c["h"]))
    else:  # an identifier becomes the hash and the rank of its chunk
        at = saved(known.withColumn("row", F.monotonically_increasing_id()), "recipes")
        pieces = at.select("row", F.posexplode("recipe").alias("pos", "c")).select("row", "pos", "c.h", "c.check")
        ranks = split_join(pieces, clash, ["h", "check"], "left").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("pos", "h", F.coalesce("rank", F.lit(0)).alias("rank")))).alias("named"))
        flat = F.flatten(F.transform("named", lambda s: F.array(s["h"], s["rank"].cast("long"))))
        named = at.drop("recipe").join(ranks, "row", "left").withColumn("recipe", F.coalesce(flat, F.array().cast("array<bigint>")))
    first = F.struct((-F.col("points")).alias("less"), F.coalesce("doc_id", F.lit(2**63 - 1)).alias("by"), F.col("doc_id"))
    groups = named.groupBy("recipe").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("group_size")).select("recipe", F.col("first.doc_id").alias("keep_id"), "group_size")
    found = split_join(named.select("doc_id", "text_sha256", "recipe"), groups, ["recipe"])
    return found.select("doc_id", "keep_id", "group_size", F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"), "text_sha256")


def unique(docs: DataFrame, broadcast_ids: int = 1_000_000) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group of equal texts; columns as in ``docs``.

    A row goes if its own text is a copy: of a doc_id that repeats with other texts, the other rows stay. Rows that
    repeat the staying doc_id with an equal text all stay, and so do rows without doc_id.
    """
    gone = saved(exact_duplicates(docs).where("not kept and doc_id is not null").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")).distinct(), "copies")
    if not (n := gone.count()):
        return docs
    if n <= broadcast_ids:  # 80 bytes a row
        gone = F.broadcast(gone)
    held = (docs["doc_id"].cast("long") == gone["__id"]) & (F.sha2(normalised(docs["text"]), 256) == gone["__sha"])
    return docs.join(gone, held, "left_anti")
