"""Model-based relevance judgement: prompts, keys, packing, replies and their summary. The model itself is injected."""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quarry.scratch import saved, split_join

# Fixed values that results depend on.
DECISIONS = ("relevant", "maybe", "irrelevant")
PRIORITY = ("introduction", "abstract", "results", "results and discussion", "materials and methods", "methodology", "background", "overview", "summary", "conclusion", "discussion")
PROMPT = """You are judging document relevance.

Rubric:
{rubric}

Return ONLY valid JSON with this schema:
{{
  "decision": "relevant" | "irrelevant" | "maybe",
  "score": 0 | 1 | 2 | 3,
  "rationale": "short explanation, max 2 sentences"
}}

Document:
"""
SYSTEM = "You are a helpful assistant."
#: Characters beyond its header that must be left for a section that is cut.
LEAST_ROOM = 20
#: Bytes of lines that one task packs; maps of runs that one task combines.
PACK_BYTES, FAN = 32 << 20, 32
#: What a run of lines does to the chunk before it, for each number of its lines that may go in there.
_MAP = "array<struct<bytes: bigint, chunks: bigint, used: bigint>>"


def ordered_sections(sections: Column, markers: tuple[str, ...] = PRIORITY) -> Column:
    """Sections by the first marker that their lower-cased header holds, others last; order is kept among equals."""
    def rank(h: Column) -> Column:
        at = F.array(*(F.when(F.contains(F.lower(h), F.lit(m)), F.lit(i)) for i, m in enumerate(markers)))
        return F.coalesce(F.array_min(at), F.lit(len(markers)))

    keyed = F.transform(sections, lambda s, i: F.struct(rank(s["header"]).alias("r"), i.alias("i"), s.alias("s")))
    return F.transform(F.array_sort(keyed), lambda x: x["s"])


def truncated(title: Column, abstract: Column, sections: Column, limit: int) -> Column:
    """Title, abstract and the sections that fit in ``limit`` characters, in the order given.

    The first section that doesn't fit is cut, if more than ``LEAST_ROOM`` characters of it fit, and ends the text. A
    prelude that fills the limit alone is cut to it.
    """
    prelude = F.concat(F.lit("Title: "), F.coalesce(title, F.lit("")), F.lit("\n\nAbstract:\n"), F.coalesce(abstract, F.lit("")), F.lit("\n\nSections:"))
    head = lambda s: F.concat(F.lit("\n\n## "), s["header"], F.lit("\n"))
    sizes = F.transform(sections, lambda s: F.length(head(s)) + F.length(s["text"]))
    room = F.lit(limit) - F.length(prelude)
    start = F.struct(F.lit(0).alias("n"), room.cast("int").alias("room"), F.lit(False).alias("done"))
    fitting = F.aggregate(sizes, start, lambda a, n: F.when(a["done"] | (n > a["room"]), F.struct(a["n"].alias("n"), a["room"].alias("room"), F.lit(True).alias("done"))).otherwise(F.struct((a["n"] + 1).alias("n"), (a["room"] - n).alias("room"), F.lit(False).alias("done"))))
    whole = F.array_join(F.transform(F.slice(sections, 1, fitting["n"]), lambda s: F.concat(head(s), s["text"])), "")
    last = F.get(sections, fitting["n"])
    left = fitting["room"] - F.length(head(last))
    cut = F.when(left > LEAST_ROOM, F.concat(head(last), F.regexp_replace(F.substring(last["text"], F.lit(1), left), r"\s+$", "")))
    return F.when(room <= 0, F.substring(prelude, 1, limit)).otherwise(F.concat(prelude, whole, F.coalesce(cut, F.lit(""))))


def judge_prompt(rubric: str, title: Column, abstract: Column, sections: Column, limit: int) -> Column:
    """The prompt for a document: the rubric, the form of the answer, and the document's text up to ``limit`` characters."""
    text = truncated(title, abstract, ordered_sections(sections), limit)
    return F.regexp_replace(F.concat(F.lit(PROMPT.format(rubric=rubric.strip())), text), r"^\s+|\s+$", "")


def job_key(*fields: Column) -> Column:
    """SHA-256 of the fields joined by line feeds: source_path, doc_id, input hash, prompt hash, model, base url."""
    return F.sha2(F.concat_ws("\n", *(F.coalesce(f, F.lit("")) for f in fields)), 256)


@F.pandas_udf(StringType())
def _python_json(row: pd.Series) -> pd.Series:
    return row.map(lambda x: json.dumps(json.loads(x), sort_keys=True, ensure_ascii=False), na_action="ignore")


def input_sha256(doc: Column) -> Column:
    """Digest of a document struct in the JSON form with sorted keys and spaced separators."""
    return F.sha2(_python_json(F.to_json(doc, {"ignoreNullFields": "false"})), 256)


def parse_reply(reply: Column) -> Column:
    """struct(decision, score, rationale, parsed, parse_error) of a model's reply: a JSON object, maybe in a code fence.

    decision is one of DECISIONS (trimmed, any case), score an integer from 0 to 3. Decision and rationale survive when
    only the score is wrong.
    """
    body = F.regexp_replace(F.trim(F.coalesce(reply, F.lit(""))), r"^```[A-Za-z]*\s*|\s*```$", "")
    text = F.regexp_extract(body, r"(?s)\{.*\}", 0)
    v = F.try_parse_json(F.when(text != "", text))
    get = lambda path, kind: F.try_variant_get(v, path, kind)
    decision = F.lower(F.trim(get("$.decision", "string")))
    good = F.coalesce(decision.isin(*DECISIONS), F.lit(False))
    raw = get("$.score", "string")
    integer = F.coalesce(raw.rlike(r"^-?\d+$") & F.schema_of_variant(get("$.score", "variant")).isin("BIGINT", "TINYINT", "SMALLINT", "INT"), F.lit(False))
    score = F.when(integer, raw.try_cast("int"))
    in_range = F.coalesce(score.between(0, 3), F.lit(False))
    error = F.when(v.isNull(), "invalid JSON").when(~good, "invalid decision").when(~integer, "score is not an integer").when(~in_range, "score out of range")
    return F.struct(F.when(good, decision).alias("decision"), F.when(in_range & good, score).alias("score"), get("$.rationale", "string").alias("rationale"), error.isNull().alias("parsed"), error.alias("parse_error"))


def summarize(results: DataFrame, keys: list[str], order: str) -> DataFrame:
    """decision, docs over the first result of each key by ``order``; a failed parse counts as ``parse_failure``."""
    first = results.groupBy(*keys).agg(F.min_by(F.struct("decision", "parsed"), order).alias("r"))
    return first.groupBy(F.when(F.col("r.parsed"), F.col("r.decision")).otherwise("parse_failure").alias("decision")).agg(F.count(F.lit(1)).alias("docs"))


def of_run(results: DataFrame, expected: DataFrame, model: str, base_url: str, prompt_sha256: str) -> DataFrame:
    """Result rows that belong to a run: its model, gateway and prompt, and the input that ``expected`` (source_path, input_sha256) now has."""
    same = (F.col("model") == model) & (F.col("base_url") == base_url) & (F.col("prompt_sha256") == prompt_sha256)
    return split_join(results.where(same), expected.select("source_path", "input_sha256").distinct(), ["source_path", "input_sha256"], "left_semi")


def run_summary(results: DataFrame, order: str) -> DataFrame:
    """One row: succeeded, parse_failures, decision_counts (a map, sorted by key) over the first row of each source_path and input."""
    first = results.groupBy("source_path", "input_sha256").agg(F.min_by(F.struct("decision", "parsed"), order).alias("r")).select("r.*")
    counts = F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("decision").isNotNull(), F.struct("decision", "docs")))))
    by = first.groupBy("decision").agg(F.count(F.lit(1)).alias("docs"), F.count(F.when(~F.coalesce("parsed", F.lit(False)), 1)).alias("bad"))
    return by.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("succeeded"), F.coalesce(F.sum("bad"), F.lit(0)).alias("parse_failures"), counts.alias("decision_counts"))


def keep_decisions(value: str) -> list[str]:
    """The decisions of a comma list, checked; at least one."""
    found = {x.strip().lower() for x in value.split(",") if x.strip()}
    if bad := found - set(DECISIONS):
        raise ValueError(f"invalid decision(s): {', '.join(sorted(bad))}")
    if not found:
        raise ValueError("provide at least one decision")
    return sorted(found)


def kept_documents(docs: DataFrame, results: DataFrame, decisions: str, id_col: str = "source_path") -> DataFrame:
    """Documents whose parsed judgement is one of ``decisions`` (a comma list)."""
    good = results.where(F.col("parsed") & F.col("decision").isin(*keep_decisions(decisions))).select(id_col).distinct()
    return docs.join(good, id_col, "left_semi")


class _Packing:
    """Greedy packing of one run of lines: where chunks begin depends on what the chunk before has left."""

    def __init__(self, sizes: np.ndarray, most: int):
        self.upto, self.most, n = np.r_[0, np.cumsum(sizes)], most, len(sizes)
        # a chunk that begins at line i ends before line after[i]; an oversize line is a chunk alone
        self.after = np.maximum(np.searchsorted(self.upto, self.upto[:-1] + most, "right") - 1, np.arange(1, n + 1))
        self.chunks, self.used = np.ones(n + 1, np.int64), np.zeros(n + 1, np.int64)
        for i in range(n - 1, -1, -1):
            j = int(self.after[i])
            self.chunks[i], self.used[i] = (1, self.upto[n] - self.upto[i]) if j >= n else (self.chunks[j] + 1, self.used[j])

    def first(self, used: int) -> int:
        """Lines that go into a chunk that already holds ``used`` bytes (0: none)."""
        return max(int(np.searchsorted(self.upto, self.most - used, "right")) - 1, 0) if used else 0

    def summary(self) -> list[dict]:
        """For each number of lines that may go into the chunk before: bytes of these, chunks that begin here, and bytes in the last."""
        n = min(len(self.chunks) - 1, int(np.searchsorted(self.upto, self.most, "right")))
        end = len(self.chunks) - 1
        return [{"bytes": int(self.upto[i]), "chunks": int(self.chunks[i]) if i < end else 0, "used": int(self.used[i]) if i < end else -1} for i in range(n + 1)]

    def numbers(self, chunk: int, used: int) -> np.ndarray:
        i, out = self.first(used), np.full(len(self.chunks) - 1, chunk, np.int64)
        if not used:
            chunk -= 1
        while i < len(out):
            chunk += 1
            out[i : self.after[i]] = chunk
            i = int(self.after[i])
        return out


def _entry(runs: list[dict], used: int, most: int) -> dict:
    """What a map says of a chunk that holds ``used`` bytes: its entry for the most lines that still fit."""
    return runs[max((k for k, x in enumerate(runs) if used + x["bytes"] <= most), default=0) if used else 0]


def _after(runs: list[dict], chunk: int, used: int, most: int) -> tuple[int, int]:
    """Number of the chunk that is open after a run, and its bytes, from those before it; (0, 0) is a group's start."""
    x = _entry(runs, used, most)
    if x["used"] < 0:  # all lines go into the chunk before
        return chunk, used + x["bytes"]
    return chunk + x["chunks"] - (not used), x["used"]


def _composed(first: list[dict], then: list[dict], most: int) -> list[dict]:
    """The map of two neighbouring runs. It has an entry for each number of lines that may go into the chunk before, as they have."""
    out = []
    for x in first:
        if x["used"] >= 0:
            y = _entry(then, x["used"], most)
            more = y["used"] < 0
            out.append({"bytes": x["bytes"], "chunks": x["chunks"] + (0 if more else y["chunks"]), "used": x["used"] + y["bytes"] if more else y["used"]})
        else:  # the first run goes into the chunk before as a whole, and maybe lines of the next
            out += [{"bytes": x["bytes"] + y["bytes"], "chunks": y["chunks"], "used": y["used"]} for y in then if x["bytes"] + y["bytes"] <= most or not y["bytes"]]
    return out


def _levels(maps: DataFrame, kind: str, most: int, fan: int) -> list[DataFrame]:
    """Tables (g, node, map) from the runs up to one map a group; each is made of at most ``fan`` maps of the one below."""
    shape, levels, top = f"g {kind}, node bigint, map {_MAP}", [maps], maps.agg(F.max("node")).first()[0] or 0

    def fold(key: tuple, table: pa.Table) -> pa.Table:
        every = table.sort_by("node").column("map").to_pylist()
        for runs in every[1:]:
            every[0] = _composed(every[0], runs, most)
        return pa.table({"g": pa.array([key[0].as_py()], table.schema.field("g").type), "node": pa.array([key[1].as_py()], pa.int64()), "map": pa.array([every[0]], table.schema.field("map").type)})

    while top:
        above = levels[-1].select("g", F.expr(f"node div {fan}").alias("parent"), "node", "map").groupBy("g", "parent").applyInArrow(fold, shape)
        levels.append(saved(above, "chunk-maps"))
        top //= fan
    return levels


def _begins(levels: list[DataFrame], kind: str, most: int, fan: int) -> DataFrame:
    """g, node, chunk, used: what each run of lines finds, handed down from the groups' starts through the levels."""
    def spread(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        chunk, used, out = table.column("chunk")[0].as_py(), table.column("used")[0].as_py(), []
        for runs in table.column("map").to_pylist():
            out.append((chunk, used))
            chunk, used = _after(runs, chunk, used, most)
        return table.select(["g", "node"]).append_column("chunk", pa.array([c for c, _ in out], pa.int64())).append_column("used", pa.array([u for _, u in out], pa.int64()))

    start = levels[-1].select("g", "node", F.lit(0).cast("bigint").alias("chunk"), F.lit(0).cast("bigint").alias("used"))
    for below in reversed(levels[:-1]):
        parent = start.select(F.col("g").alias("__g"), F.col("node").alias("parent"), "chunk", "used")
        own = below.withColumn("parent", F.expr(f"node div {fan}"))
        both = own.join(parent, own["g"].eqNullSafe(parent["__g"]) & (own["parent"] == parent["parent"])).select("g", own["parent"], "node", "map", "chunk", "used")
        start = saved(both.groupBy("g", "parent").applyInArrow(spread, f"g {kind}, node bigint, chunk bigint, used bigint"), "chunk-begins")
    return start


def pack_chunks(lines: DataFrame, size: str, group: str, order: str, most: int, part_bytes: int = PACK_BYTES, fan: int = FAN) -> DataFrame:
    """Adds chunk: greedy packing within a group, a new chunk when a line doesn't fit a chunk that holds something.

    Lines are range-partitioned by group and order, so a large group is packed by many tasks: each describes what its
    run of lines does to a chunk with any number of bytes in it. These maps compose associatively and are combined by a
    prefix scan of logarithmic depth, ``fan`` to one on the way up, and on the way down each run learns the chunk that it
    finds; then each task numbers its lines. A task has ``fan`` maps at most, each of a few numbers for a line of a chunk.
    """
    names = lines.columns
    total = lines.agg(F.coalesce(F.sum(F.col(size).cast("long")), F.lit(0))).first()[0]
    parts = max(1, -(-total // part_bytes))
    placed = lines.repartitionByRange(parts, group, order).withColumn("__part", F.spark_partition_id().cast("long"))
    placed = saved(placed.withColumn("__size", F.col(size).cast("long")), "lines")

    def sizes(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
        table = table.sort_by(order)
        return table, table.column("__size").to_numpy()

    def describe(key: tuple, table: pa.Table) -> pa.Table:
        runs = _Packing(sizes(table)[1], most).summary()
        return pa.table({"g": pa.array([key[0].as_py()], table.schema.field("g").type), "node": pa.array([key[1].as_py()], pa.int64()), "map": pa.array([runs], pa.list_(pa.struct([("bytes", pa.int64()), ("chunks", pa.int64()), ("used", pa.int64())])))})

    kind = lines.schema[group].dataType.simpleString()
    light = placed.select(F.col(group).alias("g"), F.col("__part").alias("node"), F.col(order).alias(order), "__size")
    maps = light.groupBy("g", "node").applyInArrow(describe, f"g {kind}, node bigint, map {_MAP}")
    begins = _begins(_levels(saved(maps, "chunk-maps"), kind, most, fan), kind, most, fan)
    begins = begins.select(F.col("g").alias("__g"), F.col("node").alias("__node"), F.col("chunk").alias("__chunk"), F.col("used").alias("__used"))

    def number(table: pa.Table) -> pa.Table:
        table, own = sizes(table)
        chunk, used = table.column("__chunk")[0].as_py(), table.column("__used")[0].as_py()
        return table.select(names).append_column("chunk", pa.array(_Packing(own, most).numbers(chunk, used), pa.int32()))

    both = placed.join(begins, placed[group].eqNullSafe(begins["__g"]) & (placed["__part"] == begins["__node"]))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in lines.schema)
    return both.groupBy("__g", "__part").applyInArrow(number, f"{schema}, chunk int")


def collect_batch(output: DataFrame, manifest: DataFrame) -> DataFrame:
    """Full outer join of batch output and manifest on custom_id: status ok, unknown_id or missing_output."""
    o, m = output.withColumn("__o", F.lit(True)), manifest.withColumn("__m", F.lit(True))
    both = o.join(m, "custom_id", "full_outer")
    status = F.when(F.col("__o") & F.col("__m"), "ok").when(F.col("__o"), "unknown_id").otherwise("missing_output")
    return both.withColumn("status", status).drop("__o", "__m")


def request_line(model: str, key: Column, prompt: Column, max_tokens: int = 512, temperature: float = 0.0) -> Column:
    """A line of a batch request file."""
    messages = F.array(*(F.struct(F.lit(role).alias("role"), text.alias("content")) for role, text in (("system", F.lit(SYSTEM)), ("user", prompt))))
    body = F.struct(F.lit(model).alias("model"), messages.alias("messages"), F.lit(temperature).alias("temperature"), F.lit(max_tokens).alias("max_tokens"))
    return F.to_json(F.struct(key.alias("custom_id"), F.lit("POST").alias("method"), F.lit("/v1/chat/completions").alias("url"), body.alias("body")))


def one_model(lines: DataFrame) -> str:
    """The model that all request lines name; an error if they name several or none, or if a line has none."""
    found = lines.where("trim(line) <> ''").select(F.get_json_object("line", "$.body.model").alias("m")).distinct().limit(2).collect()
    if len(found) != 1 or found[0].m is None:
        raise ValueError(f"request lines must name one model, not {[r.m for r in found]}")
    return found[0].m


def sha256_text(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
