"""Batch judgement as a state machine over files: write chunks, submit, wait, collect, resubmit. The gateway is injected.

Request lines and output lines are tables; what the driver holds is a row per chunk file. All state is in files of the
run's folder, so a run that stops goes on where it was: a chunk that the checkpoint or the gateway knows isn't sent again.
"""

from __future__ import annotations

import json
import os
import re
import time
from collections.abc import Callable
from datetime import UTC, datetime
from pathlib import Path
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.judge import collect_batch, one_model, parse_reply
from quarry.sources import files

# Names of a run's files and of states.
CHUNK, CHUNKS, INDEX, MANIFEST, CHECKPOINT = "batch_requests.jsonl", "batch_requests_{:03d}.jsonl", "batch_chunks.json", "batch_manifest", "batch_submit_checkpoint.json"
ACTIVE, TERMINAL = ("pending", "running"), ("completed", "failed")
STATE_OF = {"batch_ongoing": "ongoing", "batch_failed": "failed"}
#: Bytes of a chunk file, under the service's cap of 10 MB; batches that may be active at once.
CHUNK_BYTES, MOST_ACTIVE = 9_000_000, 2


class QuotaExceeded(Exception):
    """The gateway takes no more batches for now."""


class Gateway(Protocol):
    """What the state machine asks of a batch service."""

    def submit(self, model: str, input_file: str, output_folder: str) -> dict: ...
    def batches(self) -> list[dict]: ...
    def result(self, batch_id: str) -> tuple[int, dict]: ...


def write_json(path: str | Path, value: object) -> None:
    """A JSON file, put in place by a rename."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    own = path.with_name(f".{path.name}.{os.getpid()}.tmp")
    own.write_text(json.dumps(value, indent=2, ensure_ascii=False))
    own.replace(path)


def read_json(path: str | Path, default: object) -> object:
    return json.loads(Path(path).read_text()) if Path(path).exists() else default


def write_chunks(packed: DataFrame, folder: str, line: str = "line", order: str = "custom_id") -> list[dict]:
    """Chunk files of request lines that ``pack_chunks`` has numbered; index, path, num_requests and num_bytes of each.

    One chunk alone is batch_requests.jsonl, several are numbered from 000, with as many digits as it takes. A chunk is at
    most CHUNK_BYTES or one line; a task writes it, under a temporary name, into ``folder``, a path or URI that the tasks
    share. The driver gets a row for each file, and keeps these beside them for :func:`found_chunks`.
    """
    rows = packed.select(F.col("chunk").cast("long").alias("chunk"), F.col(order).alias("__order"), F.regexp_replace(line, r"\n+$", "").alias("__line"))
    top = rows.agg(F.max("chunk")).first()[0]
    if top is None:
        return []
    single = top == 0

    def write(key: tuple, table: pa.Table) -> pa.Table:
        index, lines = key[0].as_py(), table.sort_by("__order").column("__line").to_pylist()
        data = "".join(f"{x}\n" for x in lines).encode()
        path = f"{folder.rstrip('/')}/{CHUNK if single else CHUNKS.format(index)}"
        files.put(path, data)
        return pa.table({"index": pa.array([None if single else index], pa.int64()), "path": [path], "num_requests": pa.array([len(lines)], pa.int64()), "num_bytes": pa.array([len(data)], pa.int64())})

    made = rows.groupBy("chunk").applyInArrow(write, "index bigint, path string, num_requests bigint, num_bytes bigint")
    out = sorted((r.asDict() for r in made.collect()), key=lambda c: c["index"] or 0)
    files.put(f"{folder.rstrip('/')}/{INDEX}", json.dumps(out).encode())
    return out


def found_chunks(folder: str) -> list[dict]:
    """The chunk files of a folder as :func:`write_chunks` describes them, by number; numbered ones win over the single file.

    Only files of which the folder's own list doesn't know, or knows another size, are read to count their lines.
    """
    folder = folder.rstrip("/")
    listed = {c["path"].rsplit("/", 1)[-1]: c for c in json.loads(files.get(f"{folder}/{INDEX}") or b"[]")}
    names = files.names(folder)
    numbered = sorted((int(m[1]), n) for n in names if (m := re.fullmatch(r"batch_requests_(\d{3,})\.jsonl", n)))
    out = []
    for index, name in numbered or [(None, n) for n in names if n == CHUNK]:
        size, known = files.size(f"{folder}/{name}"), listed.get(name)
        if known is None or known["num_bytes"] != size:
            known = {"num_requests": sum(1 for x in (files.get(f"{folder}/{name}") or b"").split(b"\n") if x.strip()), "num_bytes": size}
        out.append({"index": index, "path": f"{folder}/{name}", "num_requests": known["num_requests"], "num_bytes": size})
    return out


def write_manifest(jobs: DataFrame, folder: str) -> None:
    """The table custom_id -> doc_id, source_path, title, input_sha256 of a run's jobs."""
    jobs.select("custom_id", "doc_id", "source_path", "title", "input_sha256").write.mode("overwrite").json(f"{folder}/{MANIFEST}")


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("custom_id string, doc_id string, source_path string, title string, input_sha256 string").json(f"{folder}/{MANIFEST}")


def absolute(flag: str, path: str | None) -> None:
    """The service reads its own file system: a relative path can't be found there."""
    if path is not None and not path.startswith("/"):
        raise ValueError(f"{flag} must be an absolute path on the service's storage, not {path!r}")


def remote_inputs(chunks: list[dict], folder: str | None = None, file: str | None = None) -> list[str]:
    """Where the service finds each chunk: under ``folder`` by its name, or the one ``file``."""
    if (folder is None) == (file is None):
        raise ValueError("give either a folder or a file of request chunks")
    absolute("folder", folder)
    absolute("file", file)
    if file is not None and len(chunks) != 1:
        raise ValueError(f"one file can't stand for {len(chunks)} chunks; give their folder")
    return [file] if file is not None else [f"{folder.rstrip('/')}/{Path(c['path']).name}" for c in chunks]


def _batch_id(batch: dict) -> str | None:
    return batch.get("batch_id") or batch.get("id")


def submit(gateway: Gateway, chunks: list[dict], inputs: list[str], output_folder: str, run: str, model: str, most_active: int = MOST_ACTIVE, poll: float = 60.0, pause: Callable[[float], None] = time.sleep, now: Callable[[], str] | None = None) -> dict[str, dict]:
    """Send each chunk that neither the checkpoint nor the gateway knows; returns the checkpoint: input -> batch_id, status, submitted_at.

    Waits while ``most_active`` batches are pending or running, and when the gateway says that its quota is full. The
    checkpoint is written after every batch.
    """
    absolute("output folder", output_folder)
    now = now or (lambda: datetime.now(UTC).isoformat())
    path = Path(run) / CHECKPOINT
    known: dict[str, dict] = dict(read_json(path, {"submitted": {}})["submitted"])
    there = {str(b["input_file"]): b for b in gateway.batches() if b.get("input_file")}
    for x in inputs:
        if x not in known and x in there:
            known[x] = {"batch_id": _batch_id(there[x]), "status": there[x].get("status"), "submitted_at": there[x].get("created_at"), "adopted_from_gateway": True}
    if known:
        write_json(path, {"submitted": known})
    for x in [x for _, x in zip(chunks, inputs, strict=True) if x not in known]:
        while sum(str(b.get("status", "")).lower() in ACTIVE for b in gateway.batches()) >= most_active:
            pause(poll)
        while True:
            try:
                answer = gateway.submit(model, x, output_folder)
                break
            except QuotaExceeded:
                pause(poll)
        known[x] = {"batch_id": _batch_id(answer), "status": answer.get("status"), "submitted_at": now()}
        write_json(path, {"submitted": known})
    return known


def resubmit(gateway: Gateway, spark: SparkSession, run: str, output_folder: str, folder: str, **options) -> dict[str, dict]:
    """Submit the chunk files that a run has written before, for the one model that their lines name."""
    if not (chunks := found_chunks(run)):
        raise ValueError(f"{run} holds no request chunks")
    model = one_model(spark.read.text([c["path"] for c in chunks]).withColumnRenamed("value", "line"))
    return submit(gateway, chunks, remote_inputs(chunks, folder), output_folder, run, model, **options)


def state_of(status: int, body: object) -> dict:
    """completed, ongoing, failed or unknown, with the error's code and message, from a result's HTTP status and body."""
    if status < 400:
        return {"state": "completed", "http_status": status, "result": body}
    error = body.get("error") if isinstance(body, dict) and isinstance(body.get("error"), dict) else {}
    code = str(error.get("code", "")).lower()
    return {"state": STATE_OF.get(code, "unknown"), "http_status": status, "code": code, "message": str(error.get("message", "")), "result": body}


def poll_results(gateway: Gateway, ids: list[str], wait: bool = False, poll: float = 60.0, pause: Callable[[float], None] = time.sleep, on_update: Callable[[dict], None] = lambda r: None) -> dict[str, dict]:
    """The state of each batch; with ``wait`` until all have completed or failed. ``on_update`` sees the states after each round."""
    found: dict[str, dict] = {}
    while True:
        for x in ids:
            if found.get(x, {}).get("state") not in TERMINAL:
                found[x] = {"batch_id": x} | state_of(*gateway.result(x))
        on_update(found)
        if not wait or all(found[x]["state"] in TERMINAL for x in ids):
            return found
        pause(poll)


def status(gateway: Gateway, run: str, **options) -> dict:
    """States of a run's batches by id, their counts, and when the first was submitted."""
    known = read_json(Path(run) / CHECKPOINT, {"submitted": {}})["submitted"]
    ids = [str(m["batch_id"]) for m in known.values() if m.get("batch_id")]
    if not ids:
        raise ValueError(f"{run} has no submitted batches")
    times = [t for t in (checkpoint_time(m.get("submitted_at")) for m in known.values()) if t]
    found = poll_results(gateway, ids, **options)
    counts: dict[str, int] = {}
    for r in found.values():
        counts[r["state"]] = counts.get(r["state"], 0) + 1
    return {"batches": found, "counts": dict(sorted(counts.items())), "earliest_submitted_at": min(times, default=None)}


def read_output(spark: SparkSession, path: str) -> DataFrame:
    """Lines of batch output: of a file, of the .jsonl (else .json) files of a folder, else of those in its child folders."""
    root, files = Path(path), []
    if root.is_dir():
        own = lambda d: sorted(d.glob("*.jsonl")) or sorted(d.glob("*.json"))
        files = own(root) or [f for d in sorted(x for x in root.iterdir() if x.is_dir()) for f in own(d)]
    else:
        files = [root]
    if not files:
        return spark.createDataFrame([], "line string")
    return spark.read.text([str(f) for f in files]).where("trim(value) <> ''").withColumnRenamed("value", "line")


def collect(lines: DataFrame, manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Results (custom_id, doc_id, source_path, title, input_sha256, raw_response and the parsed reply) and failures (doc_id, source_path, error, line).

    A line that isn't JSON, whose custom_id the manifest doesn't know, that carries an error or has no answer is a
    failure, and so is a manifest entry without a line.
    """
    answer = "struct<body: struct<choices: array<struct<message: struct<content: string>>>>>"
    v = F.from_json("line", f"custom_id string, response {answer}, error string, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    rows = lines.select("line", v.alias("v")).select("line", "v.*")
    both = collect_batch(rows.where("_bad is null and custom_id is not null"), manifest)
    first = F.try_element_at(F.col("response.body.choices"), F.lit(1))
    failed = F.col("error").isNotNull() | F.col("response.body").isNull() | first.isNull()
    why = F.when(F.col("status") == "unknown_id", F.concat(F.lit("custom_id not in manifest: "), F.col("custom_id"))).when(F.col("status") == "missing_output", F.lit("no batch output row found for custom_id")).otherwise(F.coalesce("error", "line"))
    good = both.where((F.col("status") == "ok") & ~failed)
    text = F.coalesce(first["message"]["content"], F.lit(""))
    results = good.select("custom_id", "doc_id", "source_path", "title", "input_sha256", text.alias("raw_response"), parse_reply(text).alias("p")).select("*", "p.*").drop("p")
    failures = both.where((F.col("status") != "ok") | failed).select("doc_id", "source_path", why.alias("error"), "line")
    broken = rows.where("_bad is not null or custom_id is null").select(F.lit(None).cast("string").alias("doc_id"), F.lit(None).cast("string").alias("source_path"), F.lit("no custom_id or no JSON").alias("error"), "line")
    return results, failures.unionByName(broken)


def slug(value: Column | str, default: str = "run", most: int = 64) -> Column:
    """A name for files: other characters than letters, digits, dot, underscore and dash become dashes."""
    value = F.lit(value) if isinstance(value, str) else value
    # what can become the first characters of the name; the rest of a long text isn't looked at
    head = F.regexp_extract(value, rf"^[^A-Za-z0-9]*+((?:[A-Za-z0-9._-]|[^A-Za-z0-9._-]++){{0,{most}}}+)", 1)
    s = F.regexp_replace(F.regexp_replace(head, r"[^A-Za-z0-9._-]+", "-"), r"[._-]+$", "")
    return F.when(s != "", s).otherwise(F.lit(default[:most].strip("._-") or default))


def duration(seconds: Column) -> Column:
    """[days d] HH:MM:SS."""
    s = seconds.cast("long")
    clock = F.format_string("%02d:%02d:%02d", F.floor(F.pmod(s, F.lit(86400)) / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60), F.pmod(s, F.lit(60)))
    days = F.floor(s / 86400)
    return F.when(days > 0, F.concat(days.cast("string"), F.lit("d "), clock)).otherwise(clock)


def checkpoint_time(value: object) -> datetime | None:
    """A time of a checkpoint file in UTC; without a zone it is UTC; anything else is None."""
    try:
        found = datetime.fromisoformat(str(value).strip())
    except ValueError:
        return None
    return found.replace(tzinfo=found.tzinfo or UTC).astimezone(UTC)


def run_folder(base: str, source: str, model: str, jobs: int, prompt_sha256: str, now: datetime | None = None) -> str:
    """A new run's folder: time, source, model, number of documents and the prompt's digest."""
    def name(x: str, most: int, default: str) -> str:
        cut = re.sub(r"[^A-Za-z0-9._-]+", "-", x).strip("._-") or default
        return cut[:most].strip("._-") or default

    stamp = (now or datetime.now(UTC)).strftime("%Y%m%d_%H%M%S")
    return f"{base.rstrip('/')}/{stamp}_{name(Path(source).name, 32, 'source')}_{name(model.replace('/', '-'), 48, 'model')}_{jobs}docs_{prompt_sha256[:8]}"
