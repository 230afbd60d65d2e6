"""Deterministic sharded WARC writer and its reader (operator 6).

Records are range-sorted by url, page_id and payload digest into shards of about equal bytes, whose bounds depend on the
rows alone; a shard rolls to a new file when the compressed bytes reach a limit. Headers, record ids and digests are
regenerated from the payload, gzip members carry no time, so equal rows give equal archives. Tasks write under temporary
names; tasks of a second job rename the files of the attempts that Spark committed, and then the manifest is written as a
table, whose _SUCCESS file makes the archive complete.

Scale: a first pass leaves key, digest and size of each row; record types, shard count and bounds come from that table.
Payloads are shuffled once, by shard. Shards number at most ``SHARDS``; beyond that they grow and roll more often, so the
driver never holds more than the sampled keys. Neither file names nor manifest rows are collected.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm._shared import forget, saved, shared_dir, split_join

LEAST_REVISIT, ROLL_BYTES, SHARD_BYTES, DATE = 1000, 64 << 20, 8 << 20, "2024-01-01T00:00:00Z"
#: Shards at most, and keys for each that are looked at to set the bounds, whichever hash lowest.
SHARDS, KEYS_A_SHARD = 10_000, 20
#: Bytes of a record's headers, for the size of a shard.
HEAD_BYTES = 300
MANIFEST = "manifest.json"
_MANIFEST = "file string, records bigint, bytes bigint, first string, last string"
_FILES = f"{_MANIFEST}, temporary string"


def filesystem(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The store of a URI and the path in it; a plain path is local."""
    if uri.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(uri) if "://" in uri else (pyarrow.fs.LocalFileSystem(), uri)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One gzip member. A revisit has the headers of its payload but no body."""
    digest = hashlib.sha1(payload)
    b32 = base64.b32encode(digest.digest()).decode()
    clean = (url or "").encode("utf-8", "surrogatepass")
    clean = b"".join(b"%%%02X" % c if c < 33 or c > 126 else bytes([c]) for c in clean)

    def name(page: int | None, what: str) -> bytes:
        return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{what}:{page}')}>".encode()

    kind = b"response" if refers_to is None else b"revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body = http + payload if refers_to is None else http
    head = [b"WARC/1.1", b"WARC-Type: " + kind, b"WARC-Record-ID: " + name(page_id, b32 if page_id is None else "page"), b"WARC-Date: " + DATE.encode()]
    head += [b"WARC-Target-URI: " + clean] if clean else []
    head += [b"WARC-Payload-Digest: sha1:" + b32.encode(), b"WARC-Block-Digest: sha1:" + base64.b32encode(hashlib.sha1(body).digest())]
    if refers_to is not None:
        head += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", b"WARC-Refers-To: " + name(refers_to, "page"), b"X-Refers-To-Page: %d" % refers_to]
    head += [] if page_id is None else [b"X-Page: %d" % page_id]
    head += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(body)]
    squeeze = zlib.compressobj(4, zlib.DEFLATED, 31)
    return squeeze.compress(b"\r\n".join(head) + b"\r\n\r\n" + body + b"\r\n\r\n") + squeeze.flush()


def _shard_key(url: str, page: str, digest: str):
    # a zero byte keeps urls that begin alike apart; the number is padded so that text order is number order
    return F.concat(F.coalesce(F.col(url), F.lit("")), F.lit("\x00"), F.coalesce(F.lpad((F.col(page).cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")).cast("string"), 20, "0"), F.lit("")), F.lit("\x00"), F.col(digest))


def plan(rows: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """page_id, digest and refers_to of the rows (page_id, digest, size) that become revisits; repeated ones once."""
    large = rows.where((F.col("size") >= least) & F.col("page_id").isNotNull())
    keep = large.groupBy("digest", "size").agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    found = split_join(large.select("page_id", "digest", "size"), keep, ["digest", "size"]).where("page_id <> response")
    return found.select("page_id", "digest", F.col("response").alias("refers_to")).distinct()


def bounds(light: DataFrame, shard_bytes: int) -> list[str]:
    """Keys that begin the second and later shards: cuts of the bytes of keys picked by hash into equal parts."""
    weight = F.col("size") + HEAD_BYTES
    n, total = light.agg(F.count(F.lit(1)), F.coalesce(F.sum(weight), F.lit(0))).first()
    shards = max(1, min(SHARDS, -(-total // shard_bytes)))
    share = min(1.0, KEYS_A_SHARD * shards / max(1, n))
    picked = light if share == 1.0 else light.where(F.xxhash64("key") <= int(share * 2**64 - 2**63))
    got = picked.groupBy("key").agg(F.sum(weight).alias("w")).toArrow()  # about KEYS_A_SHARD keys a shard, each once
    keys, w = got.column("key").to_pylist(), got.column("w").to_numpy()
    order = sorted(range(len(keys)), key=keys.__getitem__)
    upto = np.cumsum(w[order])
    cuts = np.unique(np.searchsorted(upto, upto[-1] * np.arange(1, shards) / shards)) if len(keys) else []
    return [keys[order[i]] for i in cuts if i > 0]


def write(pages: DataFrame, target: str, roll_bytes: int = ROLL_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) under the folder ``target``; returns the manifest's rows.

    Of records with equal payloads of at least 1000 bytes the one with the largest page_id is the response, the others
    revisit it; smaller ones are all responses, as are rows whose page_id is null. A null html is an empty payload, a
    null url a record without target. Rows that repeat a page_id with equal payloads are all responses. An empty table
    gives an archive of no files. ``target`` must not hold an archive yet. Other columns are not written.
    """
    spark = pages.sparkSession
    fs, root = filesystem(target)
    fs.create_dir(root, recursive=True)
    if fs.get_file_info(f"{root}/{MANIFEST}").type != pyarrow.fs.FileType.NotFound:
        raise FileExistsError(f"{target} holds an archive")
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", "html").withColumn("digest", F.sha1(payload)).withColumn("key", _shard_key("url", "page_id", "digest"))
    light = saved(rows.select("key", "page_id", "digest", F.octet_length(F.coalesce("html", F.lit(""))).cast("long").alias("size")), "digests")
    types = saved(plan(light), "revisits")
    sent = spark.sparkContext.broadcast(bounds(light, shard_bytes))
    shards = len(sent.value) + 1

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = np.array([b.encode() for b in sent.value], object)
        for batch in batches:
            k = np.array([x.encode("utf-8", "surrogatepass") for x in batch.column(batch.schema.get_field_index("key")).to_pylist()], object)
            yield batch.append_column("shard", pa.array(np.searchsorted(cut, k, "right") if len(cut) else np.zeros(len(k), np.int64), pa.int32()))

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    dealt = rows.mapInArrow(deal, ", ".join([*(f"`{k}` {v}" for k, v in kinds.items()), "shard int"]))
    if (n := types.count()) <= 500_000:  # 60 bytes a row
        types = F.broadcast(types)
    named = dealt.join(types, ["page_id", "digest"], "left") if n else dealt.withColumn("refers_to", F.lit(None).cast("long"))
    ready = named.select("shard", "key", "digest", "page_id", "url", "html", F.col("refers_to").cast("long").alias("refers_to")).repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "key")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = filesystem(target)
        now = None

        def close() -> pa.RecordBatch:
            now["out"].close()
            return pa.RecordBatch.from_pylist([{k: now[k] for k in ("file", "records", "bytes", "first", "last", "temporary")}], schema=pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("temporary", pa.string())]))

        for batch in batches:
            for i in range(batch.num_rows):
                shard, key, _, page, url, html, refers = (c[i].as_py() for c in batch.columns)
                if now is None or now["shard"] != shard or now["bytes"] >= roll_bytes:
                    part = now["part"] + 1 if now and now["shard"] == shard else 0
                    if now:
                        yield close()
                    temporary = f"{place}/_temporary-{uuid.uuid4().hex}"
                    now = {"shard": shard, "part": part, "file": f"shard-{shard:06d}-{part:04d}.warc.gz", "records": 0, "bytes": 0, "first": key, "temporary": temporary, "out": store.open_output_stream(temporary, compression=None)}
                data = record(page, url, (html or "").encode("utf-8", "surrogatepass"), refers)
                now["out"].write(data)
                now["records"] += 1
                now["bytes"] += len(data)
                now["last"] = key
        if now:
            yield close()

    files = saved(ready.mapInArrow(emit, _FILES), "warc-files")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = filesystem(target)
        for batch in batches:
            for name, temporary in zip(batch.column("file").to_pylist(), batch.column("temporary").to_pylist(), strict=True):
                final = f"{folder}/{name}"
                if store.get_file_info(temporary).type != pyarrow.fs.FileType.NotFound:
                    store.move(temporary, final)
                elif store.get_file_info(final).type == pyarrow.fs.FileType.NotFound:  # an earlier attempt has moved it
                    raise FileNotFoundError(temporary)
            yield batch.select([f for f in batch.schema.names if f != "temporary"])

    files.mapInArrow(place, _MANIFEST).write.json(f"{target.rstrip('/')}/{MANIFEST}")
    for info in fs.get_file_info(pyarrow.fs.FileSelector(root)):  # of attempts that weren't committed
        if info.base_name.startswith("_temporary-"):
            fs.delete_file(info.path)
    forget(light, types)
    return manifest(spark, target)


def manifest(spark: SparkSession, target: str) -> DataFrame:
    """The files of an archive: file, records, bytes, first and last key. An archive that isn't complete is an error."""
    fs, root = filesystem(target)
    if fs.get_file_info(f"{root}/{MANIFEST}/_SUCCESS").type == pyarrow.fs.FileType.NotFound:
        raise FileNotFoundError(f"{target} holds no complete archive")
    return spark.read.schema(_MANIFEST).json(f"{target.rstrip('/')}/{MANIFEST}")


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a gzip WARC file; one record in memory at a time."""
    inflate, plain = zlib.decompressobj(31), bytearray()
    more = stream.read(1 << 20)
    while more:
        plain += inflate.decompress(more)
        more = inflate.unused_data if inflate.eof else b""
        if inflate.eof:  # a member is a record
            head, _, rest = bytes(plain).partition(b"\r\n\r\n")
            fields = dict(x.decode("latin-1").split(": ", 1) for x in head.split(b"\r\n")[1:])
            block = rest[: int(fields["Content-Length"])]
            if base64.b32encode(hashlib.sha1(block).digest()).decode() != fields["WARC-Block-Digest"].removeprefix("sha1:"):
                raise ValueError(f"the block of {fields['WARC-Record-ID']} differs from its digest")
            yield fields, block
            inflate, plain = zlib.decompressobj(31), bytearray()
        more = more or stream.read(1 << 20)


_READ = "page_id bigint, url string, record_type string, payload_digest string, payload_bytes bigint, refers_to bigint, html string"


def read(spark, target: str) -> DataFrame:
    """The records of an archive: page_id, url, record_type, payload_digest (hex), payload_bytes, refers_to, html.

    For a revisit, payload_bytes is that of the payload it stands for, and html is null. Block digests are checked.
    """
    files = manifest(spark, target).select("file")

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = filesystem(target)
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("html", pa.string())])
        for batch in batches:
            for name in batch.column(0).to_pylist():
                out, size = [], 0
                with store.open_input_stream(f"{place}/{name}", compression=None) as f:
                    for h, block in records(f):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        length = int(dict(x.split(b": ", 1) for x in http.split(b"\r\n")[1:])[b"Content-Length"])
                        revisit = h["WARC-Type"] == "revisit"
                        number = {k: int(h[x]) if x in h else None for k, x in (("page_id", "X-Page"), ("refers_to", "X-Refers-To-Page"))}
                        out.append(number | {"url": h.get("WARC-Target-URI"), "record_type": h["WARC-Type"], "payload_digest": base64.b32decode(h["WARC-Payload-Digest"].removeprefix("sha1:")).hex(), "payload_bytes": length, "html": None if revisit else payload.decode("utf-8", "surrogatepass")})
                        size += len(block)
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(out, schema=schema)
                            out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)

    return files.repartition(max(1, min(files.count(), 10_000))).mapInArrow(load, _READ)


def place(spark) -> str:
    """A new folder for an archive in the shared folder."""
    return f"{shared_dir(spark)}/quarry/warc-{uuid.uuid4().hex}"
