"""Services, committed runs, chunk files and samples: what is asked, written and seen when things break."""

import asyncio
import json
import random
import sys
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quarry.operators import batches, judge, sampling, workflow
from quarry.operators.requests import Clock, Ledger, Sender, send_all
from quarry.sources import commits, cursor, discovery, files


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks can't import tests


class Pages:
    """A paging service over made-up rows; notes each request in a folder and fails where it is told to."""

    def __init__(self, log, fail=()):
        self.log, self.fail = log, set(fail)

    def __call__(self, query, at, rows, fields):
        start = 0 if at == cursor.START else int(at)
        files.put(f"{self.log}/{query}-{start:04d}-{time.time_ns()}", b"")
        if (query, start) in self.fail:
            raise ConnectionError("gone")
        first, last = map(int, query.split("-"))
        ids = range(first + start, min(first + start + rows, last))
        return [{c: f"{c}{i}" for c in fields if c != "none"} for i in ids], str(start + len(ids))


def asked(log):
    return sorted(n.rsplit("-", 1)[0] for n in files.names(str(log)))


def test_cursor_reads_all_pages_by_format_name(spark, tmp_path):
    cursor.register(spark, "plain_pages", Pages(str(tmp_path / "log")), ["0-25", "20-40", "7-7"], "id string, none string", rows=10)
    got = spark.read.format("plain_pages").load()
    assert got.rdd.getNumPartitions() == 3
    rows = got.collect()
    assert sorted(r.id for r in rows) == sorted([f"id{i}" for i in range(25)] + [f"id{i}" for i in range(20, 40)]) and {r.none for r in rows} == {None}
    with pytest.raises(Exception, match="ledger"):
        spark.readStream.format("plain_pages").load().writeStream.format("noop").option("checkpointLocation", str(tmp_path / "x")).start().processAllAvailable()


def test_cursor_stream_goes_on_where_it_broke_off(spark, tmp_path):
    log, target, checkpoint = str(tmp_path / "log"), str(tmp_path / "out"), str(tmp_path / "cp")
    own = {"rows": 10, "flush": 2, "attempts": 1, "ledger": str(tmp_path / "ledger")}
    queries = ["0-75", "60-90", "5-5"]  # the second finds some rows of the first again
    cursor.register(spark, "broken_pages", Pages(log, {("0-75", 50)}), queries, "id string", **own)
    with pytest.raises(Exception, match="gone"):
        cursor.collect(spark, "broken_pages", target, checkpoint, "id")
    first = asked(log)
    assert "0-75-0050" in first and "0-75-0060" not in first
    cursor.register(spark, "broken_pages", Pages(log), queries, "id string", **own)
    got = cursor.collect(spark, "broken_pages", target, checkpoint, "id")
    assert sorted(r.id for r in got.collect()) == sorted(f"id{i}" for i in range(90))
    again = [x for x in asked(log) if asked(log).count(x) > 1]
    assert set(again) <= {"0-75-0040", "0-75-0050"}  # only the epoch that broke off is read again
    n = len(asked(log))
    assert cursor.collect(spark, "broken_pages", target, checkpoint, "id").count() == 90 and len(asked(log)) == n
    assert len(files.names(own["ledger"])) <= 2  # epochs that are done with are deleted


def test_cursor_epoch_run_again_reads_the_same(tmp_path):
    own = cursor.Settings(Pages(str(tmp_path / "log")), ["0-50"], ["id"], rows=10, flush=2, ledger=str(tmp_path / "ledger"))
    reader = cursor._Epochs(own)
    assert reader.initialOffset() == {"epoch": 0} and reader.latestOffset() == {"epoch": 1} and reader.partitions({"epoch": 1}, {"epoch": 1}) == []
    (part,) = reader.partitions({"epoch": 0}, {"epoch": 1})
    first = list(reader.read(part))
    own.flush = 4  # another attempt still ends where the first one did
    assert list(reader.read(part)) == first == [(f"id{i}",) for i in range(20)] and reader.latestOffset() == {"epoch": 2}
    (rest,) = reader.partitions({"epoch": 1}, {"epoch": 2})
    assert [x for x, in reader.read(rest)] == [f"id{i}" for i in range(20, 50)] and reader.latestOffset() == {"epoch": 2}
    reader.commit({"epoch": 2})
    assert files.names(own.ledger) == ["00000002"]


def test_cursor_page_is_asked_for_again(tmp_path):
    waits, calls = [], []

    def client(query, at, rows, fields):
        calls.append(at)
        if len(calls) < 3:
            raise ConnectionError
        return [], at

    own = cursor.Settings(client, ["q"], ["id"], attempts=3, pause=waits.append)
    assert own.page("q", "*") == ([], "*") and waits == [5.0, 10.0]
    calls.clear()
    own.attempts = 2
    with pytest.raises(ConnectionError):
        own.page("q", "*")


class FakeClock(Clock):
    """Sleeping takes no time; the clock of the loop's callers goes on by what they sleep."""

    def __init__(self):
        self.at, self.waiting = 0.0, []

    def now(self):
        return self.at

    async def sleep(self, seconds):
        until = self.at + seconds
        await asyncio.sleep(0)
        self.at = max(self.at, until)


def test_sender_keeps_order_rate_and_window():
    clock, sent, open_now, most = FakeClock(), [], [0], [0]

    async def client(prompt):
        sent.append(clock.now())
        open_now[0] += 1
        most[0] = max(most[0], open_now[0])
        for _ in range(random.Random(prompt).randrange(5)):
            await asyncio.sleep(0)
        open_now[0] -= 1
        return prompt.upper()

    jobs = [(f"k{i}", f"p{i}") for i in range(40)]
    got = list(Sender(client, window=3, rate=2.0, clock=clock).run(jobs))
    assert got == [(k, p.upper(), None) for k, p in jobs] and most[0] <= 3
    assert all(b - a >= 0.5 - 1e-9 for a, b in zip(sent, sent[1:], strict=False)) and sent[-1] <= 39 * 0.5 + 1e-6


def test_sender_tries_again_and_tells_errors():
    class Answer(Exception):
        def __init__(self, status):
            super().__init__(f"status {status}")
            self.status_code = status

    calls = {}

    def client(prompt):
        calls[prompt] = calls.get(prompt, 0) + 1
        if prompt == "never" or (prompt == "late" and calls[prompt] < 3):
            raise Answer(503)
        if prompt == "refused":
            raise Answer(400)
        return None if prompt == "unknown" else prompt

    clock = FakeClock()
    got = list(Sender(client, window=2, retries=2, clock=clock).run([(p, p) for p in ("late", "never", "refused", "unknown", "fine")]))
    assert got == [("late", "late", None), ("never", None, "status 503"), ("refused", None, "status 400"), ("unknown", None, None), ("fine", "fine", None)]
    assert calls == {"late": 3, "never": 3, "refused": 1, "unknown": 1, "fine": 1} and clock.at >= 3


@pytest.mark.parametrize("each", [1, 3])
def test_lost_task_sends_nothing_twice(spark, tmp_path, each):
    log, ledger = str(tmp_path / "log"), str(tmp_path / "ledger")
    jobs = spark.createDataFrame([(f"k{i}", f"p{i}") for i in range(30)] + [("k1", "z"), (None, "p"), ("n", None)], "key string, prompt string")

    def client(prompt, fail=True):
        files.put(f"{log}/{prompt}-{time.time_ns()}", b"")
        if fail and prompt == "p17":
            raise SystemExit("the executor is lost")  # not an error of the request: it ends the task
        return prompt[1:]

    with pytest.raises(Exception, match="lost"):
        send_all(jobs, client, ledger, window=1, tasks=2, each=each).collect()
    before = asked(log)
    got = send_all(jobs, lambda p: client(p, False), ledger, window=1, tasks=2, each=each)
    assert {r.key: r.reply for r in got.collect()} == {f"k{i}": str(i) for i in range(30)}
    twice = {x for x in asked(log) if asked(log).count(x) > 1}
    assert len(before) > 2 and "p17" in twice and len(twice) <= 2 * each
    n = len(asked(log))
    assert got.count() == 30 and len(asked(log)) == n  # another action asks for nothing


def test_ledger_forgets_errors(tmp_path):
    own = Ledger(str(tmp_path / "b"), 2)
    assert own.read() == {}
    own.add("a", "1", None)
    own.add("b", None, "failed")
    own.add("c", None, None)
    assert Ledger(own.folder, 1).read() == {"a": ("1", None), "c": (None, None)}


def test_fetch_by_id(spark, tmp_path):
    def client(x):
        if x == "bad":
            error = ValueError("no such form")
            error.status_code = 404
            raise error
        return {"x": "found"}.get(x)

    ids = spark.createDataFrame([("x",), (" y ",), ("x",), ("bad",), ("",), (None,)], "doc_id string")
    good, failed = discovery.fetched(ids, client, ledger=str(tmp_path / "l"), tasks=2)
    assert [tuple(r) for r in good.collect()] == [("x", "found")] and [tuple(r) for r in failed.collect()] == [("bad", "no such form")]


def greedy(sizes, most):
    out, chunk, used = [], 0, 0
    for n in sizes:
        if used and used + n > most:
            chunk, used = chunk + 1, 0
        out.append(chunk)
        used += n
    return out


@pytest.mark.parametrize("fan", [2, 3, 32])
def test_chunk_maps_compose(spark, fan):
    rng = random.Random(fan)
    rows = [(g, i, rng.choice([1, 2, 3, 7, 19, 20, 25])) for g, n in (("a", 400), (None, 60), ("b", 1), ("c", 90)) for i in range(n)]
    rows += [("d", i, 1) for i in range(300)]  # many runs go into one chunk as a whole
    lines = spark.createDataFrame(rows, "g string, i int, n int")
    got = judge.pack_chunks(lines, "n", "g", "i", 40, part_bytes=60, fan=fan).collect()
    assert len(got) == len(rows)
    for g in {r[0] for r in rows}:
        own = sorted((r.i, r.n, r.chunk) for r in got if r.g == g)
        assert [c for _, _, c in own] == greedy([n for _, n, _ in own], 40)


def test_composed_maps_are_runs_of_both():
    rng = random.Random(1)
    for _ in range(300):
        most, a, b = rng.randrange(5, 40), [rng.randrange(1, 25) for _ in range(rng.randrange(1, 12))], [rng.randrange(1, 25) for _ in range(rng.randrange(1, 12))]
        maps = [judge._Packing(judge.np.array(x), most).summary() for x in (a, b, a + b)]
        both = judge._composed(maps[0], maps[1], most)
        assert len(both) <= len(a) + len(b) + 1
        for used in range(0, most + 10):
            assert judge._after(both, 3, used, most) == judge._after(maps[2], 3, used, most)


def test_more_than_a_thousand_chunks(spark, tmp_path):
    folder = str(tmp_path / "run")
    lines = spark.range(1001).select(F.format_string("k%04d", "id").alias("custom_id"), F.concat(F.lit('{"n": '), "id", F.lit("}")).alias("line"), F.col("id").cast("int").alias("chunk"))
    made = batches.write_chunks(lines, folder)
    assert [c["index"] for c in made] == list(range(1001)) and made[1000]["path"].endswith("batch_requests_1000.jsonl")
    assert batches.found_chunks(folder) == made
    (tmp_path / "run" / "batch_chunks.json").unlink()
    (tmp_path / "run" / "batch_requests_12.jsonl").write_text("not a chunk")
    assert batches.found_chunks(folder) == made
    assert spark.read.text([c["path"] for c in made]).count() == 1001
    assert batches.write_chunks(lines.limit(0), str(tmp_path / "none")) == [] and batches.found_chunks(str(tmp_path / "none")) == []


BODY = "The study of the rivers and of the lakes was done for the first time in this region by us."


def shard(tmp_path, ids):
    ann = {"paragraph": json.dumps([{"start": 8, "end": 8 + len(BODY)}]), "section_header": json.dumps([{"start": 0, "end": 7}])}
    src = tmp_path / "in"
    src.mkdir(exist_ok=True)
    (src / f"{ids[0]}.json").write_text("".join(json.dumps({"corpusid": i, "title": f"T{i}", "body": {"text": f"Methods\n{BODY}", "annotations": ann}}) + "\n" for i in ids) + "broken\n")
    return str(src)


@pytest.mark.parametrize("where", ["documents", "report", "failures", "commit"])
def test_run_that_breaks_off_is_replayed(spark, tmp_path, where):
    src, out = shard(tmp_path, [1, 2, 3]), str(tmp_path / "out")
    workflow.section_dataset(spark, src, out)
    shard(tmp_path, [4, 5])

    def crash(part):
        if part == where:
            raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        workflow.section_dataset(spark, src, out, after=crash)
    seen = 5 if where == "commit" else 3  # all parts of a run are seen, or none
    assert workflow.written(spark, out).count() == workflow.reports(spark, out).count() == seen
    last = workflow.section_dataset(spark, src, out)
    assert sorted(r.corpusid for r in workflow.written(spark, out).collect()) == list("12345")
    assert sorted(r.corpusid for r in workflow.reports(spark, out).collect()) == list("12345")
    assert last["totals"]["previously_written"] == seen and workflow.summary(spark, out) == last
    assert json.loads((tmp_path / "out" / "sectionization_report.json").read_text()) == last
    assert commits.sweep(spark, out) == (where != "commit") and commits.sweep(spark, out) == 0
    assert workflow.written(spark, out).count() == 5 and workflow.failed(spark, out).count() >= 3


def test_summary_file_follows_the_last_commit(spark, tmp_path):
    src, out = shard(tmp_path, [1]), str(tmp_path / "out")
    with pytest.raises(KeyboardInterrupt):
        workflow.section_dataset(spark, src, out, after=lambda part: (_ for _ in ()).throw(KeyboardInterrupt()) if part == "commit" else None)
    assert not (tmp_path / "out" / "sectionization_report.json").exists() and workflow.written(spark, out).count() == 1
    workflow._show_summary(spark, out)
    assert json.loads((tmp_path / "out" / "sectionization_report.json").read_text()) == workflow.summary(spark, out)


def test_run_on_another_file_system(spark, tmp_path):
    src = shard(tmp_path, [1, 2])
    (tmp_path / "store").mkdir()
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.kept.link./data", f"file://{tmp_path}/store")
    got = workflow.section_dataset(spark, src, "viewfs://kept/data/out/")
    assert workflow.written(spark, "viewfs://kept/data/out").count() == 2
    assert json.loads((tmp_path / "store" / "out" / "sectionization_report.json").read_text()) == got


def test_two_runs_at_once(spark, tmp_path):
    out = str(tmp_path / "out")
    one, two = commits.Run(spark, out), commits.Run(spark, out)
    spark.range(3).write.json(one.place("rows"))
    spark.range(5).write.json(two.place("rows"))
    assert commits.committed(spark, out) == [] and commits.read_json(spark, out, "rows", "id long").count() == 0
    one.commit({"n": 1})
    with pytest.raises(commits.Conflict):
        two.commit({"n": 2})
    assert commits.read_json(spark, out, "rows", "id long").count() == 3 and commits.sweep(spark, out) == 1
    commits.Run(spark, out).commit({})
    assert [m["number"] for m in commits.committed(spark, out)] == [1, 2] and commits.read_json(spark, out, "rows", "id long").count() == 3


@pytest.mark.parametrize("most_ids", [100_000, 1])
def test_stratified_sample(spark, monkeypatch, most_ids):
    import hashlib

    monkeypatch.setattr(sampling, "MOST_IDS", most_ids)
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "a", "a", "b", "", None, "=x"]), f"text {i}") for i in range(700)] + [(5, "twice", "one"), (5, "twice", "two"), (None, "none", "t")]
    docs = spark.createDataFrame(rows, "id int, source string, text string").repartition(7)
    docs = docs.withColumnRenamed("id", "doc_id")
    got = sampling.stratified(docs, "source", "doc_id", 10, 7)
    want = {}
    for s in {r[1] for r in rows}:
        own = sorted((hashlib.md5(f"7:{i}".encode() if i is not None else b"7").hexdigest(), i) for i, x, _ in rows if x == s)
        want[s] = ([i for _, i in own[:10]], len(own))
    found = {s: ([r.id for r in sorted((r for r in got.collect() if r.stratum == s), key=lambda r: r.rank)], {r.seen for r in got.collect() if r.stratum == s}) for s in want}
    assert found == {s: (ids, {n}) for s, (ids, n) in want.items()}
    texts = sampling.rows_of(docs, got, "doc_id").where("stratum = 'twice'").collect()
    assert sorted((r.text, r.rank) for r in texts if r.source == "twice") == [("one", 1), ("one", 2), ("two", 1), ("two", 2)]
    assert sampling.stratified(docs.limit(0), "source", "doc_id", 3, 1).collect() == []
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # a task has many batches
    try:
        assert sorted(map(str, sampling.stratified(docs, "source", "doc_id", 10, 7).collect())) == sorted(map(str, got.collect()))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


@pytest.mark.parametrize("range_bytes", [64 << 20, 3000])
def test_gzip_by_members(spark, tmp_path, range_bytes):
    import gzip

    from quarry.sources import members

    rng = random.Random(8)
    lines = [f'{{"corpusid": {i}, "title": "{"x" * rng.randrange(90)}"}}' if i % 7 else "" for i in range(4000)]
    data = "\n".join(lines).encode()
    cuts = sorted(rng.randrange(len(data)) for _ in range(999))
    own = tmp_path / "a.gz"
    own.write_bytes(b"".join(gzip.compress(data[a:b]) for a, b in zip([0, *cuts], [*cuts, len(data)], strict=True)))
    (tmp_path / "b.gz").write_bytes(gzip.compress(b"one\ntwo\n\nlast"))  # a single member of few bytes
    inner = b"".join(gzip.compress(b"%d\n" % i) for i in range(600))  # members within a member, stored as they are
    (tmp_path / "c.gz").write_bytes(gzip.compress(inner + b"\n", 0))
    (tmp_path / "d.gz").write_bytes(b"")
    paths = [str(tmp_path / f"{x}.gz") for x in "abcd"]
    got = members.gzip_lines(spark, paths, range_bytes).collect()
    assert sorted((r.line_number, r.value) for r in got if r.path == paths[0]) == [(i + 1, x) for i, x in enumerate(lines) if x]
    assert sorted((r.line_number, r.value) for r in got if r.path == paths[1]) == [(1, "one"), (2, "two"), (4, "last")]
    want = [(i + 1, x.decode("utf-8", "replace")) for i, x in enumerate((inner + b"\n").split(b"\n"))]
    assert sorted((r.line_number, r.value) for r in got if r.path == paths[2]) == [x for x in want if x[1].strip(" ")]
    own.write_bytes(own.read_bytes()[:-9])
    with pytest.raises(Exception, match="within a member"):
        members.gzip_lines(spark, paths[:1], range_bytes).collect()


def test_bucketed_tables_move_no_text(spark, tmp_path):
    from quarry.operators import sections
    from quarry.sources import bucketed

    docs = spark.createDataFrame([(i, f"Methods of it\n{BODY} {i}\nshort\n{BODY}") for i in range(40)], "doc_id int, text string")
    raw = sections.from_lines(docs)
    names = [f"bucketed_{x}_{time.time_ns()}" for x in ("raw", "written", "other")]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        table = bucketed.save(raw, names[0], 4, path=str(tmp_path / "raw"))
        bucketed.save(sections.sectionize(table), names[1], 4, path=str(tmp_path / "written"))
        rows = bucketed.audit(spark, *names[:2])
        assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
        want = sections.audit(raw, sections.sectionize(raw))
        assert sorted(map(str, rows.collect())) == sorted(map(str, want.collect()))
        assert bucketed.verify(spark, *names[:2]) == sections.verify(raw, sections.sectionize(raw))
        found, missing = bucketed.lookup(spark, names[0], spark.createDataFrame([(1,), (1,), (7,), (99,), (None,)], "corpusid int"))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "SortMergeJoin" in plan  # that of the ids
        assert sorted(r.corpusid for r in found.collect()) == ["1", "7"] and [r.corpusid for r in missing.collect()] == ["99"]
        bucketed.save(raw, names[2], 8, path=str(tmp_path / "other"))
        with pytest.raises(ValueError, match="same number"):
            bucketed.audit(spark, names[0], names[2])
        docs.write.option("path", str(tmp_path / "plain")).saveAsTable(f"{names[2]}_plain")
        with pytest.raises(ValueError, match="bucketed"):
            bucketed.buckets_of(spark, f"{names[2]}_plain")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for n in (*names, f"{names[2]}_plain"):
            spark.sql(f"DROP TABLE IF EXISTS {n}")


def test_cursor_batches_grow_with_what_has_been_read(tmp_path):
    own = cursor.Settings(Pages(str(tmp_path / "log")), ["0-4000"], ["id"], rows=10, flush=2, ledger=str(tmp_path / "ledger"))
    reader, got, at, ends = cursor._Epochs(own), [], {"epoch": 0}, []
    while (after := reader.latestOffset()) != at:
        got += [x for p in reader.partitions(at, after) for x, in reader.read(p)]
        reader.commit(at)
        at = after
        ends.append(at["epoch"])
    assert got == [f"id{i}" for i in range(4000)] and ends[:9] == [1, 2, 3, 4, 5, 6, 7, 8, 10] and len(ends) < 25  # 200 epochs


def test_short_members_are_read_once(tmp_path):
    import gzip

    from quarry.sources import members

    lines = [random.Random(i).randbytes(300).hex() for i in range(4000)]
    data = "\n".join(lines).encode()
    path = str(tmp_path / "a.gz")
    files.put(path, b"".join(gzip.compress(data[k : k + 2000]) for k in range(0, len(data), 2000)))
    shard, taken = members.Shard(path), 0

    class Counting:
        def __init__(self, inner):
            self.inner, self.seek = inner, inner.seek

        def read(self, n):
            nonlocal taken
            block = self.inner.read(n)
            taken += len(block)
            return block

    shard.file = Counting(shard.file)
    got = [x[1].decode() for x in members._lines(shard, 0, shard.size) if x[0] is not None]
    assert got == lines and taken < 2 * shard.size


def test_slug_looks_at_the_beginning_alone(spark):
    import re

    texts = ["", None, "...", "a b", " -a.b_c- ", "x" * 70, "x" * 63 + "  \n y", "x" * 62 + " \u00e9 - z", "\u00e9\U0001d7d9" * 40 + "ok" + "\u00e9" * 100 + "z", "a" + "-" * 100 + "b", "a. b" * 40, "a" + " " * 200_000]

    def whole(t):
        s = re.sub(r"[^A-Za-z0-9._-]+", "-", t or "").strip("._-") or "run"
        return s[:64].strip("._-") or "run"

    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", batches.slug(F.col("t")).alias("s"))
    assert {r.i: r.s for r in rows.collect()} == {i: whole(t) for i, t in enumerate(texts)}
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(t#") == 0
