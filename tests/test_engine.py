"""Operators of the document engine on small inputs with known answers."""

import re

import pytest
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import convert, judge, references, search, sections
from quarry.operators.requests import send_all
from quarry.plans import keyword


@pytest.mark.parametrize(
    ("query", "strict", "tree"),
    [
        ('(a OR "b c") AND NOT d', True, ("and", [("or", [("term", "a"), ("term", "b c")]), ("not", ("term", "d"))])),
        ("a NOT b", True, ("term", "a")),
        ("a -b", False, ("and", [("term", "a"), ("not", ("term", "b"))])),
        ("a b or c", True, ("or", [("and", [("term", "a"), ("term", "b")]), ("term", "c")])),
        ('"open phrase', True, ("term", "open phrase")),
    ],
)
def test_parse(query, strict, tree):
    assert keyword.parse(query, strict) == tree


def test_search_word_borders_and_nulls(spark):
    rows = spark.createDataFrame([(1, "Éflood here"), (2, "floods"), (3, "a FLOOD."), (4, None)], "doc_id int, text string")
    got = {q: {r.doc_id for r in search.keyword_search(rows, q).collect()} for q in ("flood", "NOT flood", "flood OR floods")}
    assert got == {"flood": {1, 3}, "NOT flood": {2, 4}, "flood OR floods": {1, 2, 3}}


def test_deep_query_compiles(spark):
    query = " OR ".join(f"w{i}*" for i in range(400))
    assert search.keyword_search(spark.createDataFrame([(1, "none")], "doc_id int, text string"), query, factor=False).count() == 0


def test_first_wins(spark):
    rows = spark.createDataFrame([("x", "b", 1, "late"), ("x", "a", 1, "early"), ("x", "a", 2, "last in file"), ("y", "b", 9, "own")], "id string, path string, pos int, v string")
    assert {(r.id, r.v) for r in search.first_wins(rows, "id", "path", "pos").collect()} == {("x", "last in file"), ("y", "own")}


@pytest.mark.parametrize(
    ("raw", "canonical"),
    [("  3. Introduction ", "3. introduction"), ("IV: Methods", "iv. methods"), ("RE SULTS", "results"), ("MATERIAL S AND ME THODS", "materials and methods"), ("* Results and Discussions", "results and discussion"), ("3.", "3"), ("1. Conclusions", "conclusion"), (None, "")],
)
def test_headers(spark, raw, canonical):
    row = spark.createDataFrame([(raw,)], "h string").select(T.apply_synonyms(T.normalize_header(F.col("h"))).alias("h")).first()
    assert row.h == canonical


def test_text_functions(spark):
    rows = spark.createDataFrame([("é &amp;  x", "12 12 12"), ("plain", "abc"), (None, "a1 bcdefghij")], "a string, b string")
    got = rows.select(T.normalize_text(F.col("a")).alias("a"), T.string_valid(F.col("b")).alias("b")).collect()
    assert [r.a for r in got] == ["e\u0301 & x", "plain", ""]
    assert [r.b for r in got] == [False, True, True]


def model_owner(headers, start):
    """Sequential reading: a pointer stops at the first header that doesn't end before the paragraph."""
    i = -1
    while i + 1 < len(headers) and headers[i + 1][1] <= start:
        i += 1
    return i


def test_header_owner_is_the_sequential_pointer(spark):
    import random

    rng = random.Random(5)
    rows = []
    for k in range(60):
        hs = sorted((a, a + rng.randint(0, 30)) for a in (rng.randint(0, 200) for _ in range(rng.randint(0, 8))))
        rows.append((k, [{"s": a, "e": b} for a, b in hs], rng.randint(0, 230)))
    df = spark.createDataFrame(rows, "k int, headers array<struct<s:int,e:int>>, start int")
    df = df.withColumn("paragraphs", F.array(F.struct(F.col("start").alias("s"), F.col("start").alias("e"))))
    got = {r.k: r.o[0] for r in df.select("k", sections.owners("headers", "paragraphs").alias("o")).collect()}
    assert got == {k: model_owner([(h["s"], h["e"]) for h in hs], s) for k, hs, s in rows}


def test_sectionize(spark):
    def raw(parts):
        text, heads, paras = "", [], []
        for kind, t in parts:
            (heads if kind == "h" else paras).append({"start": str(len(text)), "end": len(text) + len(t)})
            text += t + "\n"
        import json

        return text, {"section_header": json.dumps(heads), "paragraph": json.dumps(paras)}

    body = "The study of the rivers and of the lakes was done for the first time in this region by us."
    parts = [("p", "An opening paragraph of the text."), ("h", "Background"), ("p", body), ("h", "i)"), ("p", body), ("h", "References"), ("p", body), ("h", "Conclusions"), ("p", body), ("h", "Methods"), ("p", body)]
    text, ann = raw(parts)
    docs = spark.createDataFrame([(7, "T", {"text": text, "annotations": ann, "source": None}), (8, "T", {"text": "", "annotations": {}, "source": None})], "corpusid int, title string, body struct<text:string,annotations:map<string,string>,source:string>")
    done = {r.corpusid: r for r in sections.sectionize(sections.normalise_schema(docs)).collect()}
    assert [(s.header, s.text) for s in done["7"].sections] == [("abstract", "An opening paragraph of the text."), ("background", f"{body} {body}"), ("conclusion", body)]
    assert [d.outcome for d in done["7"].detail] == ["kept", "noise_header", "kept", "post_conclusion_truncation"]
    assert done["7"].outcome == "partially_filtered" and done["8"].outcome == "structural_failure"
    report = sections.corpus_report(sections.doc_report(sections.sectionize(sections.normalise_schema(docs)))).first()
    assert report.docs == 2 and report.kept_sections == 3 and report.dropped_sections == 2
    assert {r.reason: r.sections for r in sections.drops_by_reason(sections.doc_report(sections.sectionize(sections.normalise_schema(docs)))).collect()}["noise_header"] == 1


def test_references(spark):
    refs = ["[1] Smith, J. Journal of Tests, vol. 3, pp. 1-2 (2001).", "[2] Doe, A. et al. Science (2010)."]
    text = "\n\n".join(["However, we found the results show nothing of note in this section."] * 2 + refs)
    row = spark.createDataFrame([(text,)], "t string").select(references.split_references(F.col("t")).alias("s")).first().s
    assert row.refs == "\n\n".join(refs) and "However" in row.content


def test_judge(spark):
    rows = [('{"decision": "Maybe", "score": 2, "rationale": "x"}', "maybe", 2, True), ('```json\n{"decision": "relevant", "score": 9}\n```', "relevant", None, False), ("nothing", None, None, False), ('{"decision": "relevant", "score": 1.5}', "relevant", None, False), ('{"decision": "no", "score": 1}', None, None, False)]
    got = spark.createDataFrame([(r[0],) for r in rows], "t string").select(judge.parse_reply(F.col("t")).alias("p")).collect()
    assert [(r.p.decision, r.p.score, r.p.parsed) for r in got] == [r[1:] for r in rows]
    lines = spark.createDataFrame([(i, "g", n) for i, n in enumerate([4, 4, 9, 2, 2, 20, 1])], "i int, g string, n int")
    assert [r.chunk for r in judge.pack_chunks(lines, "n", "g", "i", 8).orderBy("i").collect()] == [0, 0, 1, 2, 2, 3, 4]
    calls = spark.createDataFrame([("k", "p")], "key string, prompt string")
    assert send_all(calls, lambda p: p.upper()).first().reply == "P"


def packed_model(sizes, most):
    out, chunk, used = [], 0, 0
    for n in sizes:
        if used and used + n > most:
            chunk, used = chunk + 1, 0
        out.append(chunk)
        used += n
    return out


@pytest.mark.parametrize("part_bytes", [1 << 20, 60])
def test_packing_of_chunks_is_greedy(spark, part_bytes):
    """Also where many tasks share a group: each run of lines is described before it is known how full the chunk before is."""
    import random

    rng = random.Random(6)
    rows = [(f"g{k % 3}" if k % 7 else None, k, rng.choice([1, 2, 3, 5, 8, 13, 40])) for k in range(400)]
    got = judge.pack_chunks(spark.createDataFrame(rows, "g string, i int, n int"), "n", "g", "i", 20, part_bytes).collect()
    assert len(got) == len(rows)
    for g in {r[0] for r in rows}:
        own = sorted((r for r in got if r.g == g), key=lambda r: r.i)
        assert [r.chunk for r in own] == packed_model([r.n for r in own], 20)


def test_prompt(spark):
    rows = spark.createDataFrame([(1, "T", "A", [("notes", "x" * 30), ("Results", "y" * 30)]), (2, "t" * 90, "", [])], "i int, title string, abstract string, sections array<struct<header:string,text:string>>")
    prompt = judge.judge_prompt("  Be strict.\n", F.col("title"), F.col("abstract"), F.col("sections"), 110)
    got = {r.i: r.p for r in rows.select("i", prompt.alias("p")).collect()}
    head, _, text = got[1].partition("Document:\n")
    assert "Rubric:\nBe strict.\n\nReturn" in head and text == "Title: T\n\nAbstract:\nA\n\nSections:\n\n## Results\n" + "y" * 30 + "\n\n## notes\n" + "x" * 24
    assert got[2].endswith(f"Document:\nTitle: {'t' * 90}\n\nAbstract:\n"[: 10 + 110].rstrip())


class FakeGateway:
    def __init__(self):
        self.sent, self.full, self.asked, self.listed = [], 1, 0, [{"input_file": "/in/batch_requests_000.jsonl", "id": "old", "status": "completed", "created_at": "2024-01-02T00:00:00Z"}]

    def submit(self, model, input_file, output_folder):
        from quarry.operators.batches import QuotaExceeded

        if self.full:
            self.full -= 1
            raise QuotaExceeded("full")
        self.sent.append((model, input_file, output_folder))
        return {"batch_id": f"b{len(self.sent)}", "status": "pending"}

    def batches(self):
        self.asked += 1
        return self.listed + [{"status": "Running"}] * (3 if self.asked < 3 else 0)

    def result(self, batch_id):
        self.asked += 1
        return {"old": (200, {"ok": 1}), "b1": (400, {"error": {"code": "batch_ongoing"}} if self.asked < 12 else {"error": {"code": "BATCH_FAILED", "message": "trace"}})}.get(batch_id, (500, "?"))


def test_batch_machine(spark, tmp_path):
    from quarry.operators import batches as B

    jobs = spark.createDataFrame([(f"k{i}", f"d{i}", f"d{i}.json", "T", f"h{i}", "prompt " * 30) for i in range(5)], "custom_id string, doc_id string, source_path string, title string, input_sha256 string, prompt string")
    lines = jobs.select("custom_id", judge.request_line("m", F.col("custom_id"), F.col("prompt")).alias("line"), F.lit("all").alias("g"))
    lines = lines.withColumn("bytes", F.octet_length("line") + 1)
    most = 2 * lines.first().bytes
    run = str(tmp_path / "run")
    chunks = B.write_chunks(judge.pack_chunks(lines, "bytes", "g", "custom_id", most), run)
    assert [(c["index"], c["num_requests"]) for c in chunks] == [(0, 2), (1, 2), (2, 1)] and chunks == B.found_chunks(run)
    single = B.write_chunks(judge.pack_chunks(lines, "bytes", "g", "custom_id", 10**6), str(tmp_path / "one"))
    assert single[0]["index"] is None and single == B.found_chunks(str(tmp_path / "one"))
    B.write_manifest(jobs, run)
    gateway, slept = FakeGateway(), []
    known = B.resubmit(gateway, spark, run, "/out", "/in", pause=slept.append, now=lambda: "2024-02-01T00:00:00")
    assert [x for _, x, _ in gateway.sent] == ["/in/batch_requests_001.jsonl", "/in/batch_requests_002.jsonl"] and gateway.sent[0][0] == "m" and len(slept) >= 2
    assert known["/in/batch_requests_000.jsonl"]["adopted_from_gateway"] and B.submit(gateway, chunks, list(known), "/out", run, "m") == known and len(gateway.sent) == 2
    got = B.status(gateway, run, wait=False)
    assert got["batches"]["old"]["state"] == "completed" and got["batches"]["b2"]["state"] == "unknown" and str(got["earliest_submitted_at"]).startswith("2024-01-02")
    states = B.poll_results(gateway, ["old", "b1"], wait=True, pause=slept.append)
    assert states["b1"]["state"] == "failed" and states["b1"]["message"] == "trace"
    with pytest.raises(ValueError, match="absolute"):
        B.remote_inputs(chunks, "relative")
    with pytest.raises(ValueError, match="stand for"):
        B.remote_inputs(chunks, file="/one")
    out = tmp_path / "output" / "batch"
    out.mkdir(parents=True)
    reply = '{"custom_id": "%s", "response": {"body": {"choices": [{"message": {"content": "{\\"decision\\": \\"relevant\\", \\"score\\": 2}"}}]}}}\n'
    (out / "r.jsonl").write_text(reply % "k0" + reply % "other" + '{"custom_id": "k1", "error": "boom"}\nnot json\n\n{"custom_id": "k2", "response": {}}\n')
    results, failures = B.collect(B.read_output(spark, str(tmp_path / "output")), B.read_manifest(spark, run))
    assert [(r.custom_id, r.decision, r.score, r.doc_id) for r in results.collect()] == [("k0", "relevant", 2, "d0")]
    assert sorted(r.error.split(":")[0] for r in failures.collect() if r.doc_id is None) == ["custom_id not in manifest", "no custom_id or no JSON"]
    assert sorted(r.doc_id for r in failures.collect() if r.doc_id) == ["d1", "d2", "d3", "d4"]
    assert [r.source_path for r in judge.kept_documents(jobs, results, "Relevant, maybe").collect()] == ["d0.json"]
    with pytest.raises(ValueError, match="invalid decision"):
        judge.keep_decisions("relevant,no")
    assert B.run_folder("/b", "/x/my docs", "a/b c", 3, "f" * 64).endswith("_my-docs_a-b-c_3docs_ffffffff")
    row = spark.range(1).select(B.slug("a b//c..").alias("a"), B.slug("***").alias("b"), B.duration(F.lit(90061)).alias("c"), B.duration(F.lit(61)).alias("d")).first()
    assert tuple(row) == ("a-b-c", "run", "1d 01:01:01", "00:01:01")


def test_run_summary(spark):
    rows = [("a", "h", "m", "u", "p", "relevant", True, 1), ("a", "h", "m", "u", "p", "maybe", True, 2), ("b", "h", "m", "u", "p", None, False, 3), ("c", "old", "m", "u", "p", "maybe", True, 4), ("d", "h", "other", "u", "p", "maybe", True, 5)]
    results = spark.createDataFrame(rows, "source_path string, input_sha256 string, model string, base_url string, prompt_sha256 string, decision string, parsed boolean, at int")
    expected = spark.createDataFrame([(x, "h") for x in "abcd"], "source_path string, input_sha256 string")
    one = judge.run_summary(judge.of_run(results, expected, "m", "u", "p"), "at").first()
    assert (one.succeeded, one.parse_failures, one.decision_counts) == (2, 1, {"relevant": 1})


def test_urls_of_any_length(spark):
    texts = ["http://" + "a" * 1_000_000, "see http://x.org/a_(b)_c(d). end", "www.a.de/(x)(y),", "http://x", "go to example.com/a?b=1, then 555-123-4567", "a." * 200_000, "http://" + "(a)" * 20_000, "!!! ... !!!!"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: (r.s, r.d) for r in rows.select("i", T.strip_noise(F.col("t")).alias("s"), T.url_dominant(F.col("t")).alias("d")).collect()}
    assert got[0] == ("", True) and got[1] == ("see end", True) and got[2] == (",", True) and got[3] == ("http x", False)
    assert got[4] == ("go to then ", True) and got[5][0] and got[6] == ("", True) and got[7][0] == " "
    # a find is replaced wherever it stands, in the order of the text: the reading of a run that holds an earlier one changes
    assert rows.where("i = 7").select(T.strip_noise(F.lit("a...b.....c")).alias("x")).first().x == "a b ..c"


def test_noise_goes_in_the_order_of_the_text_and_in_linear_time():
    import random
    import time

    from quarry.functions import noise

    def plain(text):
        for found, by in ((noise.urls, ""), (noise.PHONE.findall, ""), (noise.SIGNS.findall, " ")):
            for m in found(text):
                text = text.replace(m, by)
        return text

    rng = random.Random(4)
    pool = ["http://", "https://a.b/", "www.", "foo.com/", "a.b-c.org/x", "(", ")", "_", "é", ".", " ", "  ", "-", "555-1234", "(555) 123-4567", "5551234567", "...", "?!", "x", "1", ",", "\n", "co.uk/"]
    for _ in range(3000):
        text = "".join(rng.choice(pool) for _ in range(rng.randrange(1, 20)))
        assert noise.strip(text) == plain(text), text
    long = {"prose": "".join(f"See http://www.a{i}.com/x?y=1, or call 555-123-{i:04d} now... ok --- yes. " for i in range(14_000)), "dots": "a." * 500_000, "one": "x http://x.com/y b " * 50_000, "signs": ". , ! - " * 120_000, "brackets": "http://" + "(a)" * 300_000}
    for name, text in long.items():
        began = time.process_time()
        out = noise.strip(text)
        assert time.process_time() - began < 5, name  # some tenths of a second on a free machine
        assert "http" not in out
    assert noise.urls("a." * 400 + "com/xy, y") == ["a." * 400 + "com/xy"] and noise.urls("_foo.bar.com/xz ..b.org/yy .de/zz") == [".bar.com/xz", "b.org/yy"]


def test_groups_by_one_search(spark):
    """Terms that begin or end alike, overlap or hold signs: each query as if compiled alone."""
    import random

    rng = random.Random(2)
    terms = ["heat", "heat wave", "wave", "heat-wave", "wave heat", "co2", "u.s.", "x+y", "wav", "heat wave index"]
    queries = {f"q{i}": " ".join(rng.choice(['"%s"' % t, "NOT " + '"%s"' % t]) + (f" {rng.choice(['AND', 'OR'])}" if j < 2 else "") for j, t in enumerate(rng.sample(terms, 3))) for i in range(40)}
    texts = [" ".join(rng.choice(["heat", "wave", "heats", "index", "co2", "U.S.", "xxy", "heat-wave", "_heat"]) for _ in range(rng.randint(0, 6))) for _ in range(120)] + [None, ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: set(r.groups) for r in search.tag_groups(rows, queries).collect()}
    want = rows.select("doc_id", *(keyword.compile_query(q, F.col("text")).alias(n) for n, q in queries.items())).collect()
    assert all(got.get(r.doc_id, set()) == {n for n in queries if r[n]} for r in want)


GROUP_FILE = 'q = """\n(\n(\n-- GROUP 1: Water mains\n"water main"\n"water pipe" OR\n-- a comment\n"pump"\n)\nOR\n(\n-- GROUP 2: Dams\n"dam" OR\n"levee"\n)\n)\nAND\n(\n"supply"\n)\nNOT\n(\n"galaxy" OR\n"quark"\n)\n"""\n'


def test_predefined_searches(spark, tmp_path):
    from quarry.plans import predefined as P

    (tmp_path / "File 2_Water.txt").write_text(GROUP_FILE)
    (tmp_path / "File 7_Cross.txt").write_text(GROUP_FILE)
    groups = P.load_groups(str(tmp_path))
    assert [(g["file"], g["group"], g["name"]) for g in groups] == [(2, 1, "Water mains"), (2, 2, "Dams"), (7, 1, "Water mains"), (7, 2, "Dams")]
    assert groups[0]["sector"] == "Water" and groups[1]["subsectors"] == ["Water"] and groups[2]["tag"] == "Water mains" and "sector" not in groups[2]
    rows = spark.createDataFrame([(1, "a water pipe for the supply"), (2, "a dam"), (3, "dam supply quark"), (4, "pump supply levee"), (5, "Extreme heat and climate"), (6, "heat wave alone")], "doc_id int, text string")
    by = {r.doc_id: r.groups for r in search.tag_groups(rows, {f"{g['file']}.{g['group']}": g["query"] for g in groups}).collect()}
    assert by == {1: ["2.1", "7.1"], 4: ["2.1", "2.2", "7.1", "7.2"]}
    assert {r.doc_id for r in search.keyword_search(rows, P.any_group(groups)).collect()} == {1, 4}
    assert {r.doc_id for r in search.keyword_search(rows, P.weather()).collect()} == {5} and sum(map(len, P.HAZARDS)) + len(P.CONTEXTS) == 102
    assert {r.doc_id for r in search.keyword_search(rows, P.anchored(['"dam"', '"pump"'], '"supply"', '"quark"')).collect()} == {4}
    assert keyword.top_level_blocks("(a (b)) x (c)") == ["(a (b))", "(c)"]
    with pytest.raises(ValueError, match="exactly one"):
        P.one_search(weather_terms=True, query="x")
    with pytest.raises(ValueError, match="tags"):
        P.one_search(query="x", with_tags=True)


def test_audit_and_verify(spark):
    body = " of the rivers and of the lakes was done for the first time in this region by us."
    text = "\n".join(["The study" + body, "Table 1", "A review" + body, "Methods", "Short one here.", "Conclusions", "The end" + body, "Later", "The sequel" + body])
    docs = sections.from_lines(spark.createDataFrame([(1, text), (2, ""), (3, None)], "doc_id long, text string"), 12)
    done = sections.sectionize(docs)
    rows = {r.idx: (r.present, r.reason) for r in sections.audit(docs, done).collect()}
    assert rows == {-1: (True, None), 0: (False, "noise_header"), 1: (False, "non_substantive"), 2: (True, None), 3: (False, "unknown_after_break")}
    got = sections.verify(docs, done, patterns=["rivers"])
    assert got["audited"] == 1 and got["sampled"] == 3 and got["skipped_missing_sect"] == 2 and got["sections"] == 5
    with pytest.raises(ValueError, match="exceeds"):
        sections.verify(docs, done, fail_threshold=0.5)
    with pytest.raises(LookupError):
        sections.verify(docs.where("false"), done)
    report = sections.doc_report(done)
    summary = sections.summary_document(sections.corpus_report(report), sections.drops_by_reason(report), "v2", "here")
    assert summary["totals"]["documents_processed"] == 3 and set(summary["totals"]["outcomes"]) == set(sections.OUTCOMES) and summary["totals"]["avg_section_length"]["after"]["sections"] == 2
    twice = sections.sectionize(docs.unionByName(docs))
    assert twice.count() == 6 and {len(r.sections) for r in twice.where("corpusid = '1'").collect()} == {2}


def test_convert(spark):
    got = spark.createDataFrame([(["One.", "Two goes", "on.", ""],)], "p array<string>").select(convert.merge_paragraphs(F.col("p")).alias("t")).first()
    assert got.t == "One.\n\nTwo goes on."


def test_tei_keeps_nesting_and_order(spark):
    english = "It is the end of the story that was told."
    good = f"""<?xml version="1.0"?><TEI xmlns="http://www.tei-c.org/ns/1.0" xmlns:t="u"><teiHeader><abstract/><abstract><p>Not this</p></abstract></teiHeader><text><body>
        <div><head>One &amp; <hi>only</hi></head><p>{english}</p><div><head>Inner</head><p>In <![CDATA[<the> middle]]> of the text &eacute; and &nosuch;so on.</p></div><p>And of the end.</p></div>
        <t:div><!-- <head>No</head> --><p>First sentence of it. {english}</p></t:div><div/><div><p>no sentence</p></div><div><head>Table 1</head><p>{english}</p></div></body>
        <back><div><head>Back</head><p>{english}</p></div></back></text></TEI>"""
    cut = f"<TEI><abstract><p> Short <b>one</b> </p><p>two</p></abstract><body><div><head>Kept</head><p>{english}</p></div><div><head>Cut</head><p>The start of the"
    files = spark.createDataFrame([("a", good), ("b", cut), ("c", "no markup"), ("d", ""), ("e", None)], "path string, value string")
    got = {(r.path, r.idx): (r.header, r.text) for r in convert.tei_sections(files).collect()}
    assert got == {
        ("a", 0): ("One & only", f"{english}\n\nIn <the> middle of the text e\u0301 and so on.\n\nAnd of the end."),
        ("a", 1): ("Inner", "In <the> middle of the text e\u0301 and so on."),
        ("a", 2): ("First sentence of it.", english),
        ("b", -1): ("abstract", "Short one"),
        ("b", 0): ("Kept", english),
        ("b", 1): ("Cut", "The start of the"),
    }
    from quarry.functions import registry

    registry.register(spark)
    files.createOrReplaceTempView("tei_files")
    rows = spark.sql("SELECT path, idx, head, size(paragraphs) AS n FROM quarry_tei_sections(TABLE(SELECT path, value FROM tei_files)) ORDER BY path, idx").collect()
    assert [tuple(r) for r in rows] == [("a", 0, "One & only", 3), ("a", 1, "Inner", 1), ("a", 2, "", 1), ("a", 3, "", 0), ("a", 4, "", 1), ("a", 5, "Table 1", 1), ("b", -1, "abstract", 1), ("b", 0, "Kept", 1), ("b", 1, "Cut", 1)]


def test_streaming_each_file_once(spark, tmp_path):
    from quarry.streaming.incremental import process_new

    seen = []
    src = tmp_path / "in"
    src.mkdir()
    for k in range(2):
        (src / f"{k}.json").write_text(f'{{"id": {k}}}\n')
        process_new(spark, str(src), "id long", str(tmp_path / "cp"), lambda df, b: seen.extend(r.id for r in df.collect()))
    assert sorted(seen) == [0, 1]


def test_readers(spark, tmp_path):
    from quarry.sources import documents as D

    (tmp_path / "a.json").write_text('{"corpusid": 1, "body": {"text": "x"}}\nnot json\n')
    good, bad = D.read_shards(spark, str(tmp_path / "a.json"))
    assert good.count() == 1 and bad.first().line == "not json"
    assert re.fullmatch("..", spark.range(1).select(D.bucket(F.lit("12345"))).first()[0])


def test_title_and_sample(spark):
    from quarry.sources import documents as D

    rows = spark.createDataFrame([(1, " \n A title \nrest"), (2, None), (3, "first\u2028second line")], "doc_id long, text string")
    assert [r.t for r in rows.select(D.best_title(F.lit(None).cast("string"), F.col("text")).alias("t")).collect()] == ["A title", "", "first"]
    many = spark.range(100).withColumnRenamed("id", "doc_id")
    one, two = ([r.doc_id for r in search.sample(x, "doc_id", 10, 3).collect()] for x in (many, many.repartition(7)))
    assert one == two and len(set(one)) == 10
    assert one != [r.doc_id for r in search.sample(many, "doc_id", 10, 4).collect()]


def test_discovery(spark, tmp_path):
    from quarry.sources import discovery as D

    for x in ("a.json", "a.txt", ".hidden.json", "s/b.json", "s/t/c.json", "x.jsonl.gz", "s/batches/y.jsonl.gz", "s/other/z.jsonl.gz", "s/l.jsonl", "s/t/m.gz"):
        (tmp_path / x).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / x).write_text("{}")
    names = lambda paths: [p.split(str(tmp_path) + "/")[1] for p in paths]
    root = str(tmp_path)
    assert names(D.document_files(spark, root)) == ["a.json", "s/b.json"]
    assert names(D.batch_files(spark, root)) == ["x.jsonl.gz", "s/batches/y.jsonl.gz"]
    lines, single = D.dataset_files(spark, root)
    assert names(lines) == ["s/l.jsonl", "s/batches/y.jsonl.gz", "s/other/z.jsonl.gz", "s/t/m.gz", "x.jsonl.gz"] and names(single) == ["a.json", "s/b.json", "s/t/c.json"]
    for bad in (root, root + "/", root + "/out"):
        with pytest.raises(ValueError, match="within"):
            D.apart(root, bad)
    D.apart(root, root + "_out")


def test_filter_of_files(spark, tmp_path):
    from quarry.sources import discovery as D

    src = tmp_path / "in"
    (src / "a").mkdir(parents=True)
    (src / "a" / "1.json").write_text('{"title": ["Keep"], "paragraph": ["one", "two"]}')
    (src / "2.json").write_text('{"title": "x", "paragraph": ["a SECRET thing"]}')
    (src / "3.json").write_text("{broken")
    (src / "l.jsonl").write_text('{"body": {"text": "fine"}}\n\nnot json\n{"content": {"text": "secret"}, "title": "t"}\n[1]\n')
    got = D.filter_dataset(spark, str(src), str(tmp_path / "out"), ["secret"])
    assert {k: got[k] for k in ("files_copied", "files_excluded", "batch_files_processed", "documents_kept", "documents_excluded", "documents_failed_parse")} == {"files_copied": 1, "files_excluded": 1, "batch_files_processed": 1, "documents_kept": 3, "documents_excluded": 1, "documents_failed_parse": 3}
    assert got["matched_counts"] == {"secret": 2}
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out" / "lines")).collect()) == ["[1]", "not json", '{"body": {"text": "fine"}}']
    assert spark.read.parquet(str(tmp_path / "out" / "documents")).first().value == '{"title": ["Keep"], "paragraph": ["one", "two"]}'
    for folder in ("x", "y"):  # files of one name in two folders stay apart
        (src / folder).mkdir()
        (src / folder / "same.jsonl").write_text(f'{{"title": "{folder}"}}\n')
    D.filter_dataset(spark, str(src), str(tmp_path / "again"), ["secret"])
    kept = {(r.f, r.value) for r in spark.read.text(str(tmp_path / "again" / "lines")).select(F.col("file").alias("f"), "value").collect()}
    assert {("x/same.jsonl", '{"title": "x"}'), ("y/same.jsonl", '{"title": "y"}')} < kept


def test_metadata_sources(spark, tmp_path):
    from quarry.operators import metadata as M

    url = f"jdbc:derby:{tmp_path}/db;create=true"
    driver = "org.apache.derby.jdbc.EmbeddedDriver"
    rows = spark.createDataFrame([("1", "First", "A Name", "P", "2001", "10.1/x"), ("1", "Again", "A Name", "P", "2001", "10.1/x"), ("2", "Second", None, None, None, None)], "corpus_id string, title string, author string, publisher string, date string, doi string")
    rows.coalesce(1).write.format("jdbc").options(url=url, dbtable="meta", driver=driver).save()
    meta = M.read_jdbc(spark, url, "meta", driver=driver)
    docs = spark.createDataFrame([("1", {"Abstract": "short", "References": "refs", "body": "text"}), ("2", {"Abstract": "", "body": "x"}), ("3", {"body": "none"})], "corpus_id string, sections map<string,string>")
    got = {r.unique_id: r for r in M.packaged(docs, "s", meta, titled=True).collect()}
    assert set(got) == {"1", "2"} and got["1"].title == "Again" and (got["1"].abstract, got["1"].references, got["1"].authors, got["1"].date) == ("short", "refs", ["A Name"], "2001")
    assert got["1"].text == {"body": "text"} and got["2"].text == {"Abstract": "", "body": "x"} and got["2"].authors == [] and got["2"].date == "0"
    (tmp_path / "ids.csv").write_text("a,b,c,d,e,f,id\n1,2,3,4,5,6,77\n1,2,3,4,5,6,77\n1,2,3,4,5,6, 78\n")
    assert sorted(r.doc_id for r in M.read_csv_ids(spark, str(tmp_path / "ids.csv")).collect()) == ["77", "78"]


def test_recognised_files(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("<title>Größe</title>".encode())
    (tmp_path / "b.txt").write_bytes("<title>Größe</title>".encode("latin-1"))
    (tmp_path / "c.bin").write_bytes(b"no")
    assert {r.value for r in convert.read_recognised(spark, str(tmp_path)).collect()} == {"<title>Größe</title>"}


def test_section_dataset(spark, tmp_path):
    import json

    from quarry.operators import workflow

    body = "The study of the rivers and of the lakes was done for the first time in this region by us."

    def raw(i, text):
        ann = {"paragraph": json.dumps([{"start": 8, "end": 8 + len(text)}]), "section_header": json.dumps([{"start": 0, "end": 7}])}
        return {"corpusid": i, "title": f"T{i}", "body": {"text": f"Methods\n{text}", "annotations": ann}}

    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    (src / "0.json").write_text("\n".join(json.dumps(raw(i, body if i else "too short")) for i in range(3)) + "\nbroken\n")
    one = workflow.section_dataset(spark, str(src), out, exclude="nothing like it", detail=True)
    assert one["totals"]["documents_processed"] == 3 and one["totals"]["outcomes"]["fully_filtered"]["count"] == 1 and one["totals"]["previously_written"] == 0
    assert json.loads((tmp_path / "out" / "sectionization_report.json").read_text()) == one
    assert {r.corpusid: [(s.header, s.text) for s in r.sections] for r in workflow.written(spark, out).collect()} == {"1": [("methods", body)], "2": [("methods", body)]}
    assert [r.line_number for r in workflow.failed(spark, out).collect()] == [4]
    (src / "1.json").write_text(json.dumps(raw(9, body + " secret")) + "\n" + json.dumps(raw(10, body)) + "\n")
    two = workflow.section_dataset(spark, str(src), out, exclude="secret")
    assert two["totals"]["previously_written"] == 2 and two["totals"]["outcomes"]["excluded_by_pattern"]["count"] == 1 and workflow.written(spark, out).count() == 3
    legacy = tmp_path / "old"
    legacy.mkdir()
    (legacy / "5.json").write_text(json.dumps({"response": {"docs": [{"corpus_id": ["5"], "title": ["L"], "abstract": [body], "paragraph": [body], "sectionheader": ["Results"]}]}}))
    got = workflow.section_dataset(spark, str(legacy), str(tmp_path / "old_out"), pipeline="v1")
    assert got["totals"]["outcomes"]["unfiltered"]["count"] == 1 and [s.header for s in workflow.written(spark, str(tmp_path / "old_out")).first().sections] == ["abstract", "results"]
    with pytest.raises(LookupError):
        (tmp_path / "empty").mkdir()
        workflow.section_dataset(spark, str(tmp_path / "empty"), str(tmp_path / "x"), pipeline="v1")


def test_registered_functions(spark):
    from quarry.functions import registry

    names = registry.register(spark)
    assert spark.sql("SELECT quarry_normalize_text('a &amp;  b') AS x").first().x == "a & b"
    texts = ["1. Results  and Discussion", "see http://a.b/cd, 555-1234 now", "Smith, J. (2001). Nature 12: 3-4. doi 10.1000/x", None, "", "the cat and the dog of it's", "IV. M\u00e9thodes \\ 'q' & x", "le chat et la der die das und"]
    some = spark.createDataFrame([(t,) for t in texts], "t string")
    some.createOrReplaceTempView("some_texts")
    for name, f in registry.COLUMNS.items():  # in SQL as in Python
        assert f"quarry_{name}" in names and [r.x for r in spark.sql(f"SELECT quarry_{name}(t) AS x FROM some_texts").collect()] == [r.x for r in some.select(f(F.col("t")).alias("x")).collect()]
    registry.define_search(spark, "wet", '(flood* OR "the dog") AND NOT nature')
    assert [r.x for r in spark.sql("SELECT coalesce(wet(t), false) AS x FROM some_texts").collect()].count(True) == 1
    plan = spark.sql("SELECT quarry_string_valid(t) FROM some_texts")._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "regexp_extract_all" in plan  # inlined, no call is left
    rows = spark.createDataFrame([("  3. Results  of\u00a0it ",), (None,)], "t string")
    got = registry.add_columns(rows, "t", h="normalize_header", ok="string_valid").collect()
    assert got[0].h == "3. results of it" and got[1].h == ""
    assert rows.where(registry.keyword_match("t", "results AND NOT x")).count() == 1
    assert search.matching_ids(rows, "results", "t", "t").count() == 1 and [r.t for r in search.first_rows(rows, "t", 1).collect()] == [None]


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("Introduction", "introduction"), ("INTRODUCTION", "introduction"), ("1 Introduction", "1. introduction"), ("1.2.3 Data sets", "1.2.3. data sets"), ("(ii) Model setup", "ii. model setup"), ("[4] Site", "4. site"),
        ("A. Study area", "a. study area"), ("B) Sampling", "b) sampling"), ("VII. Discussion", "vii. discussion"), ("| Methods", "methods"), ("*# Methods", "methods"), ("Results:", "results"), ("'Results'", "results"), ("Results – part 2", "results - part 2"),
        ("RES ULTS", "results"), ("D ISC USSION", "discussion"), ("IN TRODUC TION AND MET HODS", "in troduc tion and methods"), ("The Of And", "the of and"), ("Re sults", "re sults"), ("", ""), ("   ", ""), ("12", "12"), ("3.1", "3.1"), ("\u200bResults\ufeff", "results"),
        ("R&amp;D", "r&d"), ("Re\u0301sume\u0301", "re\u0301sume\u0301"), ("R\u00e9sum\u00e9", "re\u0301sume\u0301"), ("... Summary ...", "summary"), ("x", "x"), ("5. ", "5"),
    ],
)
def test_header_table(spark, raw, expected):
    row = spark.createDataFrame([(raw,)], "h string")
    one = row.select(T.normalize_header(F.col("h")).alias("h")).first().h
    assert one == expected


@pytest.mark.parametrize(
    ("header", "markup", "noise"),
    [
        ("", True, True), ("iv", True, True), ("iv.", True, True), ("x", True, True), ("3.1", True, True), ("gis", True, True), ("map", True, True), ("a b c", True, True), ("results", False, False), ("table 3", False, True), ("fig. 2", False, True),
        ("figure", False, True), ("keywords", False, True), ("author contributions", False, True), ("stable isotopes", False, True), ("stable isotopes of the water in lakes", False, False), ("toolbox", False, True), ("study 2020 1999 12", False, True), ("references", False, True),
    ],
)
def test_header_noise_table(spark, header, markup, noise):
    row = spark.createDataFrame([(header,)], "h string").select(T.structural_noise(F.col("h")).alias("m"), T.header_noise(F.col("h")).alias("n")).first()
    assert (row.m, row.n) == (markup, noise)


def test_small_readers_and_writers(spark, tmp_path):
    from quarry.sources import documents as D

    (tmp_path / "s" / "x").mkdir(parents=True)
    (tmp_path / "s" / "x" / "1.json").write_text('{"title": "T", "Results": " a\\n b ", "empty": "  "}')
    (tmp_path / "s" / "failures.json").write_text('{"not": "read"}')
    got = {(r.header, r.text) for r in D.read_sectionized(spark, str(tmp_path / "s")).collect()}
    assert {h for h, _ in got} == {"title", "Results"}
    (tmp_path / "n").mkdir()
    for x in ("12.json", "12.txt", "7.json", "a1.json"):
        (tmp_path / "n" / x).write_text("")
    assert [r.stem for r in D.count_numeric_stems(spark, str(tmp_path / "n")).collect()] == ["12", "7"]
    (tmp_path / "bad.json").write_text('{"corpusid": 1}\n{broken\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        D.read_strict(spark, str(tmp_path / "bad.json")).collect()
    D.write_summary(spark.createDataFrame([(1, "x")], "b int, a string"), str(tmp_path / "one.json"))
    assert (tmp_path / "one.json").read_text() == '{\n  "a": "x",\n  "b": 1\n}'
    found = spark.createDataFrame([("p", ["b", "a"])], "path string, terms array<string>")
    D.write_matches(found, str(tmp_path / "m"), paths=False)
    assert [tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "m")).collect()] == [("a; b",)]
    D.write_report(spark.createDataFrame([("1", None)], "id string, sections string"), str(tmp_path / "r"))
    assert {f.suffix for f in (tmp_path / "r").glob("part*")} == {".gz"} and spark.read.text(str(tmp_path / "r")).first().value == '{"id":"1"}'


def test_span_cases(spark):
    from quarry.sources import documents as D

    cases = [None, "", "no json", '{"start": 1}', "[]", '[{"start": "3", "end": "5"}, {"start": 1, "end": 2}]', '[{"start": 1, "end": "x"}, {"start": 2, "end": 4}]', '[{"start": -1, "end": 4}]', '[{"start": null, "end": 4}]', '[{"start": 5, "end": 2}]']
    rows = spark.createDataFrame(list(enumerate(cases)), "i int, a string").select("i", D.spans(F.col("a")).alias("s")).collect()
    assert [[tuple(x) for x in r.s] for r in sorted(rows)] == [[], [], [], [], [], [(1, 2), (3, 5)], [(2, 4)], [], [], [(5, 2)]]


def test_older_layout_and_titles(spark):
    import json

    text = "The title\nHead\nA paragraph of the text."
    ann = {"paragraph": json.dumps([{"start": 15, "end": len(text)}]), "sectionheader": json.dumps([{"start": 10, "end": 14}]), "papertitle": json.dumps([{"start": 4, "end": 9}])}
    docs = spark.createDataFrame([(1, None, None, {"text": text, "annotations": ann}), (2, "Own", {"text": text, "annotations": {}}, None)], "corpusid int, title string, body struct<text:string,annotations:map<string,string>>, content struct<text:string,annotations:map<string,string>>")
    got = {r.corpusid: r for r in sections.normalise_schema(docs).collect()}
    assert got["1"].title == "title" and [tuple(x) for x in got["1"].headers] == [(10, 14)] and len(got["1"].paragraphs) == 1
    assert got["2"].title == "Own" and got["2"].text == text and got["2"].headers == []


def test_new_ids_stream(spark, tmp_path):
    from quarry.streaming.incremental import new_ids

    src = tmp_path / "in"
    src.mkdir()
    for k, ids in enumerate((["a", "b"], ["b", "c"])):
        (src / f"{k}.json").write_text("".join(f'{{"id": "{i}"}}\n' for i in ids))
        new_ids(spark, str(src), "id string", str(tmp_path / "cp"), str(tmp_path / "out"), "id")
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b", "c"]


def test_first_wins_over_runs(spark, tmp_path):
    import json
    import time

    from quarry.streaming import first_wins as W

    src, target, schema = tmp_path / "in", str(tmp_path / "out"), "id string, shard string, line int, title string, score double, tags array<string>"
    src.mkdir()

    def run(name, rows, **options):
        (src / name).write_text("".join(json.dumps(dict(zip(("id", "shard", "line", "title", "score", "tags"), r, strict=True))) + "\n" for r in rows))
        W.collect(spark, str(src), schema, "id", ["shard", "line"], str(tmp_path / options.pop("cp", "cp")), target, **options)
        return {r.id: (r.title, r.score, r.tags) for r in W.current(spark, target, "id").collect()}

    assert run("1.json", [("a", "s2", 1, "later", 1.0, ["x"]), ("a", "s1", 9, "first", None, ["y", None]), (None, "s", 1, "none", 1.0, ["x"]), ("b", "s1", 2, "b", 2.0, None)]) == {"a": ("first", None, ["x", "y"]), "b": ("b", 2.0, [])}
    assert run("2.json", [("a", "s0", 1, "late shard", 3.0, ["z"]), ("b", "s0", 1, "again", 3.0, []), ("c", "s1", 1, None, 4.0, ["x"])]) == {"a": ("first", None, ["x", "y", "z"]), "b": ("b", 2.0, []), "c": (None, 4.0, ["x"])}
    files = len(list((tmp_path / "out").iterdir()))
    assert run("3.json", [("a", "s0", 2, "a third time", 3.0, ["x"])])["a"] == ("first", None, ["x", "y", "z"])
    assert spark.read.parquet(f"{target}/batch={files}").count() == 0  # nothing new: no update
    target = str(tmp_path / "out2")
    run("4.json", [], cp="cp2", ttl=1000)
    time.sleep(1.5)  # what is forgotten is new again
    assert run("5.json", [("a", "s9", 1, "new", 5.0, ["q"])], cp="cp2", ttl=1000)["a"] == ("new", 5.0, ["q"])


def test_exclusion_patterns():
    assert search.compile_patterns("a.b, c ", ["# no", "", " d{1} "]) == ["a.b", "c", "d{1}"]
    with pytest.raises(re.error):
        search.compile_patterns("(")


def test_exclusion_patterns_match_as_sql_does(spark):
    import duckdb

    texts = ["station", "tion\u00e9tion\u00e9", "TION\u00ca!!", "\u00e9tion", "licen\u017fe", "a.b", "tion\rx scum", "tion\nx scum", "b]tion-", "", None]
    patterns = [r"tion\b", r"\btion", r"tion\B.", "license", r"a[.\]b]b", r"tion\b.*scum", r"\\b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {r.i: r.m for r in docs.select("i", search.matched_patterns(patterns, F.col("text")).alias("m")).collect()}
    says = duckdb.connect()
    assert got == {i: [p for p in patterns if says.execute("SELECT regexp_matches(?, '(?i)' || ?)", [t, p]).fetchone()[0]] for i, t in enumerate(texts)}
    kept, hits = search.exclude(docs, [r"tion\b"], "text")
    assert [r.i for r in kept.orderBy("i").collect()] == [4, 5, 9, 10] and hits.first().hits == 7


def test_counts_without_lists_of_matches(spark):
    texts = ["the cat in the hat", "der die das the", "que de la", "la de", "xyz", "", None, "a  b ", " a", "12 34", "n\u00e9 1", "x" * 39, "x" * 40, "\u00e9" * 30 + "y" * 19, "\u00e9" * 30 + "y z" * 10, "\U0001d7d9 ab", "1" * 30 + "a" * 70, "1" * 31 + "a" * 69]

    def language(t):
        ws = re.findall(r"[^\W\d_]+", t.lower())
        n = {k: sum(w in v for w in ws) for k, v in T.FREQUENT.items()}
        return max(n, key=n.get) if any(n.values()) else None

    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    c = F.col("t")
    columns = [T.stopword_language(c).alias("a"), T.word_count(c).alias("b"), T.substantive(c).alias("c"), T.string_valid(c).alias("d")]
    plan = rows.select(*columns)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("regexp_extract_all") == len(T.FREQUENT)  # each language's list once, no list of characters
    for r in rows.select("i", *columns).collect():
        t = texts[r.i]
        if t is None:
            assert tuple(r)[1:] == (None,) * 4
            continue
        digits = sum(x.isdecimal() for x in t)
        special = sum(not (x.isascii() and x.isalnum()) for x in t)
        assert tuple(r)[1:] == (language(t), len([w for w in t.split(" ") if w]), len(t) >= 40 and sum(x.isascii() and x.isalpha() for x in t) >= 20, not digits or (digits <= 0.3 * len(t) and special <= 0.3 * len(t))), t


def test_python_gets_texts_in_bounded_batches(spark, tmp_path):
    from quarry import queries as engine
    from quarry.scratch import BATCHES

    spark.range(3).selectExpr("id AS doc_id", "'The end of the way.' AS text", "'en' AS lang", "'s' AS source").write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("sectionize", "ground_truth_sections", "tei_documents", "legacy_outcomes", "slugs_and_times", "sql_functions", "reference_split"):
        for k in BATCHES:
            spark.conf.unset(k)
        engine.queries()[name](spark, str(tmp_path))
        assert {k: spark.conf.get(k) for k in BATCHES} == BATCHES, name
    for k in BATCHES:
        spark.conf.unset(k)


#: Queries of the engine that SQL can't say, each with the test that holds it.
WITHOUT_SQL: set[str] = set()


def test_entry_queries_have_sql():
    import __spark_entry__ as e

    own = {q for q in e.queries() if not q.startswith("op") and q != "pipeline"}
    assert set(e.oracle_sql()) <= set(e.queries()) and own - set(e.oracle_sql()) == WITHOUT_SQL
