"""The training-data operators against brute force, round trips and held-out accuracy."""

import hashlib
import itertools
import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import decontam, exact_dedup, langid, minhash, packing, pii, token_counts, toxicity, url_filters, warc

EDGE = [(900, None), (901, ""), (902, " \n"), (903, "a b"), (904, "A  b"), (905, "😀 " * 3000), (906, "x" * 50_000)]
DOC = "doc_id long, text string"


@pytest.fixture
def edge(spark):
    """Nulls, empty and long texts, repeats, and columns whose names clash with the operators' own."""
    rows = EDGE + [EDGE[0], EDGE[3], (None, "a b"), (None, None)]
    return spark.createDataFrame([(*r, 1, "k") for r in rows], DOC + ", h int, slice string")


def near_model(rows, percent):
    sets = {}
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {d: d for d in sets}

    def find(x):
        return x if root[x] == x else find(root[x])

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            p, q = sorted((find(a), find(b)))
            root[q] = p
    return {d: (len(s), find(d)) for d, s in sets.items()}


@pytest.mark.parametrize("cell", [200, 10])
def test_minhash_is_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(minhash, "CELL_DOCS", cell)
    rng = random.Random(3)
    rows = list(EDGE)
    for i in range(250):
        w = [f"w{j}" for j in range(100)]
        for _ in range(rng.choice([0, 1, 1, 2, 3, 4, 6])):
            w[rng.randrange(100)] = f"x{rng.randrange(50)}"
        rows.append((i, " ".join(w[: rng.randrange(60, 100)] if i % 3 == 0 else w)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(spark.createDataFrame(rows, DOC), 85).collect()}
    assert got == near_model(rows, 85)


@pytest.mark.parametrize("options", [{}, {"least": 3, "most": 9, "identify": lambda c: F.crc32(c.cast("binary")) % 50}])
def test_exact_is_brute_force(spark, options):
    rng = random.Random(1)
    rows = EDGE + [(i, " ".join(rng.choice(["ab", "c", "the cat"]) for _ in range(rng.randrange(6)))) for i in range(200)]
    groups = defaultdict(list)
    for d, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), d))
    want = {d: (min(g)[1], len(g), hashlib.sha256(n.encode()).hexdigest()) for n, g in groups.items() for _, d in g}
    got = exact_dedup.exact_duplicates(spark.createDataFrame(rows, DOC), **options).collect()
    assert {r.doc_id: (r.keep_id, r.group_size, r.text_sha256) for r in got} == want and len(got) == len(rows)


def test_token_counts_are_the_library(spark):
    P = pytest.importorskip("public_tokenizers")
    import sentencepiece

    path = str(P.path("piece_bpe_32k.model"))
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    own = token_counts.counter(path)
    rng = random.Random(2)
    texts = ["", " ", "  a", "<s> x </s>", "▁▁x ▁", "日本語 テキスト", "\x00a\n\n\tb", "😀" * 9]
    texts += ["".join(rng.choice("aeinst  .é\nß日0▁") for _ in range(rng.randint(1, 60))) for _ in range(400)]
    lengths = packing.Lengths(path)
    assert lengths.counts(texts) == [len(sp.encode(t)) for t in texts] and lengths.counts([None, "a b", ""]) == [0, len(sp.encode("a b")), 0]
    for t in texts:
        for size in (token_counts.CHUNK, rng.randint(1, 9)):
            assert own.count(t, size) == len(sp.encode(t)), (t, size)


def test_token_counts_of_odd_rows(spark, edge):
    P = pytest.importorskip("public_tokenizers")
    path = str(P.path("piece_bpe_32k.model"))
    got = token_counts.token_counts(edge, path, 3000)
    rows = {r.doc_id: r for r in got.collect()}
    assert got.count() == edge.count() and got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert [tuple(rows[i][1:]) for i in (900, 901)] == [(0, 0, False)] * 2 and rows[905].n_bytes == 15_000 and rows[905].over_limit
    assert token_counts.token_counts(edge.where("false"), path).count() == 0
    n = {r.doc_id: r.n_tokens for r in packing.token_lengths(edge, path).collect()}
    assert n == {i: r.n_tokens for i, r in rows.items()} and packing.pack(packing.token_lengths(edge, path), F.col("n_tokens")).agg(F.sum("n_tokens")).first()[0] == sum(r.n_tokens for r in got.collect())


def test_packing_of_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(packing, "SLICE_ROWS", 7)
    rows = [(None, "a b c")] * 40 + [(5, "a")] * 3 + [(i, "a b") for i in range(30)]
    got = packing.pack(spark.createDataFrame(rows, DOC), budget=10).collect()
    assert len(got) == len(rows) and len({(r.bucket, r.batch, r.slot) for r in got}) == len(rows)
    assert sorted((r.doc_id is None, r.n_tokens) for r in got) == sorted((d is None, len(t.split())) for d, t in rows)
    per = defaultdict(set)
    for r in got:
        per[r.bucket, r.batch].add(r.slot)
    assert all(s == set(range(len(s))) and len(s) * b <= 10 for (b, _), s in per.items())


def test_packing(spark, edge):
    rng = random.Random(1)
    for _ in range(100):
        x = sorted(rng.sample(range(60), rng.randint(1, 8)))
        n, k = [rng.randint(1, 20) for _ in x], rng.randint(1, 4)
        cost = lambda bounds: sum((min(b for b in bounds if b >= v) - v) * m for v, m in zip(x, n, strict=True))
        best = min(cost([*c, x[-1]]) for r in range(min(k, len(x))) for c in itertools.combinations(x[:-1], r))
        bounds = packing.boundaries(x, n, k)
        assert len(bounds) <= k and cost(bounds) == best
    rows = packing.pack(edge, max_tokens=700, budget=2000).collect()
    batches = defaultdict(list)
    for r in rows:
        batches[r.bucket, r.batch].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) and len(s) * b <= max(2000, b) for (b, _), s in batches.items())
    assert sum(r.n_tokens for r in rows) == sum(len((r.text or "").split()) for r in edge.collect()) and len({(r.doc_id, r.part) for r in rows}) >= 12


def test_decontamination(spark):
    item = "A train leaves Boston at 40 km per hour and travels 120 km before it meets Alice who walks 41 m"
    bench = spark.createDataFrame([(1, item, 0), (2, None, 0), (3, "too short", 0)], "item_id long, text string, pos int")
    changed = "x y. A train leaves Denver at 55 miles per hour and travels 300 miles before it meets Bob who walks 7 feet. ok"
    other = "A train leaves Denver late and nobody travels far before it rains on all who walk home from there at night"
    docs = spark.createDataFrame([(1, changed), (2, other), (3, None), (4, ""), (1, changed), (None, changed)], DOC)
    assert [(r.doc_id, r.item_id) for r in decontam.contaminated(docs, bench).collect()] == [(1, 1)]
    assert sorted(r.doc_id or 0 for r in decontam.decontaminate(docs, bench).collect()) == [0, 2, 3, 4]
    assert decontam.contaminated(docs, bench.where("false")).count() == 0


def leak_model(docs, items):
    """Pairs that hold: the definition in plain Python, one item and one text at a time."""
    units, stops = set(decontam.UNITS.split()), set(".!?:;\n\r\"|")

    def tokens(text, named_first=False):
        found = [(m.start(), m.end(), m[0]) for m in re.finditer(r"[0-9A-Za-z]+(?:(?<=[0-9])[.,](?=[0-9])[0-9A-Za-z]+)*", text)]
        out = []
        for i, (a, b, w) in enumerate(found):
            before = text[: a].rstrip("\t\f\v ")
            initial = (not before and not named_first) or (before != "" and before[-1] in stops)
            name = w[0].isupper() and len(w) > 1 and sum(c.isupper() for c in w) == 1
            number = all(c in "0123456789.," for c in w)
            kind = "#" if number else "@" if name and not initial else "u" if i and out[-1][0] == "#" and w.lower() in units else ""
            if kind == "@" and out and out[-1][0] == "@" and text[found[i - 1][1] : a].strip("\t\f\v ") == "":
                out[-1] = ("@", out[-1][1] + (w.lower(),))
            else:
                out.append((kind, (w.lower(),)))
        return out

    def windows(ts):
        return [(i, tuple(k or w for k, w in ts[i : i + 5])) for i in range(len(ts) - 4) if sum(not k for k, _ in ts[i : i + 5]) >= 2]

    got = set()
    for d, text in docs:
        ts = tokens(text)
        at = defaultdict(list)
        for i, w in windows(ts):
            at[w].append(i)
        for item, said in items:
            own, forms = tokens(said), defaultdict(set)
            for i, w in windows(own):
                forms[i].add((w, i, 0))
            other = tokens(said, True)
            for i, w in windows(other)[:1] if other and other[0][0] == "@" and own[0][0] == "" else ():
                if i == 0:
                    forms[0].add((w, 0, 1))
            hit = {i for i, ws in forms.items() if any(w in at for w, _, _ in ws)}
            if not forms or len(hit) / len(forms) < decontam.COVERAGE:
                continue
            fill = defaultdict(lambda: defaultdict(lambda: defaultdict(int)))
            for i in hit:
                for w, _, version in forms[i]:
                    for p in at.get(w, ()):
                        src = (other if version else own)[i : i + 5]
                        for (k, x), (_, y) in zip(src, ts[p : p + 5], strict=True):
                            if k:
                                fill[p - i][x][y] += 1
            best = max(((sum(sum(y.values()) for y in f.values()), sum(max(y.values()) for y in f.values())) for f in fill.values()), default=(1, 1))
            if best[1] / best[0] >= decontam.AGREEMENT:
                got.add((d, item))
    return got


def test_decontamination_is_the_definition(spark):
    rng = random.Random(8)
    words, names = "a train leaves and travels before it meets the one who walks home from there at night".split(), ["Boston", "Denver", "New York", "Alice", "Mary Ann", "Salt Lake City"]

    def sentence():
        out = [rng.choice(words) if rng.random() < 0.7 else rng.choice([rng.choice(names), f"{rng.randint(2, 900)} {rng.choice(['km', 'miles', 'apples'])}"]) for _ in range(rng.randint(14, 22))]
        return out

    items, docs = [], []
    for i in range(25):
        out = sentence()
        items.append((i, " ".join([rng.choice([out[0].capitalize(), out[0]]), *out[1:]])))
        for j in range(3):
            other = [rng.choice(names) if w in names and rng.random() < 0.6 else w for w in out]
            if rng.random() < 0.4:
                other[rng.randrange(len(other))] = "elsewhere"
            docs.append((100 * i + j, " ".join(["so", "they", "said", *other, "."])))
    docs += [(9000 + i, " ".join(sentence())) for i in range(40)]
    want = leak_model(docs, items)
    got = decontam.contaminated(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and 20 < len(want) < 75


def test_decontamination_of_names_of_more_words(spark):
    item = "A train leaves Boston at 40 km per hour and travels 120 km before it meets Alice who walks 41 m"
    other = "x. A train leaves New York at 55 miles per hour and travels 300 miles before it meets Mary Ann who walks 7 feet. ok"
    got = decontam.contaminated(spark.createDataFrame([(1, other), (2, "")], DOC), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert [(r.doc_id, r.coverage) for r in got] == [(1, 1.0)]


def test_decontamination_of_short_items(spark):
    items = [(1, "Which river flows through Paris"), (2, "Mount Everest"), (3, "12 km 7 13 99 15 Alice 4 8 16 23 42"), (4, "Name the largest lake in all of Peru"), (5, "...")]
    docs = [(10, "they asked Which river flows through Paris and left"), (11, "he saw Mount Everest once"), (12, "so 12 km 7 13 99 15 Alice 4 8 16 23 42 it was"), (13, "then Name the largest lake in all of Chile again"), (14, "which river is near Mount Etna"), (15, "12 km 7 13 99 15 Alice 4 8 16 23 43"), (16, "...")]
    got = decontam.contaminated(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(10, 1), (11, 2), (12, 3), (13, 4)] and all(r.coverage == 1 for r in got)


def test_language(spark, edge):
    rng = random.Random(4)
    words = {"aa": ["the", "and", "house", "river"], "bb": ["der", "und", "haus", "fluss"]}
    rows = [(i, " ".join(rng.choice(words[x]) for _ in range(30)), x) for i, x in enumerate(["aa", "bb"] * 60)]
    docs = spark.createDataFrame(rows, DOC + ", lang string")
    model = langid.train(docs.where(~langid.held_out()))
    got = langid.identify(docs, model, langid.held_out()).join(docs.select("doc_id", "lang"), "doc_id").where("extra").collect()
    assert got and all(r.lang_pred == r.lang for r in got)
    odd = {r.doc_id: r for r in langid.identify(edge, model).collect()}
    assert odd[900].lang_pred == odd[901].lang_pred == odd[905].lang_pred == "und" and odd[900].rejected
    assert langid.identify(docs, langid.train(docs.where("false"))).first().lang_pred == "und"
    for m in model.models.values():  # a distribution: all next symbols of a context sum to one
        context = int(m.contexts[3][0]) << langid.BITS
        import numpy as np

        assert abs(np.exp(m.score(context + np.arange(1 << langid.BITS, dtype=np.int32)).astype(float)).sum() - 1) < 1e-3


def test_language_rejects_short_texts_of_others(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rare = spark.createDataFrame([(-1, "zgrzyt brzoza chrzan szczaw", "rare")], DOC + ", lang string")
    model = langid.train(docs.where(~langid.held_out()).select("doc_id", "text", "lang").unionByName(rare))
    short = ["Wczoraj wieczorem poszliśmy razem do starego kina w centrum.", "Eilen illalla menimme yhdessä vanhaan elokuvateatteriin ja", "Dün akşam hep birlikte şehir merkezindeki eski sinemaya git", "Ieri sera siamo andati insieme al vecchio cinema del centro"]
    assert all(model.predict(t)[3] for t in short)
    # "rare" has no out-of-fold row: its limit is finite
    assert set(model.models) - set(model.limits) == {"rare"} and max(model.default) < 6
    held = langid.identify(docs.where(langid.held_out()), model)
    assert held.where("rejected").count() <= 0.01 * held.count()


def test_language_model_is_kneser_ney():
    """Probabilities by the recursive definition over dictionaries of n-grams."""
    import numpy as np

    rng = random.Random(3)
    texts = ["".join(rng.choice("abcab d") for _ in range(rng.randint(1, 40))) for _ in range(30)]
    grams = np.concatenate([langid.grams(langid.encode(t)) for t in texts if t.strip()])
    key, n = np.unique(grams, return_counts=True)
    model = langid.Model.fit(key, n)
    counts = {langid.ORDER: defaultdict(int)}
    for g in grams.tolist():
        counts[langid.ORDER][tuple((g >> langid.BITS * i) & 63 for i in range(langid.ORDER - 1, -1, -1))] += 1
    for k in range(langid.ORDER - 1, 0, -1):  # distinct left extensions
        counts[k] = defaultdict(int)
        for g in counts[k + 1]:
            counts[k][g[1:]] += 1

    def discount(k):
        once, twice = (sum(v == i for v in counts[k].values()) for i in (1, 2))
        return min(max(once / (once + 2 * twice), 0.1), 0.95) if once else 0.5

    def p(g):
        k = len(g)
        if k == 0:
            return 1 / 64
        own = [v for x, v in counts[k].items() if x[:-1] == g[:-1]]
        if not own:
            return p(g[1:])
        d = discount(k)
        return max(counts[k].get(g, 0) - d, 0) / sum(own) + d * len(own) / sum(own) * p(g[1:])

    some = rng.sample(key.tolist(), 60) + [rng.randrange(1 << 24) for _ in range(60)]
    got = model.score(np.array(some, np.int32))
    want = [math.log(p(tuple((g >> langid.BITS * i) & 63 for i in range(3, -1, -1)))) for g in some]
    assert np.abs(got - np.array(want)).max() < 1e-4


def test_language_of_nothing(spark):
    docs = spark.createDataFrame([(i, f"the house by the river {i}", "aa", 1) for i in range(12)], DOC + ", lang string, nats int")
    model = langid.train(docs)
    assert langid.identify(docs.where("false"), model).count() == 0 == langid.keep_identified(docs.where("false"), model).count()
    kept = langid.keep_identified(docs.unionByName(docs).unionByName(spark.createDataFrame([(None, None, None, None), (99, "", None, 1), (98, "12 34", None, 1)], docs.schema)), model)
    assert kept.columns == docs.columns and kept.count() == 24


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_model(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            double = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
            ok = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),  # noqa: B023
                "card": lambda: 13 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in double) % 10 == 0,  # noqa: B023
                "phone": lambda: 9 <= len(digits) <= 15,  # noqa: B023
            }[kind]()
            out += [(kind, *m.span())] if ok else []
    return out


def test_pii_base_is_the_patterns():
    rng = random.Random(7)
    for _ in range(4000):
        t = "".join(rng.choice(["a", "@", ".", "b.c", "_", "%", "1", "23", "255", " ", "-", "+", "(", ")", "4111 1111 1111 1111", "😀", "é"]) for _ in range(rng.randint(1, 30)))
        assert pii.base_spans(t) == base_model(t), t


def test_pii_outside_and_long_texts(spark):
    rng = random.Random(3)
    for _ in range(500):
        spans = [("email", a, a + rng.randint(1, 6)) for a in rng.choices(range(40), k=rng.randint(0, 6))]
        free = pii._outside(spans)
        for a in range(45):
            b = a + rng.randint(1, 5)
            assert free(a, b) == all(b <= p or a >= q for _, p, q in spans)
    text = "write to a@b.test or call now " * 20_000 + " " * 2_000_000 + "+49 171 2345678"
    got = pii.find(spark.createDataFrame([(1, text), (2, "x")], DOC)).orderBy("doc_id").collect()
    assert [(r.n_email, r.n_phone) for r in got] == [(20_000, 1), (0, 0)]


def told_model(rows):
    """Spans of the terms that disclose an entity, by the definition and over all documents."""
    entity_docs, term_docs, both, near = defaultdict(set), defaultdict(set), defaultdict(set), []
    for i, (_, text) in enumerate(rows):
        words = [m.span() for m in re.finditer("[0-9A-Za-z]+", text)]
        for a, b in words:
            term_docs[text[a:b].lower()].add(i)
        spans = base_model(text)
        for kind, a, b in spans:
            entity_docs[kind, text[a:b]].add(i)
            for x, y in [w for w in words if w[1] <= a][-6:] + [w for w in words if w[0] >= b][:6]:
                if y - x > 2 and not text[x:y].isdigit() and all(y <= p or x >= q for _, p, q in spans):
                    both[kind, text[a:b], text[x:y].lower()].add(i)
                    near.append((i, kind, text[a:b], x, y))
    out = defaultdict(set)
    for i, kind, entity, x, y in near:
        term = rows[i][1][x:y].lower()
        k, e, t, n = len(both[kind, entity, term]), len(entity_docs[kind, entity]), len(term_docs[term]), len(rows)
        if k >= 2 and e < n and math.log(k * n / (t * e)) / math.log(n / e) >= 0.8 - 1e-12:
            out[i].add((x, y))
    return {i: ",".join([f"{k}:{a}:{b}" for k, a, b in base_model(t)] + [f"term:{a}:{b}" for a, b in sorted(out[i])]) for i, (_, t) in enumerate(rows)}


@pytest.mark.parametrize("held", [1 << 20, 3])
def test_pii_terms_are_the_definition(spark, monkeypatch, held):
    monkeypatch.setattr(pii, "TASK_TERMS", held)
    rng = random.Random(11)
    words = [f"{c}{d}word" for c in "abcdefgh" for d in "abcdefgh"]
    people = [f"p{i}@mail.test" for i in range(12)]
    rows = []
    for i in range(150):
        who = rng.randrange(40)
        text = rng.choices(words, k=rng.randint(0, 25))
        if who < 12:
            text[len(text) // 2 : len(text) // 2] = [f"nick{who}" if rng.random() < 0.7 else "nobody", people[who], rng.choice(["hello", "203.0.113.9"])]
        rows.append((i, " ".join(text)))
    got = {r.doc_id: r.spans for r in pii.find(spark.createDataFrame(rows, DOC)).collect()}
    want = told_model(rows)
    assert got == want and sum("term" in x for x in want.values()) > 10


def test_pii_terms(spark, edge):
    rows = [(i, f"call zorblax agent at bob{i % 3}@mail.test today please") for i in range(3)] * 2 + [(10 + i, f"please call agent number {i} today at noon") for i in range(30)]
    got = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, DOC)).collect()}
    assert "term" not in got[12].spans and got[0].n_email == 1 and got[0].spans.startswith("email:22:36")
    docs = spark.createDataFrame([(i, "meet zorblax near bob@mail.test") for i in range(2)] + [(5 + i, "meet near the lake") for i in range(20)], DOC)
    spans = pii.find(docs)
    assert "term:5:12" in {r.doc_id: r.spans for r in spans.collect()}[0] and pii.find(edge).count() == edge.count()
    assert {r.doc_id: r.text for r in pii.sanitise(docs).collect()}[0].startswith("meet <...> near <EMAIL>")


def test_pii_terms_anywhere_in_the_document(spark):
    far = " and then a long walk by the lake on that day came to its end "
    rows = [(0, f"zorblax wrote from bob@mail.test{far}so zorblax left"), (1, f"bob@mail.test{far}until zorblax came")]
    docs = spark.createDataFrame(rows + [(5 + i, f"meet at noon{far}number {i}") for i in range(20)], DOC)
    got = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert "zorblax" not in got[0] + got[1] and got[0].count("<...>") >= 2 and got[5].startswith("meet at noon")


def test_pii_terms_belong_to_the_text(spark):
    """Rows that repeat a doc_id, or have none, get the terms of their own text."""
    rows = [(1, "meet zorblax near bob@mail.test"), (1, "meet harbour near amy@mail.test"), (2, "meet zorblax near bob@mail.test"), (None, "meet zorblax near bob@mail.test now")]
    docs = spark.createDataFrame(rows + [(5 + i, "meet near the lake or the harbour") for i in range(30)], DOC)
    found = pii.find(docs).collect()
    assert sorted(r.spans for r in found if r.doc_id == 1) == ["email:18:31", "email:18:31,term:5:12"]
    assert [r.spans for r in found if r.doc_id is None] == ["email:18:31,term:5:12"]
    clean = sorted(r.text for r in pii.sanitise(docs).where("doc_id = 1 or doc_id is null").collect())
    assert clean == ["meet <...> near <EMAIL>", "meet <...> near <EMAIL> now", "meet harbour near <EMAIL>"]


def test_warc_round_trip(spark, tmp_path):
    big = "é" * 700
    rows = [(i, f"http://a.test/{i % 7}", big if i % 3 == 0 else f"<p>{i}</p>\r\n\r\n") for i in range(60)] + [(100, None, None), (101, "http://b.test/ü x", ""), (None, "http://c.test", big)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, shard int")
    target = f"file://{tmp_path}/w"
    files = warc.write(pages, target, roll_bytes=2000, shard_bytes=20_000).collect()
    assert len(files) > 3 and len(list((tmp_path / "w").glob("*.warc.gz"))) == len(files) and not list((tmp_path / "w").glob("_temp*"))
    got = {r.page_id: r for r in warc.read(spark, target).collect()}
    assert len(got) == len(rows)
    for page, _, html in rows:
        r = got[page]
        data = (html or "").encode()
        assert (r.payload_digest, r.payload_bytes) == (hashlib.sha1(data).hexdigest(), len(data))
        revisit = page is not None and html == big and page != 57
        assert (r.record_type, r.refers_to) == (("revisit", 57) if revisit else ("response", None))
        assert revisit or r.html == (html or "")
    first = {f.name: f.read_bytes() for f in (tmp_path / "w").glob("*.gz")}
    warc.write(pages.repartition(5), f"file://{tmp_path}/again", roll_bytes=2000, shard_bytes=20_000)
    assert first == {f.name: f.read_bytes() for f in (tmp_path / "again").glob("*.gz")}
    with pytest.raises(FileExistsError):
        warc.write(pages, target)
    with pytest.raises(FileNotFoundError):
        warc.read(spark, f"file://{tmp_path}/none")


def test_warc_of_nothing_repeats_and_long_payloads(spark, tmp_path):
    schema = "page_id long, url string, html string, shard int"
    empty = f"file://{tmp_path}/empty"
    assert warc.write(spark.createDataFrame([], schema), empty).count() == warc.read(spark, empty).count() == 0
    long = "<p>wörd</p>" * 400_000
    rows = [(1, "http://a.test", long, 0), (2, None, long, 0), (3, None, "x", 0), (3, None, "x", 0), (3, None, "y" * 2000, 0), (3, None, "y" * 2000, 0), (None, None, None, 0), (None, None, None, 0)]
    target = f"file://{tmp_path}/w"
    warc.write(spark.createDataFrame(rows, schema), target)
    got = warc.read(spark, target).collect()
    assert sorted((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes) for r in got) == [(0, "response", None, 0)] * 2 + [(1, "revisit", 2, 4_800_000), (2, "response", None, 4_800_000)] + [(3, "response", None, 1)] * 2 + [(3, "response", None, 2000)] * 2


def test_warc_shards_hold_equal_bytes(spark):
    rows = [(f"k{i:05d}", 10_000 if i % 100 == 0 else 100) for i in range(5000)] + [("k00100", 100)] * 500
    cuts = warc.bounds(spark.createDataFrame(rows, "key string, size long"), 200_000)
    share = [sum(n + warc.HEAD_BYTES for k, n in rows if lo <= k < hi) for lo, hi in zip(["", *cuts], [*cuts, "z"], strict=True)]
    assert len(cuts) >= 10 and max(share) < 2.5 * sum(share) / len(share)


def rule_model(url):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fit = [(len(r), r, v) for r, v in url_filters.RULES for h, _, p in [r.partition("/")] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return host, path, max(fit)[1] if fit else None, max(fit)[2] if fit else None


def test_url_filters(spark):
    urls = [None, "", "no scheme", "http://A.net/x", "http://net/", "http://net", "https://m.Example.NET/en/1?q#f", "http://x.org/fr/2", "http://example.com/de/", "http://a.example.com/de?x", "http://xnet/", "a://b://c/d", "http://h?x/y", "http://u.test#/z", "https://www.casino-win.example.org/en/14", "http://poker-dice.test/en/9", "http://library.test/en/9"]
    pages = spark.createDataFrame([(i, u, 0) for i, u in enumerate(urls)], "page_id long, url string, host int")
    got = {r.page_id: r for r in url_filters.judge(pages, url_filters.seed_table(spark)).collect()}
    for i, u in enumerate(urls):
        host, path, rule, verdict = rule_model(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule) and got[i].verdict == (verdict or got[i].verdict)
    assert got[15].verdict == "block" and got[16].verdict == "allow"


def test_url_table_holds_no_part_of_a_judged_host(spark):
    words = {w for kinds in (url_filters.BLOCKED, url_filters.ALLOWED) for w in " ".join(kinds.values()).split()}
    hosts = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").unionByName(spark.read.parquet("/root/testdata/sf0.1/pages.parquet")).select(url_filters.host(F.col("url")).alias("h")).distinct()
    parts = {x for r in hosts.collect() for x in re.split(r"[^a-z0-9]+", r.h)}
    assert len(parts) > 60 and not words & parts


def verdicts_model(spark, pages, table):
    """The model and its probabilities again, with numpy: n-grams cut here, gradient steps over dense rows."""
    def parts(url):
        rest = (url or "").split("://", 1)[1] if "://" in (url or "") else ""
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in host) + re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]

    def cut(text):
        t = "^" + re.sub("[1-9]", "0", text) + "$"
        return [t[i : i + n] for n in url_filters.SIZES for i in range(max(len(t) - n + 1, 1))]

    rows = [(parts(r.url), r.blocked) for r in table.collect()]
    every = sorted({g for t, _ in rows for g in cut(t)} | {g for u in pages.values() for g in cut(parts(u))})
    at = {r.g: r.k for r in spark.createDataFrame([(g,) for g in every], "g string").select("g", F.pmod(F.xxhash64("g"), F.lit(url_filters.BUCKETS)).alias("k")).collect()}

    def vector(text):
        v = np.zeros(url_filters.BUCKETS)
        for g in cut(text):
            v[at[g]] += 1
        return v / np.sqrt(len(cut(text)))

    used = sorted(set(at.values()))
    x, y = np.array([vector(t)[used] for t, _ in rows]), np.array([b for _, b in rows])
    share = 1 / (2 * np.bincount(y)[y])
    w, b = np.zeros(len(used)), 0.0
    seen = x.any(0)
    for _ in range(250):
        r = (y - 1 / (1 + np.exp(-(x @ w + b)))) * share
        w += 20.0 * (x.T @ r - 1e-5 * w) * seen
        b += 20.0 * r.sum()
    return {k: 1 / (1 + np.exp(-(vector(parts(u))[used] @ w + b))) for k, u in pages.items()}


def test_url_verdicts_are_the_model_s(spark):
    table = url_filters.seed_table(spark).where("size(words) = 2")
    found = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url").collect()
    pages = {r.page_id: r.url for r in found[:60]} | {10_000: "http://poker-dice.test/", 10_001: "http://mountain.test/river", 10_002: "https://a.b/" + "slots/" * 50}
    want = verdicts_model(spark, pages, table)
    got = {r.page_id: r for r in url_filters.judge(spark.createDataFrame(list(pages.items()), "page_id long, url string"), table).collect()}
    for k, r in got.items():
        if r.rule is None:
            assert abs(r.p_block - want[k]) < 2e-3 and (abs(want[k] - 0.5) < 2e-3 or r.verdict == ("block" if want[k] >= 0.5 else "allow"))
    assert got[10_000].verdict == "block" and got[10_001].verdict == "allow"


def test_url_filters_on_unseen_words(spark):
    """Words dealt in fifths: a name is judged by a model that has seen none of its words, and false blocks are few. README has the shares."""
    table = url_filters.seed_table(spark).cache()
    fold = lambda w: F.pmod(F.xxhash64(w), F.lit(5))
    found = {0: [0, 0], 1: [0, 0]}
    for k in range(5):
        within, without = F.forall("words", lambda w: fold(w) == k), F.forall("words", lambda w: fold(w) != k)  # noqa: B023
        model = url_filters.train(table.where(without).select("url", "blocked"))
        text = F.concat(url_filters.host(F.col("url")), url_filters.path(F.col("url")))
        for r in url_filters.with_grams(table.where(within), text).select("blocked", (url_filters.probability(F.col("__grams"), model) >= 0.5).alias("said")).groupBy("blocked", "said").count().collect():
            found[r.blocked][int(r.said == (r.blocked == 1))] += r["count"]
    print("unseen words", found)
    bad, good = found[0]
    assert good / (bad + good) >= 0.5 and sum(found[1]) > 100


def test_url_filters_of_odd_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.test/" + "x" * 100_000, "h"), (1, "http://a.test/", "h"), (1, "http://a.test/", "h"), (None, None, "h")], "page_id long, url string, host string")
    model = url_filters.seed_table(spark)
    got = url_filters.judge(pages, model).collect()
    assert len(got) == 4 and {r.host for r in got} == {"a.test", ""} and url_filters.judge(pages.where("false"), model).count() == 0
    assert {r.verdict for r in url_filters.judge(pages, model.where("false")).collect()} <= {"allow", "block"}


def test_decontamination_of_odd_tables(spark, edge):
    items = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog near the old bank of a river"), (2, None), (None, "a b"), (3, "")], "item_id long, text string")
    long = "word " * 300_000 + "the quick brown fox jumps over the lazy dog near the old bank of a river"
    docs = edge.unionByName(spark.createDataFrame([(7, long, 1, "k"), (8, "the quick brown fox", 1, "k")], edge.schema))
    assert [(r.doc_id, r.item_id) for r in decontam.contaminated(docs, items).collect()] == [(7, 1)]
    kept = decontam.decontaminate(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 1
    assert decontam.contaminated(docs.where("false"), items).count() == 0 == decontam.contaminated(docs, items.where("false")).count()


def test_exact_stage_keeps_other_texts_of_an_id(spark):
    rows = [(1, "a b c"), (1, "other words"), (2, "ab c  "), (3, "abc"), (None, "abc"), (None, None), (4, None), (5, "")]
    kept = exact_dedup.unique(spark.createDataFrame([(*r, 1) for r in rows], DOC + ", __id int"))
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, ""), (0, "abc"), (1, "other words"), (2, "ab c  "), (4, "")]


def test_scratch_tables(spark):
    from quarry.llm import _shared

    before = {k: spark.conf.get(k, None) for k in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")}
    one, two = (_shared.saved(spark.range(3), "t") for _ in range(2))
    assert before == {k: spark.conf.get(k, None) for k in before} and one.count() == two.count() == 3
    _shared.forget(one)
    assert _shared.tidy(spark) >= 1 and _shared.tidy(spark) == 0


def test_toxicity_held_out(spark, edge):
    rng = random.Random(9)
    rows = [(i, " ".join([f"w{rng.randrange(3000)}" for _ in range(40)] + (["idiot", "scum"][: 1 + i % 2] if i % 5 == 0 else []))) for i in range(900)]
    docs = spark.createDataFrame(rows, DOC)
    labels = spark.createDataFrame([(i, int(i % 5 == 0), 1) for i in range(600)] + [(3, None, 1), (None, 1, 1)], "doc_id long, toxic int, quality int")
    got = {r.doc_id: r.toxic for r in toxicity.toxicity(docs, labels).collect()}
    assert all(got[i] == (i % 5 == 0) for i in range(600, 900))
    assert not any(r.toxic for r in toxicity.toxicity(edge, labels.where("false")).collect())


def plain_features(text):
    """Words and their beginnings, lower-cased, as strings."""
    out = set()
    for w in re.findall(rb"[0-9A-Za-z\x80-\xff]+", (text or "").encode()):
        w = bytes(c + 32 if 65 <= c <= 90 else c for c in w)
        out |= {("w", w)} | {("b", w[:n]) for n in toxicity.BEGINNINGS if len(w) > n}
    return out


def test_toxicity_is_the_definition(spark):
    """Features, out-of-fold carry and probabilities by a plain dense Newton fit on string features."""
    import numpy as np

    from quarry.llm import _bytes

    rng = random.Random(12)
    rows, labels = [], []
    for i in range(500):
        bad, poor = i % 6 == 0, i % 4 == 0
        w = [f"w{rng.randrange(4000)}x" for _ in range(30)] + ["gruntword"] * (bad and rng.random() < 0.8) + ["menu", "cookie"] * (poor and rng.random() < 0.7)
        rng.shuffle(w)
        rows.append((i, " ".join(w)))
        labels.append((i, None if i % 37 == 0 else int(not poor), None if i % 41 == 0 else int(bad)))
    docs, marks = spark.createDataFrame(rows, DOC), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    y = {"low_quality": np.array([np.nan if q is None else 1.0 - q for _, q, _ in labels]), "toxic": np.array([np.nan if t is None else float(t) for _, _, t in labels])}
    every = [plain_features(t) for _, t in rows]
    names = set()
    for v in y.values():
        known, share = ~np.isnan(v), np.nanmean(v)
        n, hits = defaultdict(int), defaultdict(float)
        for fs, k, value in zip(every, known, v, strict=True):
            for f in fs if k else ():
                n[f] += 1
                hits[f] += value
        names |= {f for f in n if n[f] >= toxicity.LEAST_DOCS and (hits[f] - n[f] * share) / math.sqrt(n[f] * share * (1 - share)) >= toxicity.LIFT}
    names = sorted(names)
    x = np.array([[f in fs for f in names] for fs in every], float)
    fold = (_bytes.mix(np.arange(500, dtype=np.uint64)) % np.uint64(toxicity.FOLDS)).astype(int)

    def newton(a, b):
        a = np.column_stack([a, np.ones(len(a))])
        ridge = np.diag([toxicity.RIDGE] * (a.shape[1] - 1) + [1e-3])
        v = np.zeros(a.shape[1])
        for _ in range(60):
            p = 1 / (1 + np.exp(-a @ v))
            v += 0.5 * np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + ridge, a.T @ (b - p) - ridge @ v)
        return lambda z: 1 / (1 + np.exp(-np.column_stack([z, np.ones(len(z))]) @ v))

    seen = predicted = x
    want = {}
    for name, v in y.items():
        known = ~np.isnan(v)
        whole = newton(seen[known], v[known])
        want[name] = whole(predicted)
        held = whole(seen)
        for k in range(toxicity.FOLDS):
            own, test = known & (fold != k), known & (fold == k)
            held[test] = newton(seen[own], v[own])(seen[test])
        seen, predicted = np.column_stack([seen, held]), np.column_stack([predicted, want[name]])
    got = {r.doc_id: r for r in toxicity.toxicity(docs, marks).collect()}
    assert len(names) >= 4 and all(abs(got[i].p_low_quality - want["low_quality"][i]) < 1e-4 and abs(got[i].p_toxic - want["toxic"][i]) < 1e-4 for i in range(500))


def test_toxicity_of_odd_rows(spark, edge):
    """A fitted chain scores nulls, repeats and long texts; a doc_id that repeats with labels teaches once."""
    rows = [(i, "idiot " + " ".join(f"q{i * 40 + j}" for j in range(30)) if i % 3 == 0 else " ".join(f"r{i * 40 + j}" for j in range(30))) for i in range(120)] + [(0, "zzz")] * 50
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], DOC + ", h int, slice string").unionByName(edge)
    labels = spark.createDataFrame([(i, int(i % 3 == 0), 1, None) for i in range(120)] + [(None, 1, 1, None), (900, 1, None, None)], "doc_id long, toxic int, quality int, text string")
    got = toxicity.toxicity(docs, labels)
    seen = got.collect()
    assert len(seen) == docs.count() and got.columns == ["doc_id", "p_low_quality", "p_toxic", "toxic"]
    assert {r.toxic for r in seen if r.doc_id is not None and 0 < r.doc_id < 120 and r.doc_id % 3 == 0} == {True} and not any(r.toxic for r in seen if r.doc_id is None or r.doc_id >= 900)
    assert toxicity.training_rows(docs, labels).count() == 120
    assert toxicity.toxicity(docs.where("false"), labels).count() == 0


def test_edge_rows_survive(spark, edge):
    assert minhash.near_duplicates(edge).count() == exact_dedup.exact_duplicates(edge).count() == edge.count()
    none = edge.where("false")
    assert minhash.near_duplicates(none).count() == exact_dedup.exact_duplicates(none).count() == packing.pack(none).count() == pii.find(none).count() == 0


def test_pipeline_stages(spark):
    """Each stage on what the one before has kept, against brute force, and run() as a whole."""
    import corpus_pipeline

    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    model = langid.train(docs.where(~langid.held_out()))
    known = stage["language ID"](spark, docs, d)
    assert known.columns == docs.columns and {r.doc_id for r in known.collect()} == {r.doc_id for r in docs.collect() if not model.predict(r.text)[3]}
    kept = stage["exact dedup"](spark, known, d)
    groups = defaultdict(list)
    for r in known.collect():
        groups[re.sub(r"[\x20\x09-\x0D]", "", r.text)].append((-len(r.text), r.doc_id))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {min(g)[1] for g in groups.values()}
    near = stage["MinHash near-dedup"](spark, kept, d)
    want = near_model([(r.doc_id, r.text) for r in kept.collect()], 80)
    assert near.columns == docs.columns and {r.doc_id for r in near.collect()} == {i for i, (_, c) in want.items() if i == c}
    clean = stage["benchmark decontamination"](spark, near, d)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    rows = [(r.doc_id, r.text) for r in near.collect()]
    held = {i for i, _ in leak_model(rows, items)}
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {i for i, _ in rows} - held and held
    packed = stage["packing"](spark, clean, d).collect()
    P = pytest.importorskip("public_tokenizers")
    own = token_counts.counter(str(P.path("piece_bpe_32k.model")))
    total = defaultdict(int)
    for r in packed:
        total[r.doc_id] += r.n_tokens
    assert total == {r.doc_id: own.count(r.text) for r in clean.collect()}
    assert {(r.doc_id, r.part, r.n_tokens, r.bucket, r.batch, r.slot) for r in corpus_pipeline.run(spark, d).collect()} == {tuple(r) for r in packed}


def test_pipeline_of_odd_rows(spark, edge, tmp_path):
    """Nulls, repeats, empty and long texts pass the stages by their rules, and so does an empty table."""
    import corpus_pipeline

    rows = [(i, f"the house by the river and the old mill number {i} of the town", "en") for i in range(40)] + [(3, "the house by the river and the old mill number 3 of the town", "en"), (None, "a second house by the lake", None), (50, None, "en"), (51, "", None)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], DOC + ", lang string, n_tokens int").unionByName(edge.select("doc_id", "text", F.lit("en").alias("lang"), F.lit(2).alias("n_tokens")))
    bench = spark.createDataFrame([(1, "nothing of this kind is in any of the documents at all today")], "item_id long, text string")
    for name, some in (("all", docs), ("none", docs.where("false"))):
        some.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        bench.write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
    got = corpus_pipeline.run(spark, f"{tmp_path}/all").collect()
    assert {"doc_id", "part", "n_tokens", "bucket", "batch", "slot"} == set(got[0].asDict()) and not {50, 51, 900, 901} & {r.doc_id for r in got}
