"""Operators 11 to 13 against the library, brute force and a direct reading of their definitions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import bpe, spelling, vector_codes

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = str(public_tokenizers.path("byte_bpe_50k.json"))
DOC = "doc_id long, text string"
EDGE = [(900, None), (901, ""), (902, " \n"), (903, "A  b<|endoftext|> c"), (904, "😀 " * 3000), (905, "x" * 50_000), (906, "<|endo"), (907, "'llᲉ\U000323b1 ٣½ \x1c\x85")]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_bpe_is_the_library(library):
    rng, own = random.Random(5), bpe.codec(PATH, bpe.newer_letters(PATH))
    pool = ["<|endoftext|>", "the", " ", "  ", "\n", "'s", "é", "漢字", "x" * 300, " " * 200, "12", "!!", "Ж", "\U0001f600", "ᲊ", "\x1c", "\x85", "<|endo", "́", "tion", "\r\n"]
    for _ in range(1500):
        text = "".join(rng.choice(pool) if rng.random() < 0.7 else chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0xD800), rng.randrange(0xE000, 0x20000)])) for _ in range(rng.randrange(40)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text).tolist() == ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False) == text
        some = [rng.randrange(50257) for _ in range(9)]
        assert own.decode(some) == library.decode(some, skip_special_tokens=False)


def test_bpe_long_texts_go_in_blocks(library, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK", 7)
    monkeypatch.setattr(bpe, "MEMO", 5)
    text = "It's the 3rd  of\n\n many, many words " * 9 + "<|endoftext|>" + "ab" * 5000
    assert bpe.Codec(bpe.Vocabulary(PATH)).encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_bpe_on_odd_rows(spark, library):
    docs = spark.createDataFrame([(*r, 1) for r in [*EDGE, EDGE[0], EDGE[3], (None, "a b"), (None, None)]], DOC + ", ids int")
    rows = bpe.encode(docs, PATH, decoded=True).collect()
    want = Counter((d, tuple(library.encode(t or "", add_special_tokens=False).ids), t or "") for d, t, _ in docs.collect())
    assert Counter((r.doc_id, tuple(r.ids), r.text) for r in rows) == want
    assert bpe.encode(docs.limit(0), PATH).collect() == []
    back = bpe.decode(spark.createDataFrame([(1, [15496, None, 99999999]), (2, None), (3, [])], "doc_id long, ids array<int>"), PATH)
    assert {r.doc_id: r.text for r in back.collect()} == {1: "Hello", 2: None, 3: ""}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants_model(docs):
    n = Counter()
    for d, t in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 199 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}
    others = {w: [o for o in n if near(w, o)] for w in n}
    best = {w: min(o, key=lambda x: (-n[x], x)) for w, o in others.items() if o}
    form = {w: o for w, o in best.items() if n[o] >= 5 * n[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return {w: (form.get(w), root(w), n[w], len(others[w]), n[form[w]] if w in form else None) for w in n}


@pytest.mark.parametrize("long", [64, 6])
def test_spelling_is_brute_force(spark, monkeypatch, long):
    monkeypatch.setattr(spelling, "LONG", long)  # 6: nearly all words by digests
    rng, docs = random.Random(11), list(EDGE)
    base = ["Weather", "climate", "résumé", "aaaaaaa", "Straße", "ÀÉÎÕÜß"]
    words = {w for b in base for w in [b]}
    for b in base:
        for _ in range(40):
            w = b
            for _ in range(rng.choice([1, 1, 1, 2])):
                i = rng.randrange(len(w) + 1)
                w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("aeéß") + w[i:], w[:i] + rng.choice("aeéß") + w[i + 1 :]])
            words.add(w)
    words = sorted(words)
    weights = [40.0 if w in base else rng.choice([0.3, 1.0, 6.0]) for w in words]
    docs += [(i, " ".join(rng.choices(words, weights, k=rng.randrange(400)))) for i in range(60)]
    docs += [docs[-1], (None, docs[-2][1]), *[(990 + i, "y" * 1500 + " " + "y" * 700 + "z" + "y" * 799) for i in range(6)], *[(1000 + i, "y" * 1500) for i in range(40)]]
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(spark.createDataFrame([(*d, "k", 1) for d in docs], DOC + ", word string, n int")).collect()}
    want = variants_model(docs)
    assert got == want
    assert sum(1 for x in want.values() if x[0]) > 20 and any(x[0] and x[0] != x[1] for x in want.values())


def test_spelling_of_nothing(spark):
    assert spelling.variants(spark.createDataFrame([], DOC)).collect() == []
    assert spelling.variants(spark.createDataFrame([(1, None), (2, "short words alone")], DOC)).collect() == []
    with pytest.raises(ValueError, match="frequent"):
        spelling.variants(spark.createDataFrame([], DOC), ratio=1)


def codes_model(rows, parts=16, entries=64):
    kept = sorted((i, [int(np.floor(256 * float(x))) for x in v], l) for i, v, l in rows)
    w = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * w : (p + 1) * w]
    book = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]

    def assign():
        d = [[[sum((a - b) ** 2 for a, b in zip(cut(v, p), e, strict=True)) for e in book[p]] for p in range(parts)] for _, v, _ in kept]
        return [[min(range(len(x)), key=lambda k, x=x: (x[k], k)) for x in r] for r in d], [sum(min(x) for x in r) for r in d]

    for _ in range(2):
        codes, _ = assign()
        for p in range(parts):
            for e in range(len(book[p])):
                own = [cut(v, p) for (_, v, _), c in zip(kept, codes, strict=True) if c[p] == e]
                if own:
                    book[p][e] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    codes, errors = assign()
    by = Counter()
    for (_, _, label), e in zip(kept, errors, strict=True):
        by[label] += e
    sha = hashlib.sha256(",".join(str(c) for p in book for e in p for c in e).encode()).hexdigest()
    return {i: ("".join(f"{c:02x}" for c in code), e, by[label]) for (i, _, label), code, e in zip(kept, codes, errors, strict=True)}, sha


@pytest.mark.parametrize("entries", [64, 7])
def test_vector_codes_are_brute_force(spark, entries):
    rng = random.Random(2)
    rows = [(i, [rng.choice([0.0, 0.25, -0.5, rng.gauss(0, 1)]) for _ in range(32)], rng.choice([1, 2, None])) for i in range(150)]
    rows += [(200 + i, list(rows[3][1]), 1) for i in range(50)] + [(300, [1000.0] * 32, 2), (301, [-1e5] * 32, None)]
    odd = [(-5, None, 1), (-4, [], 1), (-3, [1.0] * 31 + [None], 1), (-2, [float("nan")] * 32, 1), (-1, [float("-inf")] * 32, 2), (-6, [1.0] * 16, 1), (-7, [1.0] * 33, 2), (-8, [1e30] * 32, 2)]
    df = spark.createDataFrame([(*r, "k", b"") for r in rows + odd], "vec_id long, embedding array<double>, label int, v string, code binary").repartition(5)
    codes, book = vector_codes.compress(df, entries=entries)
    got = {r.vec_id: (r.code.hex(), r.error, r.label_error) for r in vector_codes.with_label_error(codes).collect()}
    want, sha = codes_model(rows, entries=entries)
    assert got == want
    assert vector_codes.digest(book) == sha


def test_vector_search_is_bounded_and_exact():
    rng = np.random.default_rng(1)
    entries, x = rng.integers(-300, 300, (64, 4)), rng.integers(-300, 300, (3000, 4))
    entries[9] = entries[5]
    book = vector_codes.Book(entries)
    every = ((x[:, None] - entries[None]) ** 2).sum(2)
    want = every.argmin(1)
    cold, d, _ = book.nearest(x, np.zeros(3000, np.int64))
    warm, d2, taken = book.nearest(x, np.where(rng.random(3000) < 0.9, want, 9))
    assert (cold == want).all() and (warm == want).all() and (d == every.min(1)).all() and (d2 == d).all()
    assert taken < 3000 * 64 / 2


def test_vector_codes_of_nothing_and_repeats(spark):
    schema = "vec_id long, embedding array<float>, label int"
    for rows in ([], [(1, None, 1)], [(1, [1.0] * 5, 1)], [(None, [1.0] * 16, 1)]):
        codes, book = vector_codes.compress(spark.createDataFrame(rows, schema))
        assert vector_codes.with_label_error(codes).collect() == [] and len(book) == 0
    rows = [(1, [float(i)] * 16, None) for i in range(3)] * 2 + [(None, [0.0] * 16, 3)]
    codes, book = vector_codes.compress(spark.createDataFrame(rows, schema))
    out = vector_codes.with_label_error(codes).collect()
    assert len(out) == 7 and {r.error for r in out} == {0} and len(book) == 6
    restored = {(r.vec_id, tuple(r.embedding)) for r in vector_codes.restored(codes, book).collect()}
    assert restored == {(1, (i + 0.5 / 256,) * 16) for i in range(3)} | {(None, (0.5 / 256,) * 16)}


def test_label_sums_survive_many_labels(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "MOST_LABELS", 1)
    codes = spark.createDataFrame([(1, 5, 3), (2, 5, 4), (3, None, 7), (4, None, 1)], "vec_id long, label int, error long").withColumn("code", F.lit(b"a"))
    assert {r.vec_id: r.label_error for r in vector_codes.with_label_error(codes).collect()} == {1: 7, 2: 7, 3: 8, 4: 8}
