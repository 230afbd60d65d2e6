"""Byte-level BPE: exact encoding by a table of last tokens, and decoding (operator 11).

By the locality of BPE a sequence of tokens is an encoding exactly if every adjacent pair is the encoding of its own
bytes, so each prefix of a word has one last token: the longest vocabulary token that ends there and may follow the last
token of what comes before it. An automaton with suffix links over the vocabulary lists the tokens that end at a place,
longest first; pairs are tested once and kept. Following the last tokens back from the end gives the ids.

Scale: one map-side pass, no shuffle. Tables are bounded; a word, however long, takes a number for each of its bytes.
"""

from __future__ import annotations

import itertools
import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm._shared import released

#: Splits a text before the merges (a fixed value of the vocabulary).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for a text of ASCII alone.
ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"
#: Entries that a worker keeps of words, in two generations, and of pairs; a full table is begun anew.
MEMO, PAIRS = 300_000, 1_000_000
#: Words that are held at once of a long text.
BLOCK = 1 << 17
_NEVER = 1 << 62
_SYMBOL = "§"


@lru_cache(1)
def byte_chars() -> str:
    """The character that stands for each byte in a byte-level vocabulary: itself if it is visible, else the next from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = itertools.count(0x100)
    return "".join(chr(b if b in visible else next(rest)) for b in range(256))


class Vocabulary:
    """Ids of a byte-level BPE vocabulary, its merges by priority, and its added tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        model, before = whole["model"], whole.get("pre_tokenizer") or {}
        if model["type"] != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or whole.get("normalizer") or model.get("ignore_merges"):
            raise ValueError(f"{path} isn't a plain byte-level BPE vocabulary")
        self.ids: dict[str, int] = model["vocab"]
        self.ranks = {tuple(m.split(" ") if isinstance(m, str) else m): n for n, m in enumerate(model["merges"])}
        self.added = {a["content"]: a["id"] for a in whole.get("added_tokens") or ()}
        if any(a["single_word"] or a["lstrip"] or a["rstrip"] or a["normalized"] for a in whole.get("added_tokens") or ()):
            raise ValueError("added tokens must stand for exactly their text")
        chars = byte_chars()
        if missing := [b for b in range(256) if chars[b] not in self.ids]:
            raise ValueError(f"the vocabulary lacks bytes {missing}")
        self.of_byte = {b: c for b, c in enumerate(chars)}
        to_byte = {c: b for b, c in enumerate(chars)}
        self.bytes = {i: bytes(to_byte[c] for c in t) if all(c in to_byte for c in t) else t.encode() for t, i in (self.ids | self.added).items()}


class Codec(dict):
    """Words -> ids, as the bytes of int32. A word is looked up, or encoded by the table of last tokens and kept."""

    def __init__(self, vocabulary: Vocabulary, newer: frozenset[int] = frozenset()):
        super().__init__()
        self.v = vocabulary
        self.tokens = ahocorasick.Automaton()
        self.size: dict[int, int] = {}
        self.text: dict[int, str] = {}
        for t, i in vocabulary.ids.items():
            if self.merged(t) == [t]:  # others are never made
                self.tokens.add_word(t, i)
                self.size[i], self.text[i] = len(t), t
        self.tokens.make_automaton()
        self.inside = {t[i : i + 2] for t in vocabulary.ids for i in range(len(t) - 1)}
        self.pairs: dict[int, bool] = {}
        self.older: dict[str, bytes] = {}
        self.split, self.split_ascii = regex.compile(PATTERN), re.compile(ASCII_PATTERN, re.ASCII)
        self.special = re.compile("|".join(re.escape(t) for t in sorted(vocabulary.added, key=len, reverse=True))) if vocabulary.added else None
        self.newer, self.newer_chars = dict.fromkeys(newer, _SYMBOL), frozenset(map(chr, newer))

    def merged(self, text: str) -> list[str]:
        """Encoding of a token or a pair of tokens by the merges themselves."""
        parts, rank = list(text), self.v.ranks.get
        order = [rank(p, _NEVER) for p in itertools.pairwise(parts)]
        while order and (best := min(order)) != _NEVER:
            i = order.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del order[i]
            if i:
                order[i - 1] = rank((parts[i - 1], parts[i]), _NEVER)
            if i < len(order):
                order[i] = rank((parts[i], parts[i + 1]), _NEVER)
        return parts

    def follows(self, a: int, b: int) -> bool:
        """Whether token b may stand after token a; kept for the next time."""
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        x, y = self.text[a], self.text[b]
        ok = self.pairs[a << 32 | b] = x[-1] + y[0] not in self.inside or self.merged(x + y) == [x, y]
        return ok

    def encode_word(self, word: str) -> bytes:
        if word.isascii() and word.isprintable():  # of these only the space stands for another character
            s = word.replace(" ", self.v.of_byte[32])
        else:
            s = word.encode().decode("latin-1").translate(self.v.of_byte)
        if (whole := self.tokens.get(s, None)) is not None:
            return whole.to_bytes(4, "little")
        last, size, known = [-1] * (len(s) + 1), self.size, self.pairs  # the last token of each prefix
        for end, token in self.tokens.iter(s):  # at each place the longest token first
            end += 1
            if last[end] < 0:
                if at := end - size[token]:
                    before = last[at]
                    if (ok := known.get(before << 32 | token)) is None:
                        ok = self.follows(before, token)
                    if not ok:
                        continue
                last[end] = token
        out, i = [], len(s)
        while i:
            out.append(last[i])
            i -= size[last[i]]
        out.reverse()
        return array("i", out).tobytes()

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word) or self.encode_word(word)
        if len(word) <= 64:
            if len(self) >= MEMO:  # what is still in use comes back from here
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def words(self, text: str) -> Iterator[list[str]]:
        """Blocks of the words of a text without added tokens."""
        ascii_only = text.isascii()
        if not ascii_only and not self.newer_chars.isdisjoint(text):  # spans of the text with stand-ins
            found = (text[m.start() : m.end()] for m in self.split.finditer(text.translate(self.newer)))
        else:
            split = self.split_ascii if ascii_only else self.split
            if len(text) <= BLOCK:
                yield split.findall(text)
                return
            found = (m.group() for m in split.finditer(text))
        while block := list(itertools.islice(found, BLOCK)):
            yield block

    def plain(self, text: str) -> bytes:
        get = self.__getitem__
        return b"".join(b"".join(map(get, block)) for block in self.words(text))

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text; added tokens inside it are their own ids. None: as empty."""
        text = text or ""
        if not self.special or not self.special.search(text):
            return np.frombuffer(self.plain(text), np.int32)
        parts, at = [], 0
        for m in self.special.finditer(text):
            parts += [self.plain(text[at : m.start()]), self.v.added[m.group()].to_bytes(4, "little")]
            at = m.end()
        return np.frombuffer(b"".join([*parts, self.plain(text[at:])]), np.int32)

    def decode(self, ids: Iterable[int | None]) -> str:
        """The text of ids; unknown ones and nulls give nothing, bytes that are no UTF-8 become U+FFFD."""
        table = self.v.bytes
        try:
            whole = b"".join(map(table.__getitem__, ids))
        except KeyError:
            whole = b"".join(table.get(i, b"") for i in ids)
        return whole.decode("utf-8", "replace")


@lru_cache(1)
def newer_letters(path: str) -> frozenset[int]:
    """Letters and numbers of this regex library's Unicode version that the vocabulary's own library doesn't know as such yet.

    Only characters in which Python's Unicode version and the regex library's differ are asked about.
    """
    from tokenizers import Tokenizer

    known, kinds = Tokenizer.from_file(path).pre_tokenizer, {"L": ("a", regex.compile(r"\p{L}")), "N": ("1", regex.compile(r"\p{N}"))}
    out = set()
    for c in map(chr, itertools.chain(range(0xD800), range(0xE000, 0x110000))):
        own = unicodedata.category(c)[0]
        for kind, (before, is_kind) in kinds.items():
            if own != kind and is_kind.match(c) and len(known.pre_tokenize_str(before + c)) > 1:
                out.add(ord(c))
    return frozenset(out)


@lru_cache(1)
def codec(path: str, newer: frozenset[int]) -> Codec:
    """One per Python worker."""
    return Codec(Vocabulary(path), newer)


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    at = np.zeros(len(ids) + 1, np.int32)
    np.cumsum([len(x) for x in ids], out=at[1:])
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32)))


def _docs(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def encode(docs: DataFrame, path: str, decoded: bool = False) -> DataFrame:
    """Token ids of every whole text: doc_id, ids (array of int); with ``decoded`` also text, what the ids decode to.

    ``path`` is the vocabulary file, which every executor must have. No tokens are put before or after a text; an added
    token's string inside one is that token. Null and empty texts: no ids, the empty text. Rows are independent: repeated
    rows, and rows without doc_id, give their own rows; columns besides doc_id and text are not looked at. An empty table
    gives an empty result.
    """
    newer = newer_letters(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, newer)
        for batch in batches:
            ids = [own.encode(t) for t in batch.column(1).to_pylist()]
            columns = {"doc_id": batch.column(0), "ids": _lists(ids)}
            if decoded:
                columns["text"] = pa.array([own.decode(x.tolist()) for x in ids], pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return _docs(docs).mapInArrow(released(run), "doc_id bigint, ids array<int>" + ", text string" * decoded)


def decode(rows: DataFrame, path: str) -> DataFrame:
    """The text of each row's ids: doc_id, text. Null ids: null; unknown and null ids in a list give nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, frozenset())
        for batch in batches:
            texts = [None if x is None else own.decode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(released(run), "doc_id bigint, text string")
