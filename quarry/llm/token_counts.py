"""Token counts by a compiled finite-state transducer (operator 2).

The merge rules of a BPE vocabulary become a deterministic transducer whose transitions carry the number of tokens they
add. A state holds what can still matter: the longest suffix that begins some vocabulary piece, and for each cut inside
it the last token before the cut and the count there. By the locality of BPE a token sequence is the encoding exactly if
every adjacent pair is the encoding of its own text, so the last token at every position follows from the state.
States are made when first reached. Texts are cut into chunks; a chunk's state map (what it does to any incoming state)
is its head up to the first point that forgets the past, the count from there, and its tail; maps compose associatively
and are combined by a prefix scan over chunks.

Scale: one map-side pass, no shuffle; tables and memo are bounded and rebuilt when full.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
CHUNK = 1 << 16
#: Entries that a worker keeps of words, and of transitions and of pairs of tokens each; a full table is begun anew.
MEMO, TRANSITIONS = 1_000_000, 1_000_000
LIMIT = 4096
_NEVER = 1 << 62
_SYNC = re.compile(f"(?<=[^{SPACE}]){SPACE}")


class Transducer:
    """Counts tokens as the piece model of ``ranks`` (piece -> merge priority, lower first) with byte fallback encodes."""

    def __init__(self, ranks: dict[str, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks), default=1)
        self.prefixes = {p[:i] for p in ranks for i in range(1, len(p))}
        self.inside = {p[i : i + 2] for p in ranks for i in range(len(p) - 1)}
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in ranks):
            raise ValueError("a piece goes on after a word's end: chunks would have no point that forgets the past")
        self.pairs: dict[tuple[str, str], bool] = {}
        self.proper: dict[str, bool] = {}
        self.clear()

    def clear(self) -> None:
        self.states: dict[tuple, dict] = {}
        self.made = 0
        self.start = self.state(("", ((None, 0),)))

    def state(self, key: tuple) -> dict:
        """A state is its own transition table, character -> (next state, tokens added), with its key under None."""
        if (state := self.states.get(key)) is None:
            state = self.states[key] = {None: key}
        return state

    def merged(self, text: str) -> list[str]:
        """Encoding of a short text by the merges themselves; only used to compile."""
        parts, rank = list(text), self.ranks.get
        order = [rank(a + b, _NEVER) for a, b in zip(parts, parts[1:], strict=False)]
        while order and (best := min(order)) != _NEVER:
            i = order.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del order[i]
            if i:
                order[i - 1] = rank(parts[i - 1] + parts[i], _NEVER)
            if i < len(order):
                order[i] = rank(parts[i] + parts[i + 1], _NEVER)
        return parts

    def follows(self, a: str | None, b: str) -> bool:
        """Whether token b may stand after token a."""
        if (ok := self.proper.get(b)) is None:
            ok = self.proper[b] = self.merged(b) == [b]
        if not ok or a is None or a[-1] + b[0] not in self.inside:
            return ok
        if (ok := self.pairs.get((a, b))) is None:
            if len(self.pairs) >= TRANSITIONS:
                self.pairs.clear()
            ok = self.pairs[a, b] = self.merged(a + b) == [a, b]
        return ok

    def compile(self, state: dict, c: str) -> tuple[dict, int]:
        """The transition of a state on character c: next state and tokens added."""
        suffix, cuts = state[None]
        read = suffix + c
        for size in range(min(len(read), self.longest), 0, -1):
            piece = read[-size:]
            if piece in self.ranks and self.follows(cuts[len(read) - size][0], piece):
                token, count = piece, cuts[len(read) - size][1] + 1
                break
        else:  # outside the vocabulary: a token for each byte, and nothing merges with them
            token, count = None, len(c.encode("utf-8", "surrogatepass"))
        cuts = [x and (x[0], x[1] - count) for x in cuts] + [(token, 0)]
        size = next((n for n in range(min(len(read), self.longest - 1), 0, -1) if read[-n:] in self.prefixes), 0)
        suffix, cuts = read[len(read) - size :], cuts[len(cuts) - 1 - size :]
        for j, x in enumerate(cuts[:-1]):  # cuts that no later token can begin at, and tokens that fit whatever begins there
            if suffix[j:] not in self.prefixes:
                cuts[j] = None
            elif x and x[0] is not None and x[0][-1] + suffix[j] not in self.inside:
                cuts[j] = (None, x[1])
        out = self.state((suffix, tuple(cuts))), count
        state[c] = out
        self.made += 1
        return out

    def count(self, text: str) -> int:
        """Tokens of a text that begins where the past is forgotten; spaces are ``SPACE`` already."""
        if self.made > TRANSITIONS:
            self.made = 0
            self.clear()
        state, n, i = self.start, 0, 0
        while True:
            try:
                for c in text[i:] if i else text:
                    state, more = state[c]
                    n += more
                    i += 1
                break
            except KeyError:
                self.compile(state, text[i])
        return n


class Words(dict):
    """Counts of words: the transducer's maps from the state after a word's end, kept for words seen before."""

    def __init__(self, machine: Transducer):
        super().__init__()
        self.machine = machine

    def __missing__(self, word: str) -> int:
        n = self.machine.count(SPACE + word)
        if len(word) <= 64:
            if len(self) >= MEMO:
                self.clear()
            self[word] = n
        return n


class Counter:
    def __init__(self, ranks: dict[str, int]):
        self.machine = Transducer(ranks)
        self.words = Words(self.machine)

    def whole(self, text: str) -> int:
        """Tokens from one forgetting point to another."""
        parts = text.split(SPACE)
        if "" in parts[1:]:
            return sum(self.words[x[1:]] if x[1:2] != SPACE else self.machine.count(x) for x in re.findall(f"{SPACE}+[^{SPACE}]*|^[^{SPACE}]+", text)) if text[:1] == SPACE else self.slow(text)
        get = self.words.__getitem__
        return (self.machine.count(parts[0]) if parts[0] else 0) + sum(map(get, parts[1:]))

    def slow(self, text: str) -> int:
        at = text.find(SPACE)
        return self.machine.count(text[:at]) + self.whole(text[at:])

    def chunk_map(self, text: str) -> tuple[str, int | None, str]:
        """(head, count, tail) of a chunk; count None: no forgetting point inside, all of it is head."""
        first = _SYNC.search(text)
        if not first:
            return text, None, ""
        last = text.rfind(SPACE)
        while text[last - 1] == SPACE:
            last -= 1
        last = max(last, first.start())
        return text[: first.start()], self.whole(text[first.start() : last]) if last > first.start() else 0, text[last:]

    def compose(self, a: tuple[str, int | None, str], b: tuple[str, int | None, str]) -> tuple[str, int | None, str]:
        """The map of two neighbouring chunks; associative. Their join may itself hold forgetting points."""
        left, right = (a[2] if a[1] is not None else a[0]), b[0]
        middle = left + right + ("" if b[1] is None else SPACE)  # b's count begins at a word's start
        head, count, tail = self.chunk_map(middle) if a[1] is None else (left, None, "")
        if a[1] is not None:
            if b[1] is None:
                inner = self.chunk_map(left + right)
                return (a[0], a[1], left + right) if inner[1] is None else (a[0], a[1] + self.whole(inner[0]) + inner[1], inner[2])
            return a[0], a[1] + self.whole(left + right) + b[1], b[2]
        if b[1] is None:
            return self.chunk_map(left + right)
        return head, (count or 0) + (self.whole(tail[:-1]) if tail[:-1] else 0) + b[1], b[2]

    def count(self, text: str | None, size: int = CHUNK) -> int:
        """Tokens of a whole text; 0 if it is empty."""
        if not text:
            return 0
        text = SPACE + text.replace(" ", SPACE)
        if len(text) <= size:
            return self.whole(text)
        maps = [self.chunk_map(text[i : i + size]) for i in range(0, len(text), size)]
        while len(maps) > 1:  # a level of the scan
            maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        head, count, tail = maps[0]
        return self.whole(head) + (0 if count is None else count + self.whole(tail))


def load(path: str) -> dict[str, int]:
    """Mergeable pieces of a sentencepiece BPE model with byte fallback and identity normalisation, by priority."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    return {sp.id_to_piece(i): n for n, i in enumerate(sorted(ids, key=lambda i: -sp.get_score(i)))}


@lru_cache(1)
def counter(path: str) -> Counter:
    """One per Python worker."""
    return Counter(load(path))


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Tokens of every text: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    ``path`` is the vocabulary file, which every executor must have. Null and empty texts: 0 bytes, 0 tokens, false.
    Rows are independent: repeated rows give equal results; columns besides doc_id and text are not looked at. An
    empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in batches:
            n = pa.array([own.count(t) for t in batch.column(2).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), n], names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), "text")
    return rows.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint").withColumn("over_limit", F.col("n_tokens") > limit)
