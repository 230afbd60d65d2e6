"""Boolean keyword queries compiled to one Column.

Grammar: ``or := and (OR and)*``, ``and := not (AND? not)*``, ``not := NOT not | atom``; quotes make phrases, a leading
``-`` means NOT, operators are case-insensitive. A term matches at word borders, where a word character is [0-9A-Za-z_]
whatever the text's script. In strict mode, as in the established behaviour, a NOT that directly follows an operand ends
the query (``a NOT b`` means ``a``); lenient mode reads it as AND NOT.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_LEXEME = re.compile(r'\s*(?:(?P<open>\()|(?P<close>\))|"(?P<phrase>[^"]*)(?:"|$)|(?P<minus>-)(?=\S)|(?P<bare>[^\s()"]+))')
_EDGE = "0-9A-Za-z_"


def tokenize(text: str) -> list[tuple[str, str]]:
    """(kind, value) with kinds ( ) OP TERM."""
    out, at = [], 0
    while (m := _LEXEME.match(text, at)) and m.end() > at:
        at = m.end()
        kind = m.lastgroup
        if kind in ("open", "close"):
            out.append(("(" if kind == "open" else ")", m[kind]))
        elif kind == "minus":
            out.append(("OP", "NOT"))
        elif kind == "phrase":
            out.append(("TERM", m["phrase"]))
        elif m["bare"].upper() in ("AND", "OR", "NOT"):
            out.append(("OP", m["bare"].upper()))
        else:
            out.append(("TERM", m["bare"]))
    return out


def parse(text: str, strict: bool = True) -> tuple:
    """Nested tuples: ("and"|"or", [nodes]), ("not", node), ("term", text), ("all",) for nothing to match."""
    tokens = tokenize(text)
    at = 0

    def peek() -> tuple[str, str]:
        return tokens[at] if at < len(tokens) else ("END", "")

    def joined(kind: str, parts: list) -> tuple:
        return parts[0] if len(parts) == 1 else (kind, parts)

    def disjunction() -> tuple:
        nonlocal at
        parts = [conjunction()]
        while peek() == ("OP", "OR"):
            at += 1
            parts.append(conjunction())
        return joined("or", parts)

    def conjunction() -> tuple:
        nonlocal at
        parts = [negation()]
        while True:
            if peek() == ("OP", "AND"):
                at += 1
            elif not (peek()[0] in ("TERM", "(") or (not strict and peek() == ("OP", "NOT"))):
                return joined("and", parts)
            parts.append(negation())

    def negation() -> tuple:
        nonlocal at
        if peek() == ("OP", "NOT"):
            at += 1
            return ("not", negation())
        return atom()

    def atom() -> tuple:
        nonlocal at
        kind, value = peek()
        if kind == "TERM":
            at += 1
            return ("term", value)
        if kind == "(":
            at += 1
            inner = disjunction()
            at += peek()[0] == ")"
            return inner
        return ("all",)

    return disjunction()


def _plain(term: str) -> bool:
    """Whether a term may join an alternation: word characters at both ends, nothing special inside."""
    return bool(re.fullmatch(r"[0-9A-Za-z_](?:[0-9A-Za-z_ \-]*[0-9A-Za-z_])?", term))


def pattern(terms: list[str]) -> str:
    """One regular expression for any of the terms; plain ones are grouped by their first two letters."""
    by: dict[str, list[str]] = {}
    for t in sorted(set(terms)):
        by.setdefault(t[:2] if _plain(t) else t, []).append(t)
    groups = [f"{re.escape(k)}(?:{'|'.join(x[2:] for x in v)})" if len(v) > 1 else v[0] for k, v in by.items()]
    return f"(?<![{_EDGE}])(?:{'|'.join(f'(?:{g})' for g in groups)})(?![{_EDGE}])"


def balanced(parts: list[Column], op) -> Column:
    """Combine by halves: a long chain of predicates would overflow the stack of the plan's visitor."""
    while len(parts) > 1:
        parts = [op(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def compile_query(query: str, text: Column, strict: bool = True, factor: bool = True) -> Column:
    """Predicate of a query on a text; null text counts as empty. With ``factor``, an OR of terms is one regex."""
    low = F.lower(F.coalesce(text, F.lit("")))

    def term(t: str) -> Column:
        t = t.lower()
        return low.rlike(pattern([t])) if t else F.lit(True)

    def build(node: tuple) -> Column:
        if node[0] == "term":
            return term(node[1])
        if node[0] == "not":
            return ~build(node[1])
        if node[0] == "all":
            return F.lit(False)
        if node[0] == "or":
            flat = _flatten(node)
            same = [n[1].lower() for n in flat if n[0] == "term" and _plain(n[1].lower())]
            if factor and len(same) > 1:
                rest = [n for n in flat if not (n[0] == "term" and _plain(n[1].lower()))]
                return balanced([low.rlike(pattern(same)), *map(build, rest)], lambda a, b: a | b)
            return balanced([build(n) for n in flat], lambda a, b: a | b)
        return balanced([build(n) for n in node[1]], lambda a, b: a & b)

    return build(parse(query, strict))


def _flatten(node: tuple) -> list[tuple]:
    return reduce(lambda out, n: out + (_flatten(n) if n[0] == "or" else [n]), node[1], [])


def _trie(words: list[str]) -> str:
    """A regular expression for any of the words, the longest first, that shares their beginnings."""
    by: dict[str, list[str]] = {}
    for w in words:
        by.setdefault(w[:1], []).append(w[1:])
    ends = "" in by
    by.pop("", None)
    parts = []
    for c, rest in by.items():
        while len(set(x[:1] for x in rest)) == 1 and rest[0]:  # a stretch that all share
            c, rest = c + rest[0][0], [x[1:] for x in rest]
        parts.append(c + (_trie(rest) if rest != [""] else ""))
    if not parts:
        return ""
    return f"(?:{'|'.join(parts)})" + ("?" if ends else "") if len(parts) > 1 or ends else parts[0]


def _terms(node: tuple) -> list[str]:
    if node[0] == "term":
        return [node[1].lower()]
    return [t for n in (node[1] if node[0] in ("and", "or") else [node[1]] if node[0] == "not" else []) for t in _terms(n)]


def compile_groups(queries: dict[str, str], text: Column, strict: bool = True) -> tuple[Column, dict[str, Callable[[Column], Column]]]:
    """All terms of many queries in one search, and each query as a predicate on what was found.

    The first result is the array of distinct terms found; at a place where several begin, the longest stands for the
    shorter ones, which are beginnings of it at a word's end. A query's predicate looks only at that array, so hundreds
    of terms in tens of queries cost one pass over a text. Terms that are no plain words stay searches of their own.
    """
    low = F.lower(F.coalesce(text, F.lit("")))
    trees = {name: parse(q, strict) for name, q in queries.items()}
    plain = sorted({t for tree in trees.values() for t in _terms(tree) if _plain(t)})
    found = F.array().cast("array<string>")
    if plain:
        search = f"(?<![{_EDGE}])(?=({_trie(plain)})(?![{_EDGE}]))"
        found = F.array_distinct(F.regexp_extract_all(low, F.lit(search), F.lit(1)))
    # a term is there if it is found or if one that goes on after it is
    stands: dict[str, list[str]] = {t: [t] for t in plain}
    for t in plain:
        for i, c in enumerate(t):
            if not (c.isalnum() or c == "_") and t[:i] in stands:
                stands[t[:i]].append(t)

    def build(node: tuple, seen: Column) -> Column:
        if node[0] == "not":
            return ~build(node[1], seen)
        if node[0] == "all":
            return F.lit(False)
        if node[0] == "and":
            return balanced([build(n, seen) for n in node[1]], lambda a, b: a & b)
        flat = _flatten(node) if node[0] == "or" else [node]
        own = {x for n in flat if n[0] == "term" and _plain(n[1].lower()) for x in stands[n[1].lower()]}
        parts = [F.arrays_overlap(seen, F.array(*map(F.lit, sorted(own))))] if own else []
        for n in flat:
            if n[0] != "term":
                parts.append(build(n, seen))
            elif not _plain(t := n[1].lower()):
                parts.append(low.rlike(pattern([t])) if t else F.lit(True))
        return balanced(parts, lambda a, b: a | b)

    return found, {name: (lambda seen, tree=tree: build(tree, seen)) for name, tree in trees.items()}


def clean_group_lines(lines: list[str]) -> list[str]:
    """Lines of a keyword file: comment lines and blank ones go, a lone NOT becomes AND NOT, neighbours in quotes get OR."""
    kept = [x for x in (line.strip() for line in lines) if x and not x.startswith("--")]
    kept = ["AND NOT" if x == "NOT" else x for x in kept]
    nexts = [*kept[1:], ""]
    return [f"{x} OR" if x[0] == y[:1] == '"' and not x.endswith("OR") else x for x, y in zip(kept, nexts, strict=True)]


def top_level_blocks(text: str) -> list[str]:
    """Parenthesised blocks of depth 0."""
    out, depth, start = [], 0, 0
    for i, c in enumerate(text):
        if c == "(":
            start = i if depth == 0 else start
            depth += 1
        elif c == ")" and depth:
            depth -= 1
            if depth == 0:
                out.append(text[start : i + 1])
    return out


_GROUP = re.compile(r"--\s*GROUP\s+(\d+)\s*:\s*(.+)")


def parse_group_file(text: str) -> list[dict]:
    """group, name and query of each ``-- GROUP n: name`` block of a keyword file, which ends at a line with ) alone.

    The file's text may stand between triple quotes. What follows the last block from a lone AND on is the suffix of
    every group.
    """
    if text.count('"""') >= 2:
        text = text.split('"""', 1)[1].rsplit('"""', 1)[0]
    groups: list[dict] = []
    terms: list[str] | None = None
    tail: list[str] = []
    for line in text.splitlines():
        head = _GROUP.search(line)
        if terms is None and head:
            groups.append({"group": int(head[1]), "name": head[2].strip()})
            terms = []
        elif terms is not None and line.strip() == ")":
            groups[-1]["query"] = "(\n" + "\n".join(clean_group_lines(terms)) + "\n)"
            terms, tail = None, []
        elif terms is not None:
            terms.append(line)
        else:
            tail.append(line)
    if terms is not None:  # a last block that isn't closed
        groups[-1]["query"] = "(\n" + "\n".join(clean_group_lines(terms)) + "\n)"
    at = next((i for i, line in enumerate(tail) if line.strip() == "AND"), None)
    suffix = "" if at is None else "\n" + "\n".join(clean_group_lines(tail[at:]))
    return [{**g, "query": g["query"] + suffix} for g in groups]
