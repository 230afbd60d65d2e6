"""URLs, phone numbers and runs of signs in a text, found and taken out in time linear in its length.

What is found goes wherever its text stands, one find after the other, and a find that comes again is taken out
again: it may stand anew where what was around it has gone. Such a text never reaches over the edge of a stretch of characters
that finds are made of (for a URL, what is between white space), so each stretch changes by itself, and equal stretches
change alike.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable

import ahocorasick
import regex

# A URL: a scheme, www or a domain with a path, then runs without white space or brackets and bracketed parts; it ends with
# one of these or a character that isn't punctuation, and has two of them at least. A domain is only looked for at the first
# word border of its characters, as later ones lead to the same path; every other run is possessive, so nothing is tried again.
_RUN, _END = r"[^\s()<>]", r"[^\s`!()\[\]{};:'\".,<>?«»“”‘’]"
_BRACKETS = rf"\((?:{_RUN}++|\({_RUN}++\))*+\)"
_PARTS = rf"(?:{_RUN}*+{_BRACKETS})"
_HOST = r"[a-z0-9.\-]"
_DOMAIN = rf"(?:(?<=(?:^|[^a-z0-9.\-])[.\-]*)|(?<=[^\Wa-z0-9][a-z0-9]+))(?P<host>{_HOST}++)(?<=\.[a-z]{{2,4}})/"
_START = regex.compile(rf"(?i)\b(?:https?://|www\d{{0,3}}\.|{_DOMAIN})")
_REST = re.compile(rf"(?:{_PARTS}++{_RUN}*{_END}|{_RUN}++{_BRACKETS}{_PARTS}*+|{_BRACKETS}{_PARTS}++|{_RUN}+{_END})")
PHONE = regex.compile(r"\d{3}[-.]?\d{3}[-.]?\d{4}|\(\d{3}\)\s*\d{3}[-.]?\d{4}|\d{3}[-.]?\d{4}")
SIGNS = regex.compile(r"[^a-zA-Z0-9]{3,}")
#: What finds of each kind are made of: their stretches.
_BETWEEN_SPACES, _NUMBERS, _ALL_SIGNS = regex.compile(r"\S+"), regex.compile(r"(?:[\d().\-]|(?<=\))\s++(?=[\d().\-]))+"), regex.compile(r"[^a-zA-Z0-9]+")
#: Characters up to which a stretch is searched anew after each change; in longer ones every find is looked for once.
LONG = 10_000
#: Characters of a find up to which it goes into the automaton, whose depth it is.
DEEP = 1000


def without(text: str, finds: list[str], by: str, stretch: regex.Pattern) -> str:
    """``text`` after every find, in their order, has been replaced by ``by`` wherever it stands."""
    if not finds:
        return text
    places: dict[str, list[int]] = {}
    for k, m in enumerate(finds):
        places.setdefault(m, []).append(k)
    search, deep = ahocorasick.Automaton(), [m for m in places if len(m) > DEEP]
    for m in places:
        if len(m) <= DEEP:
            search.add_word(m, m)
    search.make_automaton()

    def inside(s: str) -> set[str]:
        there = {m for _, m in search.iter(s)} if len(search) else set()
        return there | {m for m in deep if len(m) <= len(s) and m in s}

    def settled(s: str) -> str:
        if len(s) > LONG:
            there = inside(s)
            for m in finds:
                if m in there or by:
                    s = s.replace(m, by)
            return s
        at = -1
        while True:
            later = [(places[m][k], m) for m in inside(s) if (k := bisect_right(places[m], at)) < len(places[m])]
            if not later:
                return s
            at, m = min(later)
            s = s.replace(m, by)

    known: dict[str, str] = {}

    def one(m: regex.Match) -> str:
        s = m.group()
        if (out := known.get(s)) is None:
            out = known[s] = settled(s)
        return out

    return stretch.sub(one, text)


def urls(text: str) -> list[str]:
    """The URLs of a text, from left to right."""
    out, at = [], 0
    while start := _START.search(text, at):
        rest = _REST.match(text, start.end())
        if rest and start["host"] and start["host"].rfind(".") < 1:  # the dot must be within it
            rest = None
        if rest:
            out.append(text[start.start() : rest.end()])
        at = rest.end() if rest else start.start() + 1
    return out


def strip(text: str) -> str:
    """Without URLs and phone numbers, every place where their text occurs; runs of three or more other signs become a space."""
    text = without(text, urls(text), "", _BETWEEN_SPACES)
    text = without(text, PHONE.findall(text), "", _NUMBERS)
    return without(text, SIGNS.findall(text), " ", _ALL_SIGNS)


def dominant(text: str) -> bool:
    """Whether URLs make up more than a third of a text."""
    return sum(map(len, urls(text))) > len(text) / 3


def cleaned(parts: list[str]) -> list[str]:
    """Parts with noise taken out; empty ones and those mostly of URLs go."""
    return [strip(t) for t in parts if t and not dominant(t)]


def or_none(f: Callable) -> Callable:
    return lambda x: None if x is None else f(x)
