"""Vectorised word hashing over UTF-8 buffers; shared by the operators that look at words."""

from __future__ import annotations

import numpy as np

_SEP = np.zeros(256, bool)
_SEP[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MUL = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(_MUL), -1, 1 << 64))
_BLOCK = 1 << 20
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the multiplier and of its inverse modulo 2^64."""
    if len(_powers["up"]) <= n:
        for k, base in (("up", _MUL), ("down", _INV)):
            steps = np.full(n + 1, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span [start, end) of ``buf``; spans are sorted and don't overlap. In blocks of bounded size."""
    out = np.zeros(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = int(np.searchsorted(ends, starts[i] + _BLOCK, "right"))
        j = max(j, i + 1)
        base, stop = int(starts[i]), int(ends[j - 1])
        up, down = _power(stop - base)
        sums = np.zeros(stop - base + 1, np.uint64)
        np.cumsum((buf[base:stop].astype(np.uint64) + np.uint64(1)) * up[: stop - base], out=sums[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


def joined(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """One buffer of all texts, each followed by a space, and the offset of each text (and the end)."""
    lengths = np.fromiter((len(t) + 1 if t else 1 for t in texts), np.int64, len(texts))
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(lengths, out=at[1:])
    return np.frombuffer(b"".join((t or b"") + b" " for t in texts), np.uint8), at


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edges = np.flatnonzero(np.diff(mask.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    return edges[0::2], edges[1::2]


def words(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, and where each text's words begin (and the end)."""
    buf, at = joined(texts)
    starts, ends = runs(~_SEP[buf])
    return span_hashes(_LOWER[buf], starts, ends), np.searchsorted(starts, at)


_GRAM = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def shingles(h: np.ndarray, ptr: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's k-word shingles; fewer than k words: the whole sequence; no words: empty."""
    n = max(0, len(h) - k + 1)
    every = np.zeros(n, np.uint64)
    for j in range(k):
        every += h[j : j + n] * _GRAM[j]
    every = mix(every)
    out = []
    for a, b in zip(ptr[:-1].tolist(), ptr[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(every[a : b - k + 1]))
        elif b > a:
            out.append(mix((h[a:b] * _GRAM[: b - a]).sum(keepdims=True, dtype=np.uint64) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
