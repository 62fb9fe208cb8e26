"""String similarities, 0 to 100; all that a query wants of its pairs are computed in one Arrow pass, once per distinct pair.

ratio is 200 * LCS / (length a + length b), from a bit-parallel longest common subsequence: many pairs at once in 64-bit
words where the shorter text has up to 64 characters, else on Python's long integers.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


@functools.lru_cache(1 << 14)
def _places(a: str) -> dict[str, int]:
    """For each character the bits of its places."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    return where


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence: one bit per character of a, one step per character of b."""
    where = _places(a)
    free = full = (1 << len(a)) - 1
    for c in b:
        hit = free & where.get(c, 0)
        if hit:
            free = ((free + hit) | (free - hit)) & full
    return len(a) - free.bit_count()


def ratio_of(a: str, b: str) -> float:
    return 100.0 if a == b else 200.0 * lcs(a, b) / (len(a) + len(b))


def partial_of(a: str, b: str) -> float:
    """Best ratio of the shorter text with any stretch of the longer one as long, stretches cut by its ends included."""
    if not a or not b:
        return 100.0 if a == b else 0.0
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    best = _best_stretch(short, long)
    return max(best, _best_stretch(long, short)) if len(a) == len(b) else best


def _best_stretch(short: str, long: str) -> float:
    """A stretch one place on shares at most one character more, and one cut shorter no more than before: the rest is skipped."""
    n, at, top = len(short), 0, 0
    while at <= len(long) - n:
        shared = lcs(short, long[at : at + n])
        top = max(top, shared)
        at += top - shared + 1
    best = 100.0 * top / n
    for cut in (lambda size: long[:size], lambda size: long[-size:]):
        size = n - 1
        while size > 0 and 200.0 * size / (n + size) > best:
            shared = lcs(short, cut(size))
            best = max(best, 200.0 * shared / (n + size))
            size = min(size - 1, math.ceil(200.0 * shared / best - n) - 1 if best else 0)
    return best


@functools.lru_cache(1 << 14)
def _tokens(a: str) -> tuple[str, ...]:
    return tuple(sorted(a.split()))


def token_sort_of(a: str, b: str) -> float:
    return ratio_of(" ".join(_tokens(a)), " ".join(_tokens(b)))


def token_set_of(a: str, b: str) -> float:
    """Best ratio among the shared tokens and the shared tokens with either side's own; 0 if a side has none."""
    x, y = set(_tokens(a)), set(_tokens(b))
    if not x or not y:
        return 0.0
    both = sorted(x & y)
    if both and (x <= y or y <= x):
        return 100.0
    s, sx, sy = (" ".join(both + sorted(own)) for own in ((), x - y, y - x))
    return max(ratio_of(sx, sy), *((200.0 * len(s) / (len(s) + len(t)) for t in (sx, sy)) if both else ()), 0.0)  # s begins both


def jaro_winkler_of(a: str, b: str) -> float:
    if a == b:
        return 100.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    rest: list[str | None] = list(b)
    used, mine = [False] * len(b), []
    for i, c in enumerate(a):
        try:
            j = rest.index(c, max(0, i - reach), i + reach + 1)
        except ValueError:
            continue
        rest[j], used[j] = None, True
        mine.append(c)
    m = len(mine)
    if not m:
        return 0.0
    moved = sum(x != y for x, y in zip(mine, (c for c, u in zip(b, used, strict=True) if u), strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    same = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4], strict=False)) if x != y), min(4, len(a), len(b)))
    return 100.0 * (jaro + same * 0.1 * (1 - jaro) if jaro > 0.7 else jaro)


#: Characters of a text that fit a word; pairs that are worked on at once.
WORD, TOGETHER = 64, 2000


class _Lanes:
    """The shorter texts' characters as bit masks, and the longer texts as rows of codes, of up to TOGETHER pairs."""

    def __init__(self, short: list[str], long: list[str]):
        self.n, self.m = (np.array([len(x) for x in side], np.int64) for side in (short, long))
        a, b = (np.array(side, f"U{max(1, width.max())}").view(np.uint32).reshape(len(side), -1) for side, width in ((short, self.n), (long, self.m)))
        top = int(max(a.max(), b.max())) + 1
        seen = np.zeros(top, bool)
        seen[a.ravel()] = seen[b.ravel()] = True
        code = np.cumsum(seen) - 1
        self.kinds, self.width, self.long = int(seen.sum()), b.shape[1], code[b].ravel()
        a = code[a]
        self.masks = np.zeros((len(short), self.kinds), np.uint64)
        for j in range(a.shape[1]):
            rows = np.flatnonzero(self.n > j)
            self.masks[rows, a[rows, j]] |= np.uint64(1) << np.uint64(j)
        self.masks = self.masks.ravel()

    def lcs(self, pair: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of each pair's shorter text and the stretch start to end of its longer one."""
        order = np.argsort(start - end, kind="stable")  # longest first, so those not yet done are the first
        ends = np.sort(end - start)
        at, row = (pair * self.width + start)[order], (pair * self.kinds)[order]
        free = np.full(len(pair), np.uint64(2**64 - 1))
        for k in range(int(ends[-1]) if len(ends) else 0):
            n = len(ends) - int(np.searchsorted(ends, k, "right"))
            now = free[:n]
            hit = self.masks[row[:n] + self.long[at[:n] + k]] & now
            np.bitwise_or(now + hit, now - hit, out=now)
        full = np.where(self.n >= WORD, np.uint64(2**64 - 1), (np.uint64(1) << np.minimum(self.n, WORD - 1).astype(np.uint64)) - np.uint64(1))
        out = np.zeros(len(pair), np.int64)
        out[order] = np.bitwise_count(free & full[pair[order]])
        return self.n[pair] - out


def _batched(one, many):
    """A scorer of lists: many for the pairs that fit words, in turns, and one for the others."""

    def score(a: list[str], b: list[str]) -> np.ndarray:
        out = np.zeros(len(a))
        fits = []
        for i, (x, y) in enumerate(zip(a, b, strict=True)):
            if 0 < min(len(x), len(y)) <= WORD and "\0" not in x and "\0" not in y:
                fits.append(i)
            else:
                out[i] = one(x, y)
        fits.sort(key=lambda i: len(a[i]) + len(b[i]))  # alike in length, so that rows aren't much wider than texts
        for at in range(0, len(fits), TOGETHER):
            some = fits[at : at + TOGETHER]
            pairs = [(a[i], b[i]) if len(a[i]) <= len(b[i]) else (b[i], a[i]) for i in some]
            out[some] = many([x for x, _ in pairs], [y for _, y in pairs])
        return out

    return score


def _ratios(short: list[str], long: list[str]) -> np.ndarray:
    w = _Lanes(short, long)
    return 200.0 * w.lcs(np.arange(len(short)), np.zeros(len(short), np.int64), w.m) / (w.n + w.m)


def _stretches(short: list[str], long: list[str]) -> np.ndarray:
    w = _Lanes(short, long)
    count = w.n + w.m - 1
    pair = np.repeat(np.arange(len(short)), count)
    first = np.arange(len(pair)) - np.repeat(np.cumsum(count) - count, count) + 1 - w.n[pair]
    start, end = np.maximum(first, 0), np.minimum(first + w.n[pair], w.m[pair])
    score = 200.0 * w.lcs(pair, start, end) / (w.n[pair] + end - start)
    return np.maximum.reduceat(score, np.cumsum(count) - count)


def _partials(short: list[str], long: list[str]) -> np.ndarray:
    best = _stretches(short, long)
    same = [i for i, (x, y) in enumerate(zip(short, long, strict=True)) if len(x) == len(y)]
    if same:
        best[same] = np.maximum(best[same], _stretches([long[i] for i in same], [short[i] for i in same]))
    return best


ratios, partials = _batched(ratio_of, _ratios), _batched(partial_of, _partials)


def token_sorts(a: list[str], b: list[str]) -> np.ndarray:
    line = lambda side: [" ".join(_tokens(x)) for x in side]
    return ratios(line(a), line(b))


def token_sets(a: list[str], b: list[str]) -> np.ndarray:
    """token_set_of, with the ratio of the two texts that hold the shared tokens found for all pairs together."""
    out, left, right, at = np.zeros(len(a)), [], [], []
    for i, (p, q) in enumerate(zip(a, b, strict=True)):
        x, y = set(_tokens(p)), set(_tokens(q))
        both = sorted(x & y)
        if x and y and both and (x <= y or y <= x):
            out[i] = 100.0
        elif x and y:
            s, sx, sy = (" ".join(both + sorted(own)) for own in ((), x - y, y - x))
            out[i] = max((200.0 * len(s) / (len(s) + len(t)) for t in (sx, sy)), default=0.0) if both else 0.0
            left.append(sx)
            right.append(sy)
            at.append(i)
    if at:
        out[at] = np.maximum(out[at], ratios(left, right))
    return out


def jaro_winklers(a: list[str], b: list[str]) -> np.ndarray:
    return np.array([jaro_winkler_of(x, y) for x, y in zip(a, b, strict=True)])


SCORERS = {"ratio": ratios, "tsort": token_sorts, "tset": token_sets, "partial": partials, "jw": jaro_winklers}


def similarities(wanted: dict[str, tuple[str, Column, Column]]) -> Column:
    """A struct with one field per name: (scorer, a, b) -> the scorer's value, null where a or b is null."""
    names, scorers = list(wanted), [scorer for scorer, _, _ in wanted.values()]
    kind = "struct<" + ", ".join(f"{n}: double" for n in names) + ">"

    @F.pandas_udf(kind)
    def score(*sides: pd.Series) -> pd.DataFrame:
        out = {}
        for k, name in enumerate(names):
            pairs = list(zip(sides[2 * k], sides[2 * k + 1], strict=True))
            distinct = [p for p in set(pairs) if p[0] is not None and p[1] is not None]
            values = SCORERS[scorers[k]]([a for a, _ in distinct], [b for _, b in distinct]).tolist()
            known = dict(zip(distinct, values, strict=True))
            out[name] = pd.Series([known.get(pair) for pair in pairs], dtype="float64")
        return pd.DataFrame(out)

    return score(*[c for n in names for c in wanted[n][1:]])
