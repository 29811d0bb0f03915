"""Secrets in texts: fixed patterns, and a guess cost for values in a credential context.

The guess cost of a value is the least, over all ways to cut it into segments, of the sum of the
segments' costs in powers of ten.  A segment is a dictionary word, a date, a repeat, a walk on the
keyboard or along the alphabet, or single characters tried out.
"""

from __future__ import annotations

import heapq
import json
import math
import re
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame

from .common import map_rows, texts

# The patterns of the base kinds and the least length of what they find.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 12, 18, 16

KINDS = ("assign", "access", "hex", "guess")
CONTEXT = re.compile(
    r"""(?:password|passwd|passphrase|pwd|secret|token|credential|api[_-]?key|access[_-]?key)s?"""
    r"""["']?[\x20\t]*[:=][\x20\t]*["']?([^\s"'<>,;]{8,})""", re.ASCII | re.IGNORECASE,
)
STEMS = ("passw", "passphrase", "pwd", "secret", "token", "credential", "key")
LEAST_COST = 10.0
KEYBOARD = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
SWAPS = {"0": "o", "1": "l", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
MOST_WORD = 24
LEAST_WORD = 3
SWITCH = math.log10(2)  # for each further segment
_ASSIGN = re.compile(ASSIGN, re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(ACCESS)
# a run of the class is matched whole, so asking for its least length finds the same runs
_HEX = re.compile(f"[0-9a-f]{{{HEX_LENGTH},}}")
_DATE = re.compile(r"(?:19|20)\d\d|\d{1,2}([-/._]?)\d{1,2}\1(?:\d{4}|\d{2})|\d{4}([-/._]?)\d{1,2}\2\d{1,2}")


@lru_cache(maxsize=2)
def dictionary(path: str) -> dict[str, int]:
    """Words of a tokenizer's vocabulary file by rank: its merges are in order of frequency."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    words = sorted((i, t.removesuffix("</w>")) for t, i in vocabulary.items() if t.endswith("</w>"))
    known = [w for _, w in words if len(w) >= LEAST_WORD and w.isascii() and w.isalpha()]
    return {w: n for n, w in reversed(list(enumerate(known, 1)))}


@lru_cache(maxsize=1)
def neighbours() -> dict[str, str]:
    """Keys next to each key: in its row, and above and below by the usual half-key shift."""
    place = {c: (r, i) for r, row in enumerate(KEYBOARD) for i, c in enumerate(row)}
    close = {}
    for c, (r, i) in place.items():
        close[c] = "".join(
            o for o, (s, j) in place.items()
            if (s == r and abs(i - j) == 1) or (abs(s - r) == 1 and 0 <= (j - i) * (r - s) <= 1)
        )
    return close


def single(c: str) -> float:
    if c.isdigit():
        return 1.0
    return math.log10(26) if c.isascii() and c.isalpha() else math.log10(33 if c.isascii() else 1000)


def word_cost(part: str, words: dict[str, int]) -> float | None:
    lowered = part.lower()
    plain = "".join(SWAPS.get(c, c) for c in lowered)
    rank = words.get(plain)
    if rank is None:
        return None
    swaps = sum(a != b for a, b in zip(lowered, plain, strict=True))
    cost = math.log10(rank + 1) + swaps * math.log10(2)
    if part != lowered:
        cost += math.log10(2 if part[1:] == lowered[1:] or part == part.upper() else 2 ** min(8, len(part)))
    return cost


class Walks:
    """Where walks on keys and runs along character codes end that begin at a given place.

    Each stretch of a value is walked once, whoever asks for a place inside it.
    """

    def __init__(self, value: str) -> None:
        self.value, self.lowered, self.close = value, value.lower(), neighbours()
        self.same_length = len(self.lowered) == len(value)
        self.keys = (0, 0, [0])  # begin, end and the turns up to each place of the last stretch
        self.run = (0, 0)

    def on_keys(self, i: int) -> tuple[int, float]:
        begin, end, turns = self.keys
        if not begin <= i < end:
            j, last, turns, lowered = i + 1, "", [0], self.lowered
            while j < len(self.value) and self.same_length and lowered[j] in self.close.get(lowered[j - 1], ""):
                step = self.close[lowered[j - 1]].index(lowered[j])
                turns.append(turns[-1] + (step != last))
                j, last = j + 1, step
            begin, end = i, j
            self.keys = begin, end, turns
        # the first step of a walk is a turn of its own
        return end, turns[-1] - turns[min(i - begin + 1, len(turns) - 1)] + 2 if end > i + 1 else 1

    def on_codes(self, i: int) -> int:
        begin, end = self.run
        if not begin <= i < end - 1:
            k, step, value = i + 1, 0, self.value
            while k < len(value) and abs(d := ord(value[k]) - ord(value[k - 1])) == 1 and step in (0, d):
                k, step = k + 1, d
            self.run = i, k
        return self.run[1]

    def segments(self, i: int) -> Iterator[tuple[int, float]]:
        """Ends and costs: every end up to ``MOST_WORD`` characters on, and the farthest."""
        for end, turns in (self.on_keys(i), (self.on_codes(i), 0)):
            for j in {*range(i + 3, min(end, i + MOST_WORD) + 1), *([end] if end >= i + 3 else ())}:
                yield j, math.log10(47 * (j - i)) + turns * math.log10(4) if turns else math.log10(72 * (j - i))


def repeat_end(value: str, i: int, unit: int) -> int:
    """Where the repetition of the ``unit`` characters from ``i`` on ends; whole repeats only."""
    j, step = i + unit, unit
    part = value[i:j]
    while value.startswith(part, j):  # in doubling steps, then back in halving ones
        j += step
        part += part if len(part) == step else ""
        step = len(part)
    while step > unit:
        step //= 2
        if value.startswith(part[:step], j):
            j += step
    return j


def segments(value: str, i: int, words: dict[str, int], walks: Walks) -> Iterator[tuple[int, float]]:
    """Ends and costs of the segments from ``i`` on, single characters aside.

    Words and dates; walks, runs and repeats of up to ``MOST_WORD`` characters and as far as they go.
    """
    n = len(value)
    for j in range(i + LEAST_WORD, min(n, i + MOST_WORD) + 1):
        cost = word_cost(value[i:j], words)
        if cost is not None:
            yield j, cost
    if match := _DATE.match(value, i):
        yield match.end(), math.log10(120 if match.end() - i == 4 else 365 * 120)
    yield from walks.segments(i)
    for unit in range(1, min(16, (n - i) // 2) + 1):
        part = value[i:i + unit]
        if not value.startswith(part, i + unit):
            continue
        cost = sum(map(single, part))
        known = word_cost(part, words) if unit >= LEAST_WORD else None
        cost = min(cost, known) if known is not None else cost
        end = repeat_end(value, i, unit)
        for j in {*range(i + 2 * unit, min(end, i + MOST_WORD) + 1, unit), end}:
            yield j, cost + math.log10((j - i) // unit)


def guess_cost(value: str, words: dict[str, int], limit: float = math.inf) -> float:
    """Power of ten of the guesses that the cheapest segmentation of the value needs.

    Exact below ``limit``; from there on, some number not below it.  No segment costs less than
    nothing, so places that are only reached at ``limit`` or more are not looked at
    again, and a very long value ends after the few places that are reached below it.
    """
    n = len(value)
    if not n:
        return 0.0
    best: dict[int, list[float]] = {0: [math.inf, 0.0]}  # place: after tried characters, after a segment
    waiting, walks = [0], Walks(value)

    def offer(at: int, cost: float, tried: bool) -> None:
        if cost >= limit:
            return
        if at not in best:
            best[at] = [math.inf, math.inf]
            heapq.heappush(waiting, at)
        best[at][not tried] = min(best[at][not tried], cost)

    while waiting:
        i = heapq.heappop(waiting)
        tried, other = best.pop(i)
        if i == n:
            return min(tried, other)
        switch = SWITCH if i else 0.0
        offer(i + 1, min(tried, other + switch) + single(value[i]), True)
        here = min(tried, other) + switch
        if here < limit:
            for j, cost in segments(value, i, words, walks):
                offer(j, here + cost, False)
    return limit


def find(text: str, words: dict[str, int], least_cost: float = LEAST_COST) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all spans, by start and then kind; code points, end exclusive.

    Base spans are whole matches; a guess span is the value alone.
    """
    found = []
    lowered = text.lower()
    if any(stem in lowered for stem in STEMS):
        found += [
            (m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE
        ]
        found += [
            (m.start(1), 3, m.end(1)) for m in CONTEXT.finditer(text)
            if guess_cost(m[1], words, least_cost) >= least_cost
        ]
    if "AKIA" in text:
        found += [
            (m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH
        ]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def scan(
    df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
    least_cost: float = LEAST_COST,
) -> DataFrame:
    """One row per row of ``df``: doc_id, starts, kinds, ends (arrays, in order of start).

    A null or empty text has no spans; null and repeated ids stay as they are.  Kinds are
    numbers into ``KINDS``.  No shuffle.  ``vocabulary`` is a file that every executor has.
    """

    def make():
        words = dictionary(vocabulary)

        def work(columns):
            for doc_id, text in zip(columns["doc_id"].to_pylist(), columns["text"].to_pylist(), strict=True):
                spans = find(text, words, least_cost)
                yield doc_id, *(list(x) for x in (zip(*spans, strict=True) if spans else ((), (), ())))

        return work

    return map_rows(
        texts(df, id_col, text_col), make,
        "doc_id long, starts array<int>, kinds array<int>, ends array<int>",
    )
