"""Periodic runs of words, found on a grammar of the text.

A run is a stretch of ``LEAST`` words or more, and of three periods or more, in which words one period apart are equal, that neither neighbour
extends; its period is the smallest.

Every pair of neighbouring words inside a run occurs twice in it. So a text is first cut wherever a pair occurs once in its piece, again until
nothing changes; pieces of fewer than ``LEAST`` words hold no run, and no run crosses a cut. Each piece left is compressed by Re-Pair: the
most frequent pair of symbols becomes a nonterminal, until none occurs twice; what remains is folded into a balanced tree. A run lies, for the
lowest nonterminal that covers it, across the boundary of its two halves. So for every nonterminal of ``LEAST`` words or more the runs
across its boundary are computed once: their periods are distances from the boundary's pair of words to its other occurrences. They are translated
to all places where the nonterminal is derived. A run cut short by the end of its nonterminal is part of a longer one found
higher up: intervals of one period that share a period's length are merged, which leaves the maximal ones.

Scale: a text is one row; texts are neither shuffled nor compared. A text of n words needs memory and, without runs, time in proportion to n.
Defined results: null texts count as empty; texts may repeat; a null key gives a row; other columns play no part.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.llm.tables import per_batch, text_of

LEAST = 24


def numbered(words: list) -> np.ndarray:
    """Each word's number, by first occurrence."""
    known: dict = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def pieces(ids: np.ndarray) -> list[tuple[int, int]]:
    """Stretches (start, end) of ``LEAST`` words or more all of whose neighbouring pairs occur twice or more in the stretch itself."""
    if len(ids) < LEAST:
        return []
    pair = np.unique(ids[:-1] * (int(ids.max()) + 1) + ids[1:], return_inverse=True)[1]
    piece = np.zeros(len(pair), np.int64)
    where = np.arange(len(pair))
    while len(where):
        _, own, counts = np.unique(piece * len(ids) + pair[where], return_inverse=True, return_counts=True)
        good = counts[own] > 1
        where = where[good]
        breaks = np.diff(where, prepend=-2) != 1
        piece_next = np.cumsum(breaks) - 1
        long = np.bincount(piece_next, minlength=1)[piece_next] >= LEAST - 1 if len(where) else np.zeros(0, bool)
        if good.all() and long.all():
            break
        where, piece = where[long], piece_next[long]
    starts = where[np.diff(where, prepend=-2) != 1]
    ends = where[np.diff(where, append=len(ids) + 1) != 1] + 2
    return list(zip(starts.tolist(), ends.tolist()))


def re_pair(ids: list[int]) -> tuple[list, list[int]]:
    """Rules (left, right) and the symbols that remain: a symbol below 0 is the word ``-1 - symbol``, others are rules' numbers."""
    n = len(ids)
    symbol = [-1 - i for i in ids]
    after, before = [*range(1, n), -1], [*range(-1, n - 1)]
    places: dict[tuple, set] = defaultdict(set)

    def occurs(at: int) -> None:
        places[symbol[at], symbol[after[at]]].add(at)

    for i in range(n - 1):
        occurs(i)
    by_count: dict[int, set] = defaultdict(set)
    for pair, where in places.items():
        by_count[len(where)].add(pair)
    level, rules = max(by_count, default=0), []
    while level > 1:
        if not by_count[level]:
            level -= 1
            continue
        pair = by_count[level].pop()
        have = len(places.get(pair, ()))
        if have != level:
            # Counts only fall until a pair is looked at again; new pairs enter at their own count, which is never above the level.
            if have > 1:
                by_count[min(have, level)].add(pair)
            continue
        # Neighbouring occurrences of a pair of equal symbols overlap; every other one counts.
        taken, last = [], -1
        for at in sorted(places[pair]):
            if before[at] != last or last < 0:
                taken.append(at)
                last = at
            else:
                last = -1
        if len(taken) < 2:
            del places[pair]
            continue
        del places[pair]
        new = len(rules)
        rules.append(pair)
        touched = set()
        for at in taken:
            right = after[at]
            left, far = before[at], after[right]
            if left >= 0:
                places.get((symbol[left], pair[0]), set()).discard(left)
            if far >= 0:
                places.get((pair[1], symbol[far]), set()).discard(right)
            symbol[at], after[at] = new, far
            if far >= 0:
                before[far] = at
        for at in taken:
            if before[at] >= 0:
                occurs(before[at])
                touched.add((symbol[before[at]], new))
            if after[at] >= 0:
                occurs(at)
                touched.add((new, symbol[after[at]]))
        for one in touched:
            if (count := len(places[one])) > 1:
                by_count[min(count, level)].add(one)
    rest, at = [], 0
    while at >= 0 and n:
        rest.append(symbol[at])
        at = after[at]
    return rules, rest


def _extent(text: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The longest stretch around the equal words ``at`` and ``at + period`` that has the period."""
    end, step = at, 64
    while end + period < len(text):
        a, b = text[end : end + step], text[end + period : end + period + step]
        same = a[: len(b)] == b
        if not same.all():
            end += int(same.argmin())
            break
        end, step = end + len(same), step * 2
    start, step = at, 64
    while start > 0:
        low = max(0, start - step)
        same = (text[low:start] == text[low + period : start + period])[::-1]
        if not same.all():
            start -= int(same.argmin())
            break
        start, step = low, step * 2
    return start, end + period


def across(text: np.ndarray, boundary: int) -> list[tuple[int, int, int]]:
    """Runs (start, end, period) of ``text`` that hold the words on both sides of ``boundary``."""
    pair = (text[:-1] == text[boundary - 1]) & (text[1:] == text[boundary])
    distance = np.flatnonzero(pair) - (boundary - 1)
    found: list[tuple[int, int, int]] = []
    for d in sorted(distance[distance != 0].tolist(), key=lambda d: (abs(d), d)):
        period = abs(d)
        if 3 * period > len(text):
            break
        at = min(boundary - 1, boundary - 1 + d)
        # A multiple of a known period inside its run gives that run again.
        if any(period % q == 0 and s <= at and at + period < e for s, e, q in found):
            continue
        start, end = _extent(text, at, period)
        if end - start >= max(LEAST, 3 * period) and start < boundary < end:
            found.append((start, end, period))
    return found


def runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs (start, end, period) by start, then period."""
    return sorted(run for start, end in pieces(ids) for run in _piece_runs(ids[start:end], start))


def _piece_runs(ids: np.ndarray, base: int) -> list[tuple[int, int, int]]:
    rules, rest = re_pair(ids.tolist())
    # The symbols that remain become a balanced tree of rules of their own.
    while len(rest) > 1:
        joined = []
        for i in range(0, len(rest) - 1, 2):
            rules.append((rest[i], rest[i + 1]))
            joined.append(len(rules) - 1)
        rest = joined + rest[len(rest) - len(rest) % 2 :]
    size, example = [], [0] * len(rules)
    for left, right in rules:
        size.append((1 if left < 0 else size[left]) + (1 if right < 0 else size[right]))
    # Where each rule is derived, and one of the places for its words.
    derived: dict[int, list[int]] = defaultdict(list)
    derived[len(rules) - 1] = [0]
    own: dict[int, list[tuple[int, int, int]]] = {}
    by_period: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for rule in range(len(rules) - 1, -1, -1):
        where = derived.pop(rule, None)
        if not where or size[rule] < LEAST:
            continue
        left, right = rules[rule]
        half = 1 if left < 0 else size[left]
        if left >= 0 and size[left] >= LEAST:
            derived[left] += where
        if right >= 0 and size[right] >= LEAST:
            derived[right] += [at + half for at in where]
        for start, end, period in across(ids[where[0] : where[0] + size[rule]], half):
            by_period[period] += [(at + start, at + end) for at in where]
    found = []
    for period, intervals in by_period.items():
        intervals.sort()
        low, high = intervals[0]
        for start, end in intervals[1:]:
            if start + period <= high:
                high = max(high, end)
            else:
                found.append((base + low, base + high, period))
                low, high = start, end
        found.append((base + low, base + high, period))
    return found


def planted(words: list, key: int | None) -> list:
    """``words``, made periodic from some word on if the key's checksum says so."""
    if key is None or not words:
        return words
    h = zlib.crc32(str(key).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def digest(words: list[bytes]) -> tuple:
    """Number of runs; start, length, period and exponent of the one of greatest exponent; digests of all runs and of the words left."""
    found = runs(numbered(words))
    kept, at = [], 0
    for start, end in sorted((start + period, end) for start, end, period in found):
        if start > at:
            kept += words[at:start]
        at = max(at, end)
    kept += words[at:]
    top = min(found, key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2]), default=None)
    best = (None,) * 4 if top is None else (top[0], top[1] - top[0], top[2], 1000 * (top[1] - top[0]) // top[2])
    listed = "".join(f"{s},{e - s},{p}\n" for s, e, p in found)
    return len(found), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest()


def detect(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows (key, runs): the runs (start, length, period) of every row of ``docs``, whatever type its key has."""

    def found(columns: list) -> list:
        lists = [[{"start": s, "length": e - s, "period": p} for s, e, p in runs(numbered(text.encode().split()))] for text in columns[1]]
        return [columns[0], lists]

    own = docs.select(F.col(key).alias("key"), text_of().alias("text"))
    return per_batch(own, found, f"key {dict(docs.dtypes)[key]}, runs array<struct<start:long,length:long,period:long>>").withColumnRenamed("key", key)


def digests(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``, periodic stretches planted by its integer key: see ``digest``."""

    def rows_of(columns: list) -> list:
        rows = [(k, *digest(planted(text.encode().split(), k))) for k, text in zip(*columns)]
        return [list(c) for c in zip(*rows)]

    own = docs.select(F.col(key).alias("key"), text_of().alias("text"))
    kinds = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    return per_batch(own, rows_of, f"key {dict(docs.dtypes)[key]}, {kinds}").withColumnRenamed("key", key)
