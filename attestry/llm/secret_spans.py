"""Secrets in texts: three fixed patterns, and random-looking strings by two character Markov models.

Model: first-order Markov chains over characters, one for random strings and one for ordinary identifiers, both fitted with add-one
smoothing on a labelled sample (``training_sample``, ``SAMPLE`` strings of each label, made by rule from a fixed seed). A string of
``MIN_LENGTH`` or more token characters that holds a letter and a digit is a secret if the mean log-likelihood ratio per transition
exceeds ``threshold``, which lies midway between the labels' means shifted towards the random side (``MARGIN``). A string that is none as a
whole is searched for the part between two delimiters (``CUT``) that exceeds the threshold by most in sum, then what is left and right
of it, so that names and paths glued to a secret do not hide it.

Spans are ``kind:start:end`` in code points, end exclusive. The fixed patterns' spans always stay; the model adds only spans that
touch none of them. Defined results: a null text counts as empty; null ids and repeated rows are carried; texts of any length are
searched whole, one pass per pattern; spans that start at one place go by kind; an empty table gives an empty one; columns of ``scan``'s input but key and
text play no part, those of ``mask_secrets`` pass through, whatever their names. No shuffle.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.llm.tables import per_batch

# The patterns of the contract.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")

KINDS = ("assign", "access", "hex", "random")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
CUT = re.compile(r"[=/+_-]+")
MIXED = re.compile(r"[0-9].*[A-Za-z]|[A-Za-z].*[0-9]", re.DOTALL)

MIN_LENGTH = 20
SAMPLE = 4000
MARGIN = 0.6
SEED = 20
WORDS = (
    "get set user name list item index count total value parse file path data table row column key map node tree read write open close "
    "start stop create update delete find search page order line text string number date time first last next previous size length max "
    "min sum mean version config option result error message handler request response client server session account address customer"
).split()


def training_sample(n: int = SAMPLE, seed: int = SEED) -> list[tuple[str, int]]:
    """Labelled strings: 1 random, 0 ordinary."""
    rng = random.Random(seed)
    upper, lower, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    alphabets = (upper + lower + digits, upper + lower + digits + "+/", digits + "abcdef", upper + digits, lower + digits, upper + lower + digits + "_-")
    out = [("".join(rng.choice(alphabets[i % len(alphabets)]) for _ in range(rng.randint(20, 48))), 1) for i in range(n)]
    for i in range(n):
        parts = [rng.choice(WORDS) for _ in range(rng.randint(3, 6))]
        joined = ("_".join(parts), "-".join(parts), "".join(p.title() for p in parts), "/".join(parts), "_".join(parts).upper())[i % 5]
        tail = ("", str(rng.randint(1, 99)), f"_{rng.randint(1990, 2030)}", f"-v{rng.randint(1, 9)}")[i % 4]
        out.append((joined + tail, 0))
    return out


@lru_cache(maxsize=1)
def model() -> tuple[dict[str, float], float]:
    """Log-likelihood ratio of each pair of characters, and the threshold of the mean."""
    characters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
    sample = training_sample()
    pairs, starts = (Counter(), Counter()), (Counter(), Counter())
    for text, label in sample:
        for a, b in zip(text, text[1:]):
            pairs[label][a + b] += 1
            starts[label][a] += 1
    ratio = {
        a + b: math.log((pairs[1][a + b] + 1) / (starts[1][a] + len(characters))) - math.log((pairs[0][a + b] + 1) / (starts[0][a] + len(characters)))
        for a in characters
        for b in characters
    }
    means = [sum(s) / len(s) for s in ([mean_ratio(t, ratio) for t, label in sample if label == k] for k in (0, 1))]
    return ratio, means[0] + MARGIN * (means[1] - means[0])


def mean_ratio(text: str, ratio: dict[str, float]) -> float:
    return sum(ratio[a + b] for a, b in zip(text, text[1:])) / max(1, len(text) - 1)


def is_random(text: str) -> bool:
    ratio, threshold = model()
    return MIXED.search(text) is not None and mean_ratio(text, ratio) > threshold


def _best_part(text: str, ratio: dict[str, float], threshold: float) -> tuple[int, int] | None:
    """Of the parts between delimiters with MIN_LENGTH or more characters, a letter and a digit: the one of the largest sum above the
    threshold. One pass: for each end, the best of all starts that lie far enough before it."""
    sums = [0.0, 0.0]
    for a, b in zip(text, text[1:]):
        sums.append(sums[-1] + ratio[a + b] - threshold)
    # sums[i] is the sum of the pairs up to the one that ends at character i - 1.
    cuts = [(m.start(), m.end()) for m in CUT.finditer(text)]
    starts, ends = [0, *(e for _, e in cuts)], [*(s for s, _ in cuts), len(text)]
    best, lowest, at = None, None, 0
    letter = digit = -1
    done = 0
    for end in ends:
        for i in range(done, end):
            if text[i].isdigit():
                digit = i
            elif text[i].isalpha():
                letter = i
        done = max(done, end)
        while at < len(starts) and starts[at] <= min(end - MIN_LENGTH, letter, digit):
            if lowest is None or sums[starts[at] + 1] < lowest[0]:
                lowest = (sums[starts[at] + 1], starts[at])
            at += 1
        if lowest is not None and (best is None or sums[end] - lowest[0] > best[0]):
            best = (sums[end] - lowest[0], lowest[1], end)
    return best[1:] if best is not None and best[0] > 0 else None


def random_parts(text: str) -> list[tuple[int, int]]:
    """The random-looking parts (start, end) of a run of token characters, ascending; the run itself if it is one."""
    if is_random(text):
        return [(0, len(text))]
    ratio, threshold = model()
    out, left = [], [(0, len(text))]
    while left:
        start, end = left.pop()
        if end - start >= MIN_LENGTH and (part := _best_part(text[start:end], ratio, threshold)):
            out.append((start + part[0], start + part[1]))
            left += [(start, start + part[0]), (start + part[1], end)]
    return sorted(out)


def find(text: str | None) -> list[tuple[int, int, int]]:
    """Spans as (start, number of kind, end), sorted by start and kind."""
    text = text or ""
    base = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    base += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base.sort()
    added, at, reach = [], 0, 0
    for m in CANDIDATE.finditer(text):
        while at < len(base) and base[at][0] < m.end():
            reach = max(reach, base[at][2])
            at += 1
        if reach <= m.start():
            added += [(m.start() + start, 3, m.start() + end) for start, end in random_parts(m[0])]
    return sorted(base + added)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: its key, counts by kind, the digest of the base spans and all spans."""

    def rows(columns: list) -> list:
        keys, texts = columns
        found = [find(t) for t in texts]
        base = [[s for s in spans if s[1] < 3] for spans in found]
        counts = [[sum(s[1] == kind for s in spans) for spans in found] for kind in range(4)]
        return [keys, *counts, [hashlib.sha256(written(s).encode()).hexdigest() for s in base], [written(s) for s in found]]

    kind = dict(docs.dtypes)[key]
    schema = f"`{key}` {kind}, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string"
    return per_batch(docs.select(key, "text"), rows, schema)


def masked(text: str | None) -> str | None:
    """``text`` with every span replaced by its kind; overlapping spans go as one."""
    spans = find(text)
    if not spans:
        return text
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind]}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with the secrets in ``text`` masked; all rows and columns stay."""
    names = docs.columns
    at = names.index("text")
    schema = ", ".join(f"c{i} {kind}" for i, (_, kind) in enumerate(docs.dtypes))

    def rows(columns: list) -> list:
        return [[masked(t) for t in c] if i == at else c for i, c in enumerate(columns)]

    out = per_batch(docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]), rows, schema)
    return out.toDF(*names)
