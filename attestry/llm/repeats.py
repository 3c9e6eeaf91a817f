"""Repeated byte strings over all documents, by common-prefix interval trees over sharded suffix arrays.

Every ``LENGTH``-byte window belongs to the smallest ``GRAM``-byte gram inside it (its anchor), which depends on its bytes alone; neighbouring
windows with one anchor form a stretch. Equal windows therefore lie in stretches with equal anchors, and anchors are the shards:

1. Stretches are sent to their anchor's shard by hashes only. All but the first of equal stretches are repeats as a whole. Each task keeps
   one of the equal stretches it has itself, so that a hot passage sends one row per batch.
2. Shards that hold different stretches are built: an enhanced suffix array over the window starts of one copy of each. A stack-scan of its
   common-prefix intervals of LENGTH bytes or more yields the interval tree; an interval whose occurrences have different bytes to
   their left is a maximal repeat of the shard and is output with all its occurrences.
   Shards beyond ``SHARD`` stretches are dealt anew by a longer anchor (``GRAMS``). The last one is a whole window, whose shard holds no two
   different stretches, so this ends.
3. The groups that ``repeats`` gives out join the copies of every stretch back: an occurrence in a stretch is one in each of its copies,
   and a stretch with copies is itself a maximal repeat.

Every repeated window lies in a maximal repeat with the same occurrences, so the union of all but the first occurrences is what
``removed`` takes out; for copies of a stretch that is the whole stretch, without a join. Longer repeats are reported in pieces, one for
each anchor in them.

Defined results: a null text counts as empty; documents are ordered by id, null ids last, then by their text's hash; repeated rows are
documents of their own, the later ones repeats of the first; texts below LENGTH bytes keep everything, longer ones of any length are read whole; an
empty table gives an empty one; other columns, whatever their names, play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.llm.tables import per_batch, ship, stored, text_of

LENGTH = 100
GRAM = 32
#: Sizes of the anchors, each for the shards that the one before leaves too large.
GRAMS = (GRAM, 64, 88, LENGTH)
SHARD = 4000
TOGETHER = 2000

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


@lru_cache(maxsize=1)
def _bytes() -> np.ndarray:
    return np.random.default_rng(9).integers(0, 1 << 64, 256, dtype=np.uint64)


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64."""
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for base in (_BASE, inverse):
        powers = np.ones(1, np.uint64)
        while len(powers) < n:
            powers = np.concatenate((powers, powers * _U(pow(base, len(powers), 1 << 64))))
        out.append(powers)
    return out[0], out[1]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(29))) * _U(_BASE)
    return x ^ (x >> _U(32))


def hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Sums from which the hash of any part follows: see ``part``."""
    size = 1 << max(12, (len(data) + 1).bit_length())
    forward, back = _powers(size)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_bytes()[np.frombuffer(data, np.uint8)] * back[: len(data)], out=sums[1:])
    return sums, forward


def part(sums: np.ndarray, forward: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the bytes from ``start`` to ``end``."""
    return _mixed((sums[end] - sums[start]) * forward[start] + end.astype(np.uint64) - start.astype(np.uint64))


def stretches(data: bytes, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of one text: hash of the anchor of ``gram`` bytes, hash of the stretch, start, end (of its bytes)."""
    n = len(data)
    if n < LENGTH:
        return (np.zeros(0, np.int64),) * 4
    sums, forward = hashes(data)
    at = np.arange(n - gram + 1)
    grams = _mixed((sums[gram:] - sums[: n - gram + 1]) * forward[: n - gram + 1])
    low = (grams & _U(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    width, span = LENGTH - gram + 1, 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    low = np.minimum(low[: n - LENGTH + 1], low[width - span : width - span + n - LENGTH + 1])
    anchor = (low & _U(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    end = np.append(first[1:], len(anchor)) - 1 + LENGTH
    return grams[anchor[first]].view(np.int64), part(sums, forward, first, end).view(np.int64), first, end


def _numbered(docs: DataFrame, key: str) -> DataFrame:
    """Rows (doc, key, text): ``doc`` orders the documents. It is the key itself where keys are integers, all there and all different."""
    rows = docs.select(F.col(key).alias("key"), text_of().alias("text"))
    if dict(docs.dtypes)[key] in ("bigint", "int", "smallint", "tinyint"):
        n, ids, different = docs.select(F.count("*"), F.count(key), F.countDistinct(key)).first()
        if n == ids == different:
            return rows.select(F.col("key").cast("long").alias("doc"), "key", "text")
    ordered = rows.orderBy(F.col("key").asc_nulls_last(), F.xxhash64("text"))
    return stored(ordered.withColumn("doc", F.monotonically_increasing_id()).select("doc", "key", "text"), "numbered")


STRETCHES = "anchor long, stretch long, doc long, start int, end int, whole boolean"


def _sent(texts: DataFrame, gram: int = GRAM) -> DataFrame:
    """Stretches of all documents, or of the parts in ``ranges``; ``whole`` marks those that repeat an earlier one of their batch and need
    not be compared."""
    ship(texts.sparkSession)
    ranged = "ranges" in texts.columns

    def parts_of(batch: pa.RecordBatch) -> Iterator[tuple]:
        for i, doc in enumerate(batch.column(0).to_pylist()):
            data = batch.column(1)[i].as_py().encode()
            for r in batch.column(2)[i].as_py() if ranged else [{"start": 0, "end": len(data)}]:
                anchor, own, start, end = stretches(data[r["start"] : r["end"]], gram)
                if len(anchor):
                    yield np.full(len(anchor), doc, np.int64), anchor, own, start + r["start"], end + r["start"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = list(parts_of(batch))
            if not parts:
                continue
            doc, anchor, own, start, end = (np.concatenate(c) for c in zip(*parts))
            order = np.lexsort((start, doc, own, anchor))
            doc, anchor, own, start, end = doc[order], anchor[order], own[order], start[order], end[order]
            again = np.concatenate(([False], (own[1:] == own[:-1]) & (anchor[1:] == anchor[:-1])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor), pa.array(own), pa.array(doc), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)), pa.array(again)],
                names=["anchor", "stretch", "doc", "start", "end", "whole"],
            )

    return texts.select("doc", "text", *(["ranges"] if ranged else [])).mapInArrow(run, STRETCHES)


def _met(sent: DataFrame) -> DataFrame:
    """Stretches by shard: repeats of an equal earlier one as ``whole``; of those in shards with several, the first of each, as not ``whole``."""
    ship(sent.sparkSession)
    ordered = sent.filter("NOT whole").repartition("anchor").sortWithinPartitions("anchor", "stretch", "doc", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(columns, whole):
            arrays = [pa.array(c) for c in columns]
            return pa.RecordBatch.from_arrays([*arrays, pa.array(np.full(len(columns[0]), whole))], names=["anchor", "stretch", "doc", "start", "end", "whole"])

        last = None  # anchor and stretch of the row before
        held = None  # the first stretch of its shard, until another one comes
        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            anchor, own = columns[0], columns[1]
            if not len(anchor):
                continue
            same = np.concatenate(([last is not None and last == (anchor[0], own[0])], (anchor[1:] == anchor[:-1]) & (own[1:] == own[:-1])))
            last = (anchor[-1], own[-1])
            if same.any():
                yield rows([c[same] for c in columns], True)
            firsts = [c[~same] for c in columns]
            if held is not None:
                firsts = [np.concatenate((h, c)) for h, c in zip(held[0], firsts)]
            if not len(firsts[0]):
                continue
            joined = firsts[0][1:] == firsts[0][:-1]
            several = np.concatenate(([False], joined)) | np.concatenate((joined, [False]))
            done = held is not None and held[1]
            out = several.copy()
            if done:
                out[0] = False  # already given out
            if out.any():
                yield rows([c[out] for c in firsts], False)
            held = ([c[-1:] for c in firsts], bool(several[-1]) or (done and len(firsts[0]) == 1))

    return ordered.mapInArrow(run, STRETCHES)


def intervals(rows: np.ndarray, lengths: np.ndarray, shard: np.ndarray, least: int = LENGTH) -> list[tuple[int, int, int]]:
    """Common-prefix intervals (first, last, depth) of sorted suffixes of depth ``least`` or more, by a stack-scan of the prefix lengths."""
    if len(rows) < 2:
        return []
    unequal = rows[1:] != rows[:-1]
    lcp = np.where(unequal.any(axis=1), unequal.argmax(axis=1), rows.shape[1])
    lcp = np.minimum(lcp, np.minimum(lengths[1:], lengths[:-1]))
    lcp[shard[1:] != shard[:-1]] = 0
    out, stack, previous = [], [], -1
    values = lcp.tolist() + [0]
    for i in [*np.flatnonzero(lcp >= least).tolist(), None]:
        # Between two runs of long prefixes lies a short one, which closes all intervals.
        if stack and (i is None or i != previous + 1):
            out += [(low, previous + 1, depth) for low, depth in reversed(stack)]
            stack = []
        if i is None:
            break
        low = i
        while stack and stack[-1][1] > values[i]:
            low, depth = stack.pop()
            out.append((low, i, depth))
        if not stack or stack[-1][1] < values[i]:
            stack.append((low, values[i]))
        previous = i
    return out


def maximal_repeats(shards: list[int], docs: list[int], starts: list[int], texts: list[bytes], least: int = LENGTH) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """Maximal repeats (shard, length, occurrences) among stretches given by shard: occurrences are (doc, start), the first one first."""
    counts = np.array([len(t) - least + 1 for t in texts])
    owner = np.repeat(np.arange(len(texts)), counts)
    begin = np.concatenate([np.arange(c) for c in counts])
    joined = np.frombuffer(b"".join(texts) + bytes(4 * LENGTH), np.uint8)
    base = np.concatenate(([0], np.cumsum([len(t) for t in texts])[:-1]))
    left = np.array([len(t) for t in texts])[owner] - begin
    width = int(left.max())
    rows = np.lib.stride_tricks.sliding_window_view(joined, width)[base[owner] + begin].copy()
    rows[np.arange(width)[None, :] >= left[:, None]] = 0
    shard = np.unique(np.array(shards, np.int64), return_inverse=True)[1][owner]
    keyed = np.concatenate((shard.astype(">u4").view(np.uint8).reshape(-1, 4), rows), axis=1)
    order = np.argsort(np.ascontiguousarray(keyed).view(f"S{keyed.shape[1]}").ravel(), kind="stable")
    before = np.where(begin > 0, joined[np.maximum(base[owner] + begin - 1, 0)].astype(np.int64), -1)[order]
    doc, place = np.array(docs, np.int64)[owner][order], np.array(starts, np.int64)[owner][order] + begin[order]
    out = []
    for low, high, depth in intervals(rows[order], left[order], shard[order], least):
        to_left = before[low : high + 1]
        # At the start of a stretch what lies to the left is not the shard's to know: that counts as different.
        if (to_left < 0).any() or (to_left != to_left[0]).any():
            out.append((shards[owner[order[low]]], depth, sorted(zip(doc[low : high + 1].tolist(), place[low : high + 1].tolist()))))
    return out


def _shard_repeats(rows: DataFrame) -> DataFrame:
    """Rows (anchor, doc, start, stretch, bytes), dealt and sorted by their first three, to (repeat, length, doc, start, first) and the place in
    a stretch: (anchor, stretch, offset, size)."""
    schema = "repeat long, length int, doc long, start int, first boolean, anchor long, stretch long, offset int, size int"
    ship(rows.sparkSession)

    def solved(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        shards, docs, starts, own, texts = zip(*held)
        # Stretches go by their number here, which is in the order of their documents and starts.
        found = maximal_repeats(list(shards), list(range(len(held))), [0] * len(held), list(texts))
        flat = [
            (shard ^ (i << 1), length, docs[n], starts[n] + at, k == 0, shard, own[n], at, len(texts[n]))
            for i, (shard, length, where) in enumerate(found)
            for k, (n, at) in enumerate(where)
        ]
        if flat:
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
            names = ["repeat", "length", "doc", "start", "first", "anchor", "stretch", "offset", "size"]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*flat), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                # Whole shards only; one has at most SHARD rows.
                if len(held) >= TOGETHER and held[-1][0] != row[0]:
                    yield from solved(held)
                    held = []
                held.append(row)
        yield from solved(held)

    return rows.mapInArrow(run, schema)


def _found(texts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stretches that repeat an equal one whole (doc, start, end); the maximal repeats among the first ones of equal stretches, see
    ``_shard_repeats``; all stretches of the shards these were found in."""

    def cut(columns: list) -> list:
        out: list[list] = [[], [], [], [], []]
        for d, text, wanted in zip(*columns):
            data = text.encode()
            for w in wanted:
                for column, value in zip(out, (w["anchor"], d, w["start"], w["stretch"], data[w["start"] : w["end"]])):
                    column.append(value)
        return out

    single, found, solved = [], [], []
    source = texts.select("doc", "text")
    for gram in GRAMS:
        sent = stored(_sent(source, gram), "stretches")
        met = stored(_met(sent).unionByName(sent.filter("whole")), "met")
        mixed = met.filter("NOT whole")
        sizes = mixed.groupBy("anchor").agg(F.count("*").alias("n"))
        small = mixed.join(sizes.filter(F.col("n") <= SHARD), "anchor")
        # A document's stretches are no more than its length.
        asked = small.groupBy("doc").agg(F.collect_list(F.struct("anchor", "start", "end", "stretch")).alias("asked"))
        shards = per_batch(texts.select("doc", "text").join(asked, "doc"), cut, "anchor long, doc long, start int, stretch long, bytes binary")
        found.append(stored(_shard_repeats(shards.repartition("anchor").sortWithinPartitions("anchor", "doc", "start")), "repeats"))
        single.append(met.filter("whole").select("doc", "start", "end"))
        # Written, so that Spark knows its size: a table of few anchors is broadcast, and no hot anchor meets in one task.
        large = stored(sizes.filter(F.col("n") > SHARD).select("anchor"), "large")
        if large.isEmpty():
            solved.append(sent)
            break
        solved.append(sent.join(large, "anchor", "left_anti"))
        # All copies go on, so that the next anchors' shards know their occurrences too.
        ranges = sent.join(large, "anchor").groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
        source = texts.select("doc", "text").join(ranges, "doc")
    return tuple(reduce(DataFrame.unionByName, parts) for parts in (single, found, solved))


def repeats(docs: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tables: the numbered documents (doc, key, text); stretches that repeat an equal one whole (doc, start, end); the maximal repeats of
    the shards with all their occurrences (repeat, length, doc, start, first)."""
    texts = _numbered(docs, key)
    single, found, solved = _found(texts)
    copies = solved.select("anchor", "stretch", F.col("doc").alias("d"), F.col("start").alias("s"))
    spread = found.join(copies, ["anchor", "stretch"]).select(
        "repeat", "length", F.col("d").alias("doc"), (F.col("s") + F.col("offset")).alias("start"),
        (F.col("first") & (F.col("d") == F.col("doc")) & (F.col("s") + F.col("offset") == F.col("start"))).alias("first"),
    )
    # A stretch with copies is a repeat of its own, unless an interval of its length has it already.
    whole = found.filter("offset = 0 AND length = size").select("anchor", "stretch").distinct()
    several = solved.groupBy("anchor", "stretch").agg(F.min(F.struct("doc", "start")).alias("f"), F.count("*").alias("n")).filter("n > 1")
    alone = several.join(whole, ["anchor", "stretch"], "left_anti").join(solved, ["anchor", "stretch"]).select(
        F.xxhash64("anchor", "stretch").alias("repeat"), (F.col("end") - F.col("start")).alias("length"), "doc", "start",
        ((F.col("doc") == F.col("f.doc")) & (F.col("start") == F.col("f.start"))).alias("first"),
    )
    return texts, single, spread.unionByName(alone)


def removed(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: key, n_bytes, n_removed, n_spans, kept_sha256."""
    texts = _numbered(docs, key)
    single, found, _ = _found(texts)
    later = found.filter("NOT first").select("doc", "start", (F.col("start") + F.col("length")).alias("end"))
    spans = single.unionByName(later).groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    kind = dict(docs.dtypes)[key]

    def cut(columns: list) -> list:
        out: list[list] = [[], [], [], [], []]
        for own, text, spans in zip(*columns):
            data, kept, at, gone, runs = text.encode(), [], 0, 0, 0
            end = -1
            for s in sorted((s["start"], s["end"]) for s in spans or []):
                if s[0] > end:
                    runs += 1
                    kept.append(data[at : s[0]])
                    gone += s[1] - s[0]
                    end = s[1]
                elif s[1] > end:
                    gone += s[1] - end
                    end = s[1]
                at = end
            kept.append(data[at:])
            for column, value in zip(out, (own, len(data), gone, runs, hashlib.sha256(b"".join(kept)).hexdigest())):
                column.append(value)
        return out

    joined = texts.join(spans, "doc", "left").select("key", "text", "spans")
    out = per_batch(joined, cut, f"key {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.withColumnRenamed("key", key)
