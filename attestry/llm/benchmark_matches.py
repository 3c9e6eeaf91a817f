"""Benchmark decontamination: suffix arrays over shards of the training texts, searched for every suffix of every test item.

A text's words are the runs of digits, letters a-z (A-Z are lower-cased) and characters beyond ASCII. A shard is a run of whole texts of about
``SHARD`` bytes. Its words are numbered by their hashes, and its suffix array sorts the word positions by what follows them: by keys of several
numbers first, then by prefix doubling of what is still tied, to the depth of the longest test item. Every test suffix is narrowed in it
by binary search, all suffixes at once, step by step until nothing matches: that gives its longest verbatim match and where it lies, and
on the way the interval of the places that hold its first ``WINDOW`` words. An item of fewer words is one window.

Scale: texts are never shuffled; a task holds one shard. Test items go to the tasks block by block, ``BLOCK`` bytes (or one item) at a time,
so that neither the driver nor a task holds the whole benchmark; with several blocks the texts are searched once for each, and what the
later ones find is joined by the text's digest. Occurrences of one window are an interval, whatever their number; items that share
a window share it.

Words are compared by 64-bit hashes of their bytes and length. Defined results: null texts have no words; items with equal ids are
one item; an item without id marks words but is not counted or listed; repeated rows and rows without id are rows of their own; an empty
benchmark leaves all clean; other columns play no part.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from attestry.llm.repeats import hashes, part
from attestry.llm.tables import ship, stored, text_of

WINDOW = 10
SHARD = 2 << 20
BLOCK = 4 << 20

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 0 for c in range(256))


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the number of words of each text."""
    data = b"\x00".join(texts).translate(_LOWER)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = np.frombuffer(data, np.uint8) != 0
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    limits = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
    counts = np.diff(np.searchsorted(starts, limits), prepend=0)
    return part(*hashes(data), starts, ends), counts


def _laid_out(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes with a 0 after each text, and the place of each."""
    place = np.arange(len(codes)) + np.repeat(np.arange(len(counts)), counts)
    line = np.zeros(len(codes) + len(counts) + 1, np.int64)
    line[place] = codes
    return line, place


def _packed(line: np.ndarray, bits: int, each: int) -> np.ndarray:
    """At every place the next ``each`` codes in one key; what follows a 0 counts as 0."""
    padded = np.concatenate((line, np.zeros(each, np.int64)))
    key, alive = np.zeros(len(line), np.int64), np.ones(len(line), bool)
    for i in range(each):
        code = padded[i : i + len(line)]
        alive = alive & (code != 0)
        key = (key << bits) | np.where(alive, code, 0)
    return key


class Shard:
    """The suffix array of some texts' words, right to ``depth`` words."""

    def __init__(self, texts: list[bytes], depth: int):
        hashed, self.counts = words_of(texts)
        self.vocabulary, codes = np.unique(hashed, return_inverse=True)
        self.bits = (len(self.vocabulary) + 1).bit_length()
        self.each = 62 // self.bits
        self.line, place = _laid_out(codes + 1, self.counts)
        self.key = _packed(self.line, self.bits, self.each)
        self.sa = place[np.argsort(self.key[place])]
        self.sorted = self.key[self.sa]
        self._sort_ties(depth)

    def _sort_ties(self, depth: int) -> None:
        """Prefix doubling of the places whose keys are equal and do not reach their text's end."""
        n = len(self.sa)
        if not n:
            return
        start = np.concatenate(([True], self.sorted[1:] != self.sorted[:-1]))
        rank = np.zeros(len(self.line), np.int64)
        rank[self.sa] = np.maximum.accumulate(np.where(start, np.arange(n), 0)) + 1
        ended = (self.key & ((1 << self.bits) - 1)) == 0
        tied = ~start | np.concatenate((~start[1:], [False]))
        open_ = np.flatnonzero(tied & ~ended[self.sa])
        sorted_to = self.each
        while sorted_to < depth and len(open_):
            here = self.sa[open_]
            after = here + sorted_to
            pair = (rank[here] << 32) | rank[after]
            order = np.argsort(pair, kind="stable")
            pair, here, after = pair[order], here[order], after[order]
            self.sa[open_] = here
            start = np.concatenate(([True], pair[1:] != pair[:-1]))
            rank[here] = open_[np.maximum.accumulate(np.where(start, np.arange(len(here)), 0))] + 1
            ended[here] = ended[after]
            tied = ~start | np.concatenate((~start[1:], [False]))
            open_ = open_[tied & ~ended[here]]
            sorted_to *= 2

    def _first(self, low: np.ndarray, high: np.ndarray, shift: int, key: np.ndarray) -> np.ndarray:
        """First of each interval's entries whose key, ``shift`` words on, is not below ``key``."""
        low, high = low.copy(), high.copy()
        while (going := low < high).any():
            middle = np.minimum((low + high) >> 1, len(self.sa) - 1)
            below = self.key[np.where(going, self.sa[middle] + shift, 0)] < key
            low = np.where(going & below, middle + 1, low)
            high = np.where(going & ~below, middle, high)
        return low

    def _narrowed(self, low: np.ndarray, high: np.ndarray, shift: int, key: np.ndarray, take: int) -> tuple[np.ndarray, np.ndarray]:
        """The parts of the intervals that match ``take`` codes of the keys, ``shift`` words on."""
        spare = self.bits * (self.each - take)
        least = (key >> spare) << spare
        if shift == 0:
            return np.searchsorted(self.sorted, least), np.searchsorted(self.sorted, least + (1 << spare))
        return self._first(low, high, shift, least), self._first(low, high, shift, least + (1 << spare))

    def search(self, block: Block) -> tuple[np.ndarray, ...]:
        """For each window of ``block`` that occurs here: its number; the interval of the array that holds it; the length of its suffix's
        longest match, and that match's interval."""
        at = np.searchsorted(self.vocabulary, block.hashed)
        known = at < len(self.vocabulary)
        known[known] = self.vocabulary[at[known]] == block.hashed[known]
        line, place = _laid_out(np.where(known, at + 1, 0), block.counts)
        test = np.concatenate((_packed(line, self.bits, self.each), np.zeros(block.longest + self.each, np.int64)))
        which, shift = np.arange(len(block.start)), 0
        begin = place[block.start] if len(place) else block.start
        low, high = np.zeros(len(which), np.int64), np.full(len(which), len(self.sa), np.int64)
        window = np.zeros((2, len(which)), np.int64)
        length, best = np.zeros(len(which), np.int64), np.zeros((2, len(which)), np.int64)
        while len(which) and len(self.sa):
            key = test[begin[which] + shift]
            for take in range(1, self.each + 1):
                there = (key >> (self.bits * (self.each - take))) & ((1 << self.bits) - 1) != 0
                which, key, low, high = which[there], key[there], low[there], high[there]
                lower, upper = self._narrowed(low, high, shift, key, take)
                found = lower < upper
                which, key, low, high, lower, upper = which[found], key[found], low[found], high[found], lower[found], upper[found]
                length[which], best[0, which], best[1, which] = shift + take, lower, upper
                full = which[block.size[which] == shift + take]
                window[:, full] = best[:, full]
            low, high, shift = best[0, which], best[1, which], shift + self.each
        hit = np.flatnonzero(window[0] < window[1])
        return hit, window[0, hit], window[1, hit], length[hit], best[0, hit], best[1, hit]

    def places(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All places of some intervals, and which interval each is of."""
        sizes = high - low
        owner = np.repeat(np.arange(len(low)), sizes)
        return self.sa[np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[owner]], owner


class Block:
    """Some test items: their ids, word hashes, and windows by item, first word and size."""

    def __init__(self, items: list[tuple[str | None, bytes]]):
        self.ids = [i for i, _ in items]
        self.hashed, self.counts = words_of([t for _, t in items])
        windows = np.where(self.counts >= WINDOW, self.counts - WINDOW + 1, np.minimum(self.counts, 1))
        self.item = np.repeat(np.arange(len(items)), windows)
        offset = np.arange(len(self.item)) - np.repeat(np.cumsum(windows) - windows, windows)
        base = np.cumsum(self.counts) - self.counts
        self.start = (base[self.item] + offset).astype(np.int64)
        self.offset = offset
        self.size = np.minimum(self.counts, WINDOW)[self.item]
        self.longest = int(self.counts.max(initial=0))


def blocks_of(benchmark: DataFrame, key: str) -> Iterator[Block]:
    """The test items, ``BLOCK`` bytes at a time."""
    held, size, given = [], 0, False
    for row in benchmark.select(F.col(key).cast("string").alias("k"), text_of().alias("t")).toLocalIterator():
        data = row.t.encode()
        if held and size + len(data) > BLOCK:
            yield Block(held)
            held, size, given = [], 0, True
        held.append((row.k, data))
        size += len(data)
    if held or not given:
        yield Block(held)


def _shards(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[tuple[pa.Array, Shard]]:
    for batch in batches:
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        begin, size = 0, 0
        for i, text in enumerate(texts):
            size += len(text)
            if size >= SHARD or i == len(texts) - 1:
                yield batch.column(0).slice(begin, i + 1 - begin), Shard(texts[begin : i + 1], depth)
                begin, size = i + 1, 0


def _spans(covered: np.ndarray, base: np.ndarray) -> dict[int, list[dict]]:
    """Runs of covered places by text, in words of that text. Between two texts lies a place that is never covered."""
    edges = np.diff(np.concatenate(([0], covered.astype(np.int8), [0])))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    doc = np.searchsorted(base, starts, "right") - 1
    out = defaultdict(list)
    for d, s, e in zip(doc.tolist(), (starts - base[doc]).tolist(), (ends - base[doc]).tolist()):
        out[d].append({"start": s, "end": e})
    return out


def _hits(rows: DataFrame, block: Block, all_rows: bool) -> DataFrame:
    """Rows (key, n_words, spans, items) for rows (key, text): words hit by the block's windows, and the items these are of."""
    schema = f"key {rows.dtypes[0][1]}, n_words long, spans array<struct<start:int,end:int>>, items array<string>"
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    ship(rows.sparkSession)
    sent = rows.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = sent.value
        for keys, shard in _shards(batches, block.longest):
            hit, low, high, *_ = shard.search(block)
            base = np.cumsum(shard.counts + 1) - shard.counts - 1
            # Items that share a window share its interval, which is searched out once.
            intervals, of = np.unique(np.stack((low, high, block.size[hit])), axis=1, return_inverse=True)
            places, owner = shard.places(intervals[0], intervals[1])
            change = np.zeros(len(shard.line) + 1, np.int64)
            np.add.at(change, places, 1)
            np.add.at(change, places + intervals[2][owner], -1)
            spans = _spans(np.cumsum(change[:-1]) > 0, base)
            of_interval = defaultdict(set)
            for n, window in zip(of.ravel().tolist(), hit.tolist()):
                of_interval[n].add(block.ids[block.item[window]])
            items = defaultdict(set)
            doc = np.searchsorted(base, places, "right") - 1
            for d, n in np.unique(np.stack((doc, owner)), axis=1).T.tolist():
                items[d] |= of_interval[n]
            chosen = range(len(keys)) if all_rows else sorted(spans)
            if len(chosen):
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.take(pa.array(chosen, pa.int64())).cast(arrow.field(0).type),
                        pa.array(shard.counts[list(chosen)], pa.int64()),
                        pa.array([spans.get(d, []) for d in chosen], arrow.field(2).type),
                        pa.array([sorted(i for i in items.get(d, ()) if i is not None) for d in chosen], arrow.field(3).type),
                    ],
                    schema=arrow,
                )

    return rows.mapInArrow(run, schema)


def hits(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", item: str = "item_id") -> DataFrame:
    """One row per row of ``docs``: key, n_words, spans (disjoint runs of hit words, first word and the one after the last), items."""
    own = docs.select(F.col(key).alias("key"), text_of().alias("text"))
    blocks = blocks_of(benchmark, item)
    block = next(blocks)
    more = list(_later(own, blocks))
    if not more:
        return _hits(own, block, True).withColumnRenamed("key", key)
    # Equal texts have equal hits, so those of later blocks are joined by digest.
    pairs = docs.select(F.struct(F.col(key).alias("key"), F.sha2(text_of(), 256).alias("digest")).alias("key"), text_of().alias("text"))
    first = _hits(pairs, block, True).select("key.*", "n_words", "spans", "items")
    later = reduce(DataFrame.unionByName, more).groupBy("digest").agg(F.flatten(F.collect_list("spans")).alias("s"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("i"))
    joined = first.join(later, "digest", "left")
    ordered = F.array_sort(F.concat("spans", F.coalesce("s", F.expr("array()"))))
    # Runs of several blocks may overlap: each takes what lies beyond the ones before, or goes.
    start = F.struct(F.lit(-1).alias("end"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("kept"))
    step = lambda acc, s: F.when(s["end"] <= acc["end"], acc).otherwise(
        F.struct(s["end"].alias("end"), F.concat(acc["kept"], F.array(F.struct(F.greatest(s["start"], acc["end"]).alias("start"), s["end"].alias("end")))).alias("kept"))
    )
    return joined.select(
        F.col("key").alias(key), "n_words", F.aggregate(ordered, start, step)["kept"].alias("spans"), F.array_distinct(F.concat("items", F.coalesce("i", F.expr("array()")))).alias("items")
    )


def _later(own: DataFrame, blocks: Iterator[Block]) -> Iterator[DataFrame]:
    """What each further block finds, once per text, written before the next block is fetched."""
    for block in blocks:
        found = _hits(own.select(F.sha2("text", 256).alias("key"), "text"), block, False)
        yield stored(found.withColumnRenamed("key", "digest").drop("n_words").dropDuplicates(["digest"]), "hits")


def report(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", item: str = "item_id") -> DataFrame:
    """One row per row of ``docs``: key, n_words, n_hit, n_items, items_sha256, contaminated."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return hits(docs, benchmark, key, item).select(
        key, "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, item: str = "item_id") -> DataFrame:
    """The rows of ``docs`` without any hit, all columns as they were; equal texts share their fate."""
    digest = F.sha2(text_of(), 256)
    texts = docs.select(digest.alias("_digest"), "text").dropDuplicates(["_digest"])
    dirty = report(texts, benchmark, "_digest", item).filter("contaminated").select("_digest")
    return docs.join(dirty, digest == dirty["_digest"], "left_anti")


def longest_matches(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", item: str = "item_id") -> DataFrame:
    """Rows (item, item_start, length, key, start): for every test suffix that holds a whole window, its longest verbatim match in any text,
    at all places that have it; positions and lengths in words."""
    schema = f"item string, item_start int, length int, {'key'} {dict(docs.dtypes)[key]}, start int"
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    own = docs.select(F.col(key).alias("key"), text_of().alias("text"))
    ship(docs.sparkSession)
    found = []
    for one in blocks_of(benchmark, item):
        sent = docs.sparkSession.sparkContext.broadcast(one)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            block = sent.value
            for keys, shard in _shards(batches, block.longest):
                hit, _, _, length, low, high = shard.search(block)
                base = np.cumsum(shard.counts + 1) - shard.counts - 1
                places, owner = shard.places(low, high)
                doc = np.searchsorted(base, places, "right") - 1
                window = hit[owner]
                if len(window):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([block.ids[i] for i in block.item[window].tolist()], pa.string()),
                            pa.array(block.offset[window].astype(np.int32)),
                            pa.array(length[owner].astype(np.int32)),
                            keys.take(pa.array(doc)).cast(arrow.field(3).type),
                            pa.array((places - base[doc]).astype(np.int32)),
                        ],
                        schema=arrow,
                    )

        found.append(stored(own.mapInArrow(run, schema), "matches"))
    rows = reduce(DataFrame.unionByName, found)
    best = rows.groupBy("item", "item_start").agg(F.max("length").alias("best"))
    same = rows["item"].eqNullSafe(best["item"]) & (rows["item_start"] == best["item_start"]) & (rows["length"] == best["best"])
    return rows.join(best, same, "left_semi").withColumnRenamed("key", key)
