"""Packing of token pieces into sequences by a grouping genetic algorithm on islands.

A document is its token ids and the end id. Only documents longer than a sequence are cut, from their end, into full pieces; the first
piece takes the rest. Full pieces are sequences by themselves. The others are dealt into groups of about ``GROUP`` pieces by hash, and every
group is packed by ``ISLANDS`` islands with populations of their own: a crossover injects well-filled bins of one parent whole into the
other, the bins that held any of their pieces are dissolved, and the displaced pieces go best-fit into what is left; a mutation dissolves
badly filled bins. Between ``EPOCHS`` the best packing of each island migrates to the next. The best of a group is never worse than
best-fit-decreasing, which is in the first population. Bins that stay below ``FULL`` of their size are then dealt anew, whole, with those of
other groups, and packed once more, starting from how they are.

Scale: ids are made and reduced to a checksum where the text is read; only lengths move. A group is bounded by its piece number and packs
in one task; the number of groups grows with the input. All tables between the steps lie in the shared folder.

Defined results: a null text counts as empty and is the end id alone; null ids and repeated rows are packed like others; texts of any length are
encoded whole and cut into pieces; pieces of equal length are told apart by their row and number; an empty table gives no piece; other columns,
whatever their names, play no part.
"""

from __future__ import annotations

import random
import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.llm.tables import per_batch, stored

CAPACITY = 2048
END = 0
#: The only added token of the vocabulary.
ADDED = "<|endoftext|>"
GROUP = 2000
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 8
POPULATION = 4
FULL = 0.97


@lru_cache(maxsize=2)
def encoder(vocabulary: str):
    """``ids(text)`` by the vocabulary: a ``tokenizers`` file, or the same vocabulary as ranks, which is several times faster."""
    if vocabulary.endswith(".json"):
        from tokenizers import Tokenizer

        own = Tokenizer.from_file(vocabulary)
        return lambda text: own.encode(text, add_special_tokens=False).ids
    import base64

    import public_tokenizers
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    ordinary = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def ids(text: str) -> list[int]:
        # As in the tokenizers file, the added token's string is cut out first; its id comes after all ranks.
        first, *others = text.split(ADDED)
        out = ordinary(first)
        for part in others:
            out += [len(ranks), *ordinary(part)]
        return out

    return ids


def pieces_of(docs: DataFrame, vocabulary: str, key: str = "doc_id", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32, and the ids if asked for."""
    kind = dict(docs.dtypes)[key]

    def rows(columns: list) -> list:
        ids_of = encoder(vocabulary)
        out: list[list] = [[] for _ in range(5 + with_ids)]
        for own, text in zip(*columns):
            ids = np.asarray([*ids_of(text or ""), END], "<u4")
            start, piece = 0, 0
            while start < len(ids):
                length = (len(ids) - start) % capacity or capacity
                part = ids[start : start + length]
                for column, value in zip(out, (own, piece, start, length, zlib.crc32(part.tobytes()), part.tolist())):
                    column.append(value)
                start, piece = start + length, piece + 1
        return out

    ids = ", ids array<long>" if with_ids else ""
    return per_batch(docs.select(key, "text"), rows, f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long{ids}")


class Bins:
    """A packing under construction: bins by their free room, for best-fit in one step."""

    def __init__(self, capacity: int):
        self.capacity, self.room, self.mask = capacity, {}, 0

    def put(self, free: int, items: list[int]) -> None:
        self.room.setdefault(free, []).append(items)
        self.mask |= 1 << free

    def best_fit(self, item: int, length: int) -> None:
        fitting = self.mask >> length
        if not fitting:
            self.put(self.capacity - length, [item])
            return
        free = length + (fitting & -fitting).bit_length() - 1
        same = self.room[free]
        items = same.pop()
        if not same:
            del self.room[free]
            self.mask ^= 1 << free
        items.append(item)
        self.put(free - length, items)

    def all(self) -> list[tuple[int, list[int]]]:
        return [(free, items) for free, many in self.room.items() for items in many]


Packing = list  # of (free room, items)


def fitness(packing: Packing, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then bins that are full or empty rather than all alike."""
    return -len(packing), sum((1 - free / capacity) ** 2 for free, _ in packing)


def fitted(lengths: list[int], order: list[int], capacity: int) -> Packing:
    bins = Bins(capacity)
    for item in order:
        bins.best_fit(item, lengths[item])
    return bins.all()


def refit(kept: Packing, displaced: list[int], lengths: list[int], capacity: int) -> Packing:
    bins = Bins(capacity)
    for free, items in kept:
        bins.put(free, list(items))
    for item in sorted(displaced, key=lambda i: -lengths[i]):
        bins.best_fit(item, lengths[item])
    return bins.all()


def crossed(one: Packing, other: Packing, lengths: list[int], capacity: int, rng: random.Random) -> Packing:
    """``one`` with a random half of the best-filled bins of ``other``."""
    best = sorted(other, key=lambda b: b[0])[: max(1, len(other) // 2)]
    injected = [b for b in best if rng.random() < 0.5] or best[:1]
    inside = {i for _, items in injected for i in items}
    kept, displaced = list(injected), []
    for free, items in one:
        if inside.isdisjoint(items):
            kept.append((free, items))
        else:
            displaced += [i for i in items if i not in inside]
    return refit(kept, displaced, lengths, capacity)


def mutated(packing: Packing, lengths: list[int], capacity: int, rng: random.Random) -> Packing:
    """The worst-filled bins, and a few others, dissolved."""
    ranked = sorted(packing, key=lambda b: b[0])
    cut = max(1, len(ranked) // 20)
    gone, kept = ranked[-cut:], ranked[:-cut]
    also = {rng.randrange(len(kept)) for _ in range(min(cut, len(kept)))} if kept else set()
    gone += [kept[i] for i in also]
    return refit([b for i, b in enumerate(kept) if i not in also], [i for _, items in gone for i in items], lengths, capacity)


def evolved(lengths: list[int], population: list[Packing], seed: int, capacity: int = CAPACITY, generations: int = GENERATIONS) -> list[Packing]:
    """A population after some generations, best first."""
    rng = random.Random(seed)
    decreasing = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    population = population + [fitted(lengths, decreasing, capacity)]
    while len(population) < POPULATION:
        # Nearly decreasing orders: each piece may move by some share of its length.
        population.append(fitted(lengths, sorted(decreasing, key=lambda i: -lengths[i] * rng.uniform(0.7, 1.0)), capacity))
    least = -(-sum(lengths) // capacity)
    ranked = sorted(((fitness(p, capacity), p) for p in population), key=lambda x: x[0], reverse=True)[:POPULATION]
    for _ in range(generations):
        if -ranked[0][0][0] <= least:
            break
        one, other = rng.sample(range(len(ranked)), 2)
        child = crossed(ranked[one][1], ranked[other][1], lengths, capacity, rng)
        if rng.random() < 0.5:
            child = mutated(child, lengths, capacity, rng)
        ranked = sorted([*ranked, (fitness(child, capacity), child)], key=lambda x: x[0], reverse=True)[:POPULATION]
    return [p for _, p in ranked]


def _written(packing: Packing, n: int) -> list[int]:
    out = [0] * n
    for number, (_, items) in enumerate(packing):
        for i in items:
            out[i] = number
    return out


def _read(bins: list[int], lengths: list[int], capacity: int) -> Packing:
    items: dict[int, list[int]] = {}
    for i, number in enumerate(bins):
        items.setdefault(number, []).append(i)
    return [(capacity - sum(lengths[i] for i in own), own) for own in items.values()]


def _epoch(islands: DataFrame, capacity: int, epoch: int) -> DataFrame:
    """Rows (grp, island, items, lengths, population) after some generations; ``population`` holds a bin number per item, best first."""

    def rows(columns: list) -> list:
        grp, island, items, lengths, populations = columns
        out = []
        for g, k, sizes, population in zip(grp, island, lengths, populations):
            found = evolved(sizes, [_read(p, sizes, capacity) for p in population], hash((g, k, epoch)), capacity)
            out.append([_written(p, len(sizes)) for p in found])
        return [grp, island, items, lengths, out]

    return per_batch(islands, rows, "grp long, island int, items array<long>, lengths array<int>, population array<array<int>>")


def _packed(groups: DataFrame, capacity: int) -> DataFrame:
    """Best packing of each group: rows (grp, items, lengths, bins)."""
    islands = groups.select("grp", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), "items", "lengths", "population")
    for epoch in range(EPOCHS):
        islands = stored(_epoch(islands.repartition("grp", "island"), capacity, epoch), "islands")
        if epoch < EPOCHS - 1:
            # The elite of each island joins the next one's population.
            elites = islands.select("grp", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.slice("population", 1, 1).alias("elite"))
            islands = islands.join(elites, ["grp", "island"]).select("grp", "island", "items", "lengths", F.concat("elite", "population").alias("population"))
    n_bins = F.array_max(F.col("population")[0])
    return islands.groupBy("grp").agg(F.min_by(F.struct("items", "lengths", F.col("population")[0].alias("bins")), F.struct(n_bins, "island")).alias("best")).select("grp", "best.*")


def _grouped(rows: DataFrame) -> DataFrame:
    """Rows (grp, item, length, bin or null) as one row per group; a given packing opens the population. A group's size is bounded where it is dealt."""
    own = F.sort_array(F.collect_list(F.struct("item", "length", "bin")))
    return (
        rows.groupBy("grp")
        .agg(own.alias("own"))
        .select(
            "grp",
            F.col("own.item").alias("items"),
            F.transform("own.length", lambda x: x.cast("int")).alias("lengths"),
            F.when(F.col("own")[0]["bin"].isNull(), F.array().cast("array<array<int>>"))
            .otherwise(F.array(F.transform("own.bin", lambda b: F.array_position(F.array_distinct("own.bin"), b).cast("int") - 1)))
            .alias("population"),
        )
    )


def _spread(packed: DataFrame) -> DataFrame:
    return packed.select("grp", F.explode(F.arrays_zip("items", "lengths", "bins")).alias("x")).select(
        "grp", F.col("x.items").alias("item"), F.col("x.lengths").cast("long").alias("length"), F.col("x.bins").alias("bin")
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with ``length``) and ``sequence_id`` and ``offset`` for each. Sequence ids are unique, not dense."""
    items = stored(pieces.withColumn("item", F.monotonically_increasing_id()), "pieces")
    small = items.filter(F.col("length") < capacity).select("item", "length")
    n_groups = max(1, -(-small.count() // GROUP))
    dealt = small.select(F.pmod(F.xxhash64("item"), F.lit(n_groups)).alias("grp"), "item", "length", F.lit(None).cast("long").alias("bin"))
    first = stored(_spread(_packed(_grouped(dealt), capacity)), "first")
    bins = first.groupBy("grp", "bin").agg(F.sum("length").alias("used"), F.count("*").alias("n"))
    poor = bins.filter(F.col("used") < FULL * capacity)
    n_poor = poor.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    n_again = max(1, -(-n_poor // GROUP))
    label = (F.col("grp") * (1 << 20) + F.col("bin")).alias("label")
    moved = first.join(poor.select("grp", "bin", F.lit(True).alias("poor")), ["grp", "bin"], "left").select("item", "length", label, "poor")
    moved = stored(moved, "moved")
    again = moved.filter("poor").select(F.pmod(F.xxhash64("label"), F.lit(n_again)).alias("grp"), "item", "length", F.col("label").alias("bin"))
    second = _spread(_packed(_grouped(again), capacity)).select("item", "length", (-(F.col("grp") * (1 << 20) + F.col("bin")) - 1).alias("label"))
    placed = moved.filter("poor IS NULL").select("item", "length", "label").unionByName(second)
    # A sequence holds at most `capacity` pieces, so the running sum below is over a bounded group.
    sequences = placed.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("item", "length"))).alias("own"))
    sums = F.aggregate(
        "own",
        F.array(F.lit(0).cast("long")),
        lambda s, x: F.concat(s, F.array(F.element_at(s, -1) + x["length"])),
    )
    offsets = sequences.select("label", F.explode(F.arrays_zip(F.col("own.item").alias("item"), F.slice(sums, 1, F.size("own")).alias("offset"))).alias("x")).select(
        F.col("x.item").alias("item"), (F.col("label") * 2).alias("sequence_id"), F.col("x.offset").alias("offset")
    )
    alone = items.filter(F.col("length") >= capacity).select("item", (F.col("item") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return items.join(offsets.unionByName(alone), "item").drop("item")
