"""Near-duplicate vectors by spherical-cap filters.

Filters are unit directions from a random product code: a direction is the concatenation of one of W unit vectors for each of P parts of the
vector, so there are W ** P of them, and a vector's product with one is the mean of its parts' products. Vectors are turned by one fixed random
rotation first, so that the lengths of their parts do not depend on which coordinates they use. Each vector is list-decoded to all filters
whose product exceeds a limit: codewords of each part are sorted by product, and a combination is followed only while the best of the
remaining parts can still reach the limit. A vector always gets at least its ``LEAST`` best filters. Vectors of one label that share a filter
are compared exactly, in double precision; a pair counts in the first filter it shares.

The code grows with the label: among n vectors a filter is to hold about ``BUCKET``, so it takes a share p = BUCKET / n of all directions; a
vector is to have w = ``WANTED`` + 2 log2(n / BUCKET) filters, as a pair shares a narrow one less often, so there are w / p of them, and the limit is
set to give w. Two vectors at random then share a filter with a probability of about w * p, which falls as the label grows, and each vector is
compared with about w * BUCKET others. A label of BUCKET vectors or fewer has one filter, that of all directions.

Pairs at cosine 0.98 share a filter with a probability of 0.98 or more, measured from 1,000 to 16 million vectors (the tests repeat it).

Scale: filters are keys, so work is joined by (label, filter); equal vectors are one class before that. A filter's vectors are dealt into
blocks of about ``BLOCK``, and each pair of blocks is compared as a group of its own: no unbounded group meets in one task. The number of
members decides only how many blocks there are. A task gives out how many links each of its vectors has, and a forest that joins the
linked ones, not the links: as a pair counts in one place, degrees add up. ``links`` gives the pairs to who needs them.

Defined results: a null, zero or empty vector, or one with null or non-finite components, and any with a null label, links with nothing and is
its own component; vectors of another length than the first are decoded by their own length, however long; repeated rows link with each other
as equal vectors; ties in the first shared filter cannot arise, as filters are numbered; a null id never becomes a component's id; an empty
table gives an empty one; other columns, whatever their names, play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import ceil, log, log2
from statistics import NormalDist
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.llm.components import components
from attestry.llm.tables import per_batch, ship, stored

COSINE = 0.98
BUCKET = 128
WANTED = 6
#: Directions that set the limit of a code.
SAMPLE = 256
#: Codewords of a part, at most.
WORDS = 1024
LEAST = 8
BLOCK = 500
SEED = 10


class Layout(NamedTuple):
    parts: int
    words: int
    limit: float


@lru_cache(maxsize=64)
def code(size: int, parts: int, words: int) -> list[np.ndarray]:
    """For each part of a vector of ``size`` its unit codewords."""
    rng = np.random.default_rng([SEED, size, parts, words])
    out = []
    for part in np.array_split(np.arange(size), parts):
        drawn = rng.standard_normal((words, len(part)))
        out.append(drawn / np.linalg.norm(drawn, axis=1, keepdims=True))
    return out


def _products(vectors: np.ndarray, words: list[np.ndarray]) -> list[np.ndarray]:
    cuts = np.cumsum([w.shape[1] for w in words])[:-1]
    return [part @ w.T for part, w in zip(np.split(vectors, cuts, axis=1), words)]


def _reaching(products: list[np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray]:
    """All combinations of a word of each part whose products add up to ``least``: rows and numbers of filters."""
    n, each = products[0].shape
    best = np.stack([p.max(axis=1) for p in products])
    rows, sums, ids = np.arange(n), np.zeros(n), np.zeros(n, np.int64)
    for i, p in enumerate(products):
        rest = best[i + 1 :, :].sum(axis=0)
        reached = sums[:, None] + p[rows]
        row, word = np.nonzero(reached + rest[rows][:, None] >= least)
        rows, sums, ids = rows[row], reached[row, word], ids[row] * each + word
    return rows, ids


@lru_cache(maxsize=None)
def layout(n: int, size: int) -> Layout:
    """Parts, codewords of each and limit, for a label of ``n`` vectors of ``size`` components.

    The limit is set by bisection, so that ``SAMPLE`` directions drawn at random have the wanted number of filters on average; the
    normal quantile only starts it, as sums of a few parts have thinner tails.
    """
    if n <= BUCKET:
        return Layout(1, 1, float("-inf"))
    wanted = WANTED + 2 * log2(n / BUCKET)
    total = wanted * n / BUCKET
    parts = min(size, max(1, ceil(log(total) / log(WORDS))))
    words = ceil(total ** (1 / parts))
    share = min(wanted / words**parts, 0.9)
    deviation = np.sqrt(parts / size)
    drawn = np.random.default_rng([SEED, size, 2]).standard_normal((SAMPLE, size))
    products = _products(drawn / np.linalg.norm(drawn, axis=1, keepdims=True), code(size, parts, words))
    high = NormalDist().inv_cdf(1 - share) * deviation + 0.5 * deviation
    low = high - 2 * deviation
    for _ in range(12):
        middle = (low + high) / 2
        low, high = (middle, high) if len(_reaching(products, middle)[0]) > wanted * SAMPLE else (low, middle)
    return Layout(parts, words, low)


@lru_cache(maxsize=8)
def rotation(size: int) -> np.ndarray:
    """A random orthogonal matrix."""
    return np.linalg.qr(np.random.default_rng([SEED, size, 1]).standard_normal((size, size)))[0]


def filters(vectors: np.ndarray, n: int) -> list[np.ndarray]:
    """For each unit vector of a label of ``n`` its filters, ascending."""
    size = vectors.shape[1]
    parts, each, limit = layout(n, size)
    if each == 1:
        return [np.zeros(1, np.int64)] * len(vectors)
    products = _products(vectors @ rotation(size), code(size, parts, each))
    rows, ids = _reaching(products, limit)
    poor = np.flatnonzero(np.bincount(rows, minlength=len(vectors)) < LEAST)
    if len(poor):
        # The best combinations are made of the best words of each part.
        top_sums, top_ids = np.zeros((len(poor), 1)), np.zeros((len(poor), 1), np.int64)
        for p in products:
            top = np.argsort(-p[poor], axis=1, kind="stable")[:, :LEAST]
            top_sums = (top_sums[:, :, None] + np.take_along_axis(p[poor], top, axis=1)[:, None, :]).reshape(len(poor), -1)
            top_ids = (top_ids[:, :, None] * each + top[:, None, :]).reshape(len(poor), -1)
            best_of = np.argsort(-top_sums, axis=1, kind="stable")[:, :LEAST]
            top_sums, top_ids = np.take_along_axis(top_sums, best_of, axis=1), np.take_along_axis(top_ids, best_of, axis=1)
        rest = ~np.isin(rows, poor)
        rows = np.concatenate((rows[rest], np.repeat(poor, top_ids.shape[1])))
        ids = np.concatenate((ids[rest], top_ids.ravel()))
    order = np.lexsort((ids, rows))
    rows, ids = rows[order], ids[order]
    return np.split(ids, np.searchsorted(rows, np.arange(1, len(vectors))))


def packed(vector: list) -> bytes:
    """As four-byte numbers where these hold it exactly."""
    wide = np.asarray(vector, np.float64)
    with np.errstate(over="ignore"):
        narrow = wide.astype(np.float32)
    return narrow.tobytes() if (narrow == wide).all() else wide.tobytes()


def unit(vectors: list[bytes], size: int) -> np.ndarray:
    """Unit vectors in double precision."""
    out = np.empty((len(vectors), size))
    for width, kind in ((4, np.float32), (8, np.float64)):
        at = [i for i, v in enumerate(vectors) if len(v) == width * size]
        out[at] = np.frombuffer(b"".join([vectors[i] for i in at]), kind).reshape(len(at), size)
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def usable(vector: list | None) -> bool:
    return bool(vector) and None not in vector and bool(np.isfinite(vector).all()) and bool(np.any(np.asarray(vector, np.float64)))


def _decoded(rows: DataFrame) -> DataFrame:
    """Rows (cid, label, size, n, vector) with their filters."""

    def decode(columns: list) -> list:
        cids, labels, sizes, totals, vectors = columns
        found: list = [[] for _ in cids]
        for kind in set(zip(sizes, totals)):
            at = [i for i, k in enumerate(zip(sizes, totals)) if k == kind]
            for i, ids in zip(at, filters(unit([vectors[i] for i in at], kind[0]), kind[1])):
                found[i] = ids.tolist()
        return [cids, labels, sizes, totals, found]

    return per_batch(rows.select("cid", "label", "size", "n", "vector"), decode, "cid long, label string, size int, n long, filters array<long>")


def near(cids: list[int], blocks: list[int], vectors: list[bytes], size: int, n: int, here: int, lo: int, hi: int, cosine: float) -> list[tuple[int, int]]:
    """The linked pairs of one pair of blocks of one filter whose first common filter this is, as places in ``cids``."""
    order = sorted(range(len(cids)), key=cids.__getitem__)
    matrix = unit([vectors[i] for i in order], size)
    rows, columns = np.nonzero(np.triu(matrix @ matrix.T >= cosine - 1e-9, 1))
    block = np.array(blocks)[order]
    ours = (np.minimum(block[rows], block[columns]) == lo) & (np.maximum(block[rows], block[columns]) == hi)
    rows, columns = rows[ours], columns[ours]
    if not len(rows):
        return []
    met, places = np.unique(np.concatenate((rows, columns)), return_inverse=True)
    first = ~_sharing(filters(matrix[met], n), here)[places[: len(rows)], places[len(rows) :]]
    out = []
    for a, b in zip(rows[first].tolist(), columns[first].tolist()):
        # The dot product of the two alone does not depend on the block they are met in.
        if float(np.dot(matrix[a], matrix[b])) >= cosine:
            out.append((order[a], order[b]))
    return out


def _sharing(own: list[np.ndarray], here: int) -> np.ndarray:
    """Which pairs of vectors share a filter before ``here``, or lack ``here`` itself."""
    ids, who = np.concatenate(own), np.repeat(np.arange(len(own)), [len(ids) for ids in own])
    lacking = np.ones(len(own), bool)
    lacking[who[ids == here]] = False
    out = lacking[:, None] | lacking[None, :]
    who, ids = who[ids < here], ids[ids < here]
    by = np.argsort(ids, kind="stable")
    for members in np.split(who[by], np.flatnonzero(np.diff(ids[by])) + 1):
        if len(members) > 1:
            out[np.ix_(members, members)] = True
    return out


def forest(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Pairs that join what all of them join: one less than there are members in each tree."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for a, b in pairs:
        ta, tb = top(a), top(b)
        if ta != tb:
            parent[max(ta, tb)] = min(ta, tb)
            out.append((a, b))
    return out


def _compared(rows: DataFrame, cosine: float, all_pairs: bool) -> DataFrame:
    """Rows (label, size, n, filter, lo, hi, block, cid, copies, vector), dealt and sorted by their first six, to linked pairs (a, b, null); or, unless
    ``all_pairs``, to pairs of a forest and, with b null, how many rows a vector is linked to."""
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def solved() -> Iterator[pa.RecordBatch]:
            if len(held) < 2:
                return
            blocks, cids, copies, vectors = zip(*held)
            found = near(cids, blocks, vectors, key[1], key[2], key[3], key[4], key[5], cosine)
            if not found:
                return
            out: list[tuple] = [(cids[a], cids[b], None) for a, b in (found if all_pairs else forest(found))]
            if not all_pairs:
                linked: dict[int, int] = {}
                for a, b in found:
                    linked[a] = linked.get(a, 0) + copies[b]
                    linked[b] = linked.get(b, 0) + copies[a]
                out += [(cids[a], None, m) for a, m in linked.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b", "linked"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:6] != key:
                    yield from solved()
                    key, held = row[:6], []
                held.append(row[6:])
        yield from solved()

    return rows.mapInArrow(run, "a long, b long, linked long")


def _found(vectors: DataFrame, key: str, vector: str, label: str, cosine: float, all_pairs: bool) -> tuple[DataFrame, DataFrame]:
    """Rows (row, key, cid or null, copies) of all vectors, and what ``_compared`` finds among the classes of equal vectors."""
    kind = dict(vectors.dtypes)[key]

    def parsed(columns: list) -> list:
        keys, found, labels = columns
        fine = [usable(v) and k is not None for v, k in zip(found, labels)]
        return [keys, [str(k) if ok else None for k, ok in zip(labels, fine)], [len(v) if ok else None for v, ok in zip(found, fine)], [packed(v) if ok else None for v, ok in zip(found, fine)]]

    rows = per_batch(vectors.select(F.col(key).alias("key"), vector, label), parsed, f"key {kind}, label string, size int, vector binary")
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()).withColumn("h", F.sha2("vector", 256)), "vectors")
    live = rows.filter("vector IS NOT NULL")
    classes = live.groupBy("label", "size", "h").agg(F.min("row").alias("cid"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
    classes = stored(classes, "classes")
    # The code of a label depends on its size up to the next power of two, so that few codes are drawn.
    totals = classes.groupBy("label", "size").agg(F.count("*").alias("members")).select("label", "size", F.pow(F.lit(2.0), F.ceil(F.log2("members"))).cast("long").alias("n"))
    sized = classes.join(totals, ["label", "size"])
    spread = stored(_decoded(sized), "decoded").select("cid", "label", "size", "n", F.explode("filters").alias("filter"))
    members = spread.groupBy("label", "size", "filter").agg(F.count("*").alias("m")).filter("m > 1")
    dealt = (
        spread.join(members, ["label", "size", "filter"])
        .withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    )
    # Each pair of blocks is a key; a vector goes to the pairs that hold its block.
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(o, F.col("block")).alias("lo"), F.greatest(o, F.col("block")).alias("hi")))
    keys = ["label", "size", "n", "filter", "lo", "hi"]
    own = classes.select("cid", "copies", "vector")
    pairs = dealt.select("label", "size", "n", "filter", "cid", "block", F.inline(others)).join(own, "cid").select(*keys, "block", "cid", "copies", "vector")
    found = stored(_compared(pairs.repartition(*keys).sortWithinPartitions(*keys), cosine, all_pairs), "links")
    return rows.join(classes.select("label", "size", "h", "cid", "copies"), ["label", "size", "h"], "left").select("row", "key", "cid", "copies"), found


def links(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE) -> tuple[DataFrame, DataFrame]:
    """Rows (row, key, cid or null, copies) of all vectors, and the linked pairs (a, b) of classes of equal vectors."""
    rows, found = _found(vectors, key, vector, label, cosine, True)
    return rows.withColumnRenamed("key", key), found.select("a", "b")


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE) -> DataFrame:
    """One row per row of ``vectors``: key, ``n_links`` (other rows linked directly), ``component_id`` (smallest key in reach), ``kept``."""
    rows, found = _found(vectors, key, vector, label, cosine, False)
    rows = stored(rows, "rows")
    degrees = found.filter("b IS NULL").groupBy(F.col("a").alias("cid")).agg(F.sum("linked").alias("linked"))
    labels = components(found.filter("b IS NOT NULL").select("a", "b")).withColumnRenamed("id", "cid")
    placed = rows.join(labels, "cid", "left").join(degrees, "cid", "left").withColumn("component", F.coalesce("component", "cid", -F.col("row") - 1))
    tops = placed.groupBy("component").agg(F.min("key").alias("component_id"))
    return placed.join(tops, "component").select(
        F.col("key").alias(key),
        (F.coalesce("linked", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).cast("long").alias("n_links"),
        "component_id",
        F.col("key").eqNullSafe(F.col("component_id")).alias("kept"),
    )
