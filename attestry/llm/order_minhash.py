"""Near-duplicates by order MinHash, verified by a banded alignment.

A text is the sequence of its words (lower case, split at white space). Its k-mers are the runs of ``K`` words, each labelled with how often
it occurred before; a shorter text is one k-mer. For each of ``SKETCHES`` hash functions the ``PICKED`` labelled k-mers of smallest hash
are taken and hashed in their text order, so two texts agree on a sketch only if they share these k-mers in the same order. Texts that agree
on a sketch are candidates. Similarity is that of an alignment of the words: with M the longest chain of equal words in the same order,
M / (n1 + n2 - M). At similarity S at most (1 - S) / (1 + S) of all words stay unmatched, which bounds how far an aligned word can have
moved: the band. Texts with similarity ``SIMILARITY`` or more are linked, and linked texts form a group. One changed word costs one word of the
alignment and five k-mers of the sketches: of pairs of 300 words with 2, 5 and 10 % of them replaced at random, 1.00, 1.00 and 0.90 share a
sketch, and then they are linked (11 % is the limit).

Scale: equal texts are one class from the start (128 hash bits, pre-aggregated). Within a bucket of a sketch, classes are first compared
with one leader only. Buckets that then still span several groups get ``GROWTH`` random leaders, then ``GROWTH`` times as many, until all
their members have been leaders: a large group of copies costs one comparison per member, and no pair of different groups that shares a
sketch is left out but by the signatures: blocks of leaders meet blocks of members in tasks of bounded size, and a pair is only aligned, in
the first bucket it shares, if its one-permutation signatures (``BINS`` bins of four bits) allow for the k-mers that are left at the limit
when the changed words lie as far apart as they can (``LIKELY``, less three deviations), and if no other link has joined the two yet. Only
links leave the task. Intermediate tables lie in the shared folder.

Defined results: null texts count as empty; all empty texts are one class; null ids sort last; of repeated rows one is kept; texts of any length
are read and aligned whole; ties in a sketch are broken by place; an empty table gives an empty one. Rows and columns of the input, whatever
their names, are otherwise untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.llm.components import Merged, representatives
from attestry.llm.tables import Recent, per_batch, ship, stored, text_of

K = 5
SIMILARITY = 0.8
PICKED = 3
SKETCHES = 32
GROWTH = 4096
BLOCK = 512
BULK = 2_000_000
BINS = 512
#: Share of bins that agree at the limit: with a ninth of the words changed 4/9 of the k-mers are left on each side, and a sixteenth agrees by chance.
LIKELY = 0.33

_MIX = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.uint64(0xD6E8FEB86659FD93)
_ROWS = np.array([xxhash.xxh3_64_intdigest(f"sketch {j}") for j in range(SKETCHES)], dtype=np.uint64)
_BASE = np.uint64(1_000_003)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return x ^ (x >> np.uint64(32))


_hashes = Recent(xxhash.xxh3_64_intdigest)


def words_of(text: str | None) -> np.ndarray:
    """Hashes of the words of ``text``."""
    words = (text or "").lower().split()
    return np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))


def labelled(words: np.ndarray, k: int = K) -> np.ndarray:
    """Hashes of the k-mers with their occurrence numbers; all different."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64)
    width = min(k, n)
    kmers = np.zeros(n - width + 1, np.uint64)
    for i in range(width):
        kmers = (kmers * _BASE) ^ _mixed(words[i : i + len(kmers)])
    kmers = _mixed(kmers)
    order = np.argsort(kmers, kind="stable")
    ranked = kmers[order]
    first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    if len(first) == n - width + 1:
        return kmers
    numbers = np.arange(len(ranked)) - np.repeat(first, np.diff(np.append(first, len(ranked))))
    out = np.empty_like(kmers)
    out[order] = ranked + _mixed(numbers.astype(np.uint64)) * (numbers > 0).astype(np.uint64)
    return out


def sketch(kmers: np.ndarray, picked: int = PICKED) -> list[int]:
    """One hash per function of the picked k-mers in text order; none for an empty text."""
    if len(kmers) == 0:
        return []
    out = []
    step = max(1, 2_000_000 // len(kmers))
    for at in range(0, SKETCHES, step):
        rows = (kmers[None, :] ^ _ROWS[at : at + step, None]) * _ODD
        rows ^= rows >> np.uint64(31)
        if rows.shape[1] > picked:
            places = np.sort(np.argpartition(rows, picked - 1, axis=1)[:, :picked], axis=1)
        else:
            places = np.tile(np.arange(rows.shape[1]), (len(rows), 1))
        value = np.zeros(len(rows), np.uint64)
        for column in range(places.shape[1]):
            value = (value * _BASE) ^ kmers[places[:, column]]
        out += _mixed(value).view(np.int64).tolist()
    return out


def signature(kmers: np.ndarray) -> list[int]:
    """Four bits of the smallest hash in each of the bins, 16 bins to a long, then a bit for each bin that holds any."""
    hashes = np.sort(_mixed(kmers ^ _ROWS[0]))
    first = np.searchsorted(hashes, np.arange(BINS, dtype=np.uint64) << np.uint64(64 - 9))
    used = (first < len(hashes)) & (np.append(first[1:], len(hashes)) > first)
    bits = np.zeros(BINS, np.uint64)
    bits[used] = hashes[first[used]] & np.uint64(15)
    packed = np.bitwise_or.reduce(bits.reshape(-1, 16) << (np.arange(16, dtype=np.uint64) * np.uint64(4)), axis=1)
    masks = np.bitwise_or.reduce(used.astype(np.uint64).reshape(-1, 64) << np.arange(64, dtype=np.uint64), axis=1)
    return np.concatenate((packed, masks)).view(np.int64).tolist()


def may_be_similar(sa: np.ndarray, sb: np.ndarray) -> np.ndarray:
    """Row by row, whether two signatures allow for the similarity. Bins that are empty on both sides say nothing."""
    x = sa[:, : BINS // 16] ^ sb[:, : BINS // 16]
    x = (x | x >> np.uint64(1) | x >> np.uint64(2) | x >> np.uint64(3)) & np.uint64(0x1111111111111111)
    used = np.bitwise_count(sa[:, BINS // 16 :] | sb[:, BINS // 16 :]).sum(axis=1, dtype=np.int64)
    return used - np.bitwise_count(x).sum(axis=1, dtype=np.int64) >= LIKELY * used - 3 * np.sqrt(LIKELY * (1 - LIKELY) * used)


def likely_pairs(j: int, a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and ``b``, each (components, sketches, signatures) of members of one bucket of sketch ``j``, of the pairs to align: of two
    components, in the first bucket they share, with signatures that allow for it."""
    open_ = a[0][:, None] != b[0][None, :]
    for i in range(j):
        open_ &= a[1][:, None, i] != b[1][None, :, i]
    x, y = np.nonzero(open_)
    found = [may_be_similar(a[2][x[at : at + 20_000]], b[2][y[at : at + 20_000]]) for at in range(0, len(x), 20_000)]
    keep = np.concatenate(found) if found else np.zeros(0, bool)
    return x[keep], y[keep]


def similarity(a: np.ndarray, b: np.ndarray, limit: float = SIMILARITY) -> float:
    """Of two arrays of words; 0 where it is below ``limit``. Only words inside the band are aligned.

    The alignment is computed for all places of ``b`` at once, as the bits of one number.
    """
    total = len(a) + len(b)
    if total == 0:
        return 1.0
    least = limit / (1 + limit) * total
    if min(len(a), len(b)) < least - 1e-9:
        return 0.0
    band = int(total - 2 * least) + 1
    n = min(len(a), len(b))
    same = a[:n] == b[:n]
    head = n if same.all() else int(same.argmin())
    same = a[len(a) - n + head :][::-1] == b[len(b) - n + head :][::-1]
    tail = len(same) if same.all() else int(same.argmin())
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    matched = head + tail
    if len(a) and len(b):
        # No chain is longer than the words that both have.
        (words_a, count_a), (words_b, count_b) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
        _, at_a, at_b = np.intersect1d(words_a, words_b, assume_unique=True, return_indices=True)
        if matched + np.minimum(count_a[at_a], count_b[at_b]).sum() < least - 1e-9:
            return 0.0
        places: dict[int, int] = {}
        for i, word in enumerate(b.tolist()):
            places[word] = places.get(word, 0) | 1 << i
        every, width = (1 << len(b)) - 1, (1 << (2 * band + 1)) - 1
        free = every
        for i, word in enumerate(a.tolist()):
            here = places.get(word)
            if here is not None:
                here &= width << (i - band) if i > band else width >> (band - i)
                met = free & here
                free = ((free + met) | (free - met)) & every
        matched += len(b) - free.bit_count()
    value = matched / (total - matched)
    return value if value >= limit - 1e-12 else 0.0


def _keys() -> list:
    text = text_of()
    return [F.xxhash64(text).alias("_a"), F.xxhash64(F.lit(1), text).alias("_b")]


def groups(docs: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Classes of equal texts and their groups.

    The first table has a row per row of ``docs`` (key, _a, _b), the second a row per class: _a, _b, its smallest key and number of rows,
    and of its group the smallest (key, _a, _b) as ``top`` and how many found links it has: enough of them to join the group, not all there are.
    """
    kind = dict(docs.dtypes)[key]

    def sketches(columns: list) -> list:
        a, b, keys, texts = columns
        words = [words_of(t) for t in texts]
        kmers = [labelled(w) for w in words]
        return [a, b, keys, [sketch(k) for k in kmers], [signature(k) for k in kmers], [len(w) for w in words]]

    rows = stored(
        per_batch(docs.select(*_keys(), F.col(key), "text"), sketches, f"_a long, _b long, `{key}` {kind}, sketch array<long>, sign array<long>, n_words long"),
        "sketches",
    )
    least = F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key")))
    classes = rows.groupBy("_a", "_b").agg(least.alias("least"), F.count("*").alias("n_rows"), F.first("sketch").alias("sketch"), F.first("sign").alias("sign"), F.first("n_words").alias("n_words"))
    classes = stored(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    members = classes.select("cid", "n_words", F.posexplode("sketch").alias("j", "v"))
    sizes = members.groupBy("j", "v").agg(F.min("cid").alias("lead"), F.count("*").alias("n"), F.sum("n_words").alias("bulk")).filter("n > 1")
    shared = stored(members.drop("n_words").join(sizes, ["j", "v"]), "buckets")

    candidates = shared.select("cid").distinct().join(classes.select("cid", "_a", "_b"), "cid")
    texts = docs.select(*_keys(), text_of().alias("text")).join(candidates, ["_a", "_b"])

    def sequences(columns: list) -> list:
        cids, found = columns
        return [cids, [words_of(t).astype("<u4").tobytes() for t in found]]

    # One row of each class: equal texts meet pre-aggregated, and only classes with candidates are here.
    words = per_batch(texts.select("cid", "text"), sequences, "cid long, words binary").groupBy("cid").agg(F.first("words").alias("words"))
    # With all that a comparison needs, so that the rows of open buckets are joined once.
    words = stored(words.join(classes.select("cid", "sketch", "sign"), "cid"), "words")
    links = verified(shared.filter("cid <> lead").select(F.col("lead").alias("a"), F.col("cid").alias("b")).distinct(), words)
    labels = representatives(links)

    largest = shared.agg(F.max("n")).first()[0] or 0
    share = 0
    while GROWTH**share < largest:
        placed = shared.join(labels.withColumnRenamed("id", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
        spans = placed.groupBy("j", "v").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("j", "v")
        # Leaders of a round are drawn by hash: about GROWTH ** (share + 1) of a bucket's members that have not led before.
        draw = F.pmod(F.xxhash64("cid", F.lit("leader")), F.lit(1 << 30)) / float(1 << 30)
        before = F.lit(0.0) if share == 0 else F.lit(float(GROWTH**share)) / F.col("n")
        now = F.lit(float(GROWTH ** (share + 1))) / F.col("n")
        open_rows = placed.join(spans, ["j", "v"]).withColumn("draw", draw).filter(F.col("draw") >= before)
        open_rows = stored(open_rows.select("cid", "component", "j", "v", "n", "bulk", (F.col("draw") < now).alias("leads")), "open")
        if open_rows.isEmpty():
            break
        open_rows = open_rows.join(words, "cid")
        more = stored(compared(open_rows, GROWTH ** (share + 1)), "links")
        links = links.unionByName(more)
        if not more.isEmpty():
            labels = representatives(links)
        share += 1

    placed = classes.join(labels.withColumnRenamed("id", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    tops = placed.groupBy("component").agg(F.min(F.struct("least.none", "least.key", "_a", "_b")).alias("top"), F.sum("n_rows").alias("group_rows"))
    degrees = links.select(F.explode(F.array("a", "b")).alias("cid")).groupBy("cid").agg(F.count("*").alias("n_links"))
    out = placed.join(tops, "component").join(degrees, "cid", "left")
    return rows.select(key, "_a", "_b"), out.select("_a", "_b", "n_rows", "top", "group_rows", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def compared(rows: DataFrame, leaders: int) -> DataFrame:
    """Links (a, b) between components among the members of each bucket, of which about ``leaders`` lead; of links inside a group, those of a forest.

    Leaders are dealt into blocks of about ``BLOCK`` members or ``BULK`` words, all members into blocks of four times that, and each pair of
    blocks is compared in one group, so a group is bounded whatever the size of its bucket. Of two leaders, the smaller one compares.
    """
    blocks = F.greatest(F.col("n") / BLOCK, F.col("bulk") / BULK)
    n_a = F.ceil(blocks * F.least(F.lit(1.0), F.lit(leaders) / F.col("n"))).cast("int")
    placed = rows.withColumns({"n_a": n_a, "n_b": F.ceil(blocks / 4).cast("int")})
    own_a, own_b = F.pmod(F.xxhash64("cid", F.lit("a")), "n_a").cast("int"), F.pmod(F.xxhash64("cid", F.lit("b")), "n_b").cast("int")
    data = ["j", "v", "cid", "component", "leads", "sketch", "sign", "words"]
    first = placed.filter("leads").select(*data, F.lit(True).alias("first"), own_a.alias("block_a"), F.explode(F.sequence(F.lit(0), F.col("n_b") - 1)).alias("block_b"))
    second = placed.select(*data, F.lit(False).alias("first"), F.explode(F.sequence(F.lit(0), F.col("n_a") - 1)).alias("block_a"), own_b.alias("block_b"))
    ship(rows.sparkSession)

    def side(part: pa.Table) -> tuple:
        longs = [part.column(c).combine_chunks().flatten().to_numpy().view(np.uint64).reshape(part.num_rows, -1) for c in ("sketch", "sign")]
        return part.column("component").to_numpy(), *longs

    def compare(group: pa.Table) -> pa.Table:
        is_first = group.column("first")
        a, b = group.filter(is_first), group.filter(pc.invert(is_first))
        found: list[tuple[int, int]] = []
        if a.num_rows and b.num_rows:
            ids_a, ids_b = a.column("cid").to_numpy(), b.column("cid").to_numpy()
            x, y = likely_pairs(group.column("j")[0].as_py(), side(a), side(b))
            once = ~b.column("leads").to_numpy()[y] | (ids_a[x] < ids_b[y])
            of_a, of_b = a.column("component").to_pylist(), b.column("component").to_pylist()
            words_a, words_b = a.column("words"), b.column("words")
            text_a, text_b = Recent(lambda i: _words(words_a[i].as_py())), Recent(lambda i: _words(words_b[i].as_py()))
            merged = Merged()
            for i, k in zip(x[once].tolist(), y[once].tolist()):
                if merged.top(of_a[i]) != merged.top(of_b[k]) and similarity(text_a[i], text_b[k]) > 0:
                    merged.join(of_a[i], of_b[k])
                    found.append((int(ids_a[i]), int(ids_b[k])))
        return pa.table({"a": pa.array([i for i, _ in found], pa.int64()), "b": pa.array([k for _, k in found], pa.int64())})

    return first.unionByName(second).groupBy("j", "v", "block_a", "block_b").applyInArrow(compare, "a long, b long")


def _words(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u4")


def verified(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts are similar enough, written to the shared folder."""
    left = words.select(F.col("cid").alias("a"), F.col("words").alias("wa"))
    right = words.select(F.col("cid").alias("b"), F.col("words").alias("wb"))

    def check(columns: list) -> list:
        out = []
        for a, b, wa, wb in zip(*columns):
            if similarity(_words(wa), _words(wb)) > 0:
                out.append((a, b))
        return [[a for a, _ in out], [b for _, b in out]]

    return stored(per_batch(pairs.join(left, "a").join(right, "b").select("a", "b", "wa", "wb"), check, "a long, b long"), "links")


def near_duplicates(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: its key, the class id (smallest key of its group), rows of the group, found links of its text, kept."""
    rows, classes = groups(docs, key)
    joined = rows.join(classes, ["_a", "_b"])
    first = (F.col("_a") == F.col("top._a")) & (F.col("_b") == F.col("top._b")) & F.col(key).eqNullSafe(F.col("top.key"))
    return joined.select(key, F.col("top.key").alias("class_id"), "group_rows", "n_links", first.alias("kept"))


def keep_one(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each group: that of the smallest key."""
    _, classes = groups(docs, key)
    own = (F.col("_a") == F.col("top._a")) & (F.col("_b") == F.col("top._b"))
    tops = classes.filter(own).select("_a", "_b", F.col("top.key").alias("_key"), "n_rows")
    carried = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("_row"), F.col(key).alias("_own"), *_keys())
    found = carried.join(tops, ["_a", "_b"]).filter(F.col("_own").eqNullSafe(F.col("_key")))
    # Only a class with several rows can hold the same key twice.
    single = found.filter("n_rows = 1").select("_row")
    several = found.filter("n_rows > 1").groupBy("_a", "_b").agg(F.first("_row").alias("_row")).select("_row")
    return single.unionByName(several).select("_row.*")
