"""An index of the identities that RAW holds, for idempotent appends whose reads do not grow with RAW.

Every published batch leaves a *run*: the 128-bit hashes of its new identities, dealt by hash to buckets of about ``BUCKET``, and a Bloom
filter of each bucket. ``FAN`` runs of one level are merged into one of the next, so a hash is rewritten once per level and
there are few runs, whatever the number of batches. A batch is looked up in the filters first; only buckets whose filter may hold one of
its identities are read. A run that a batch matches in size is read without asking: among so many identities every bucket is asked for, if only by
wrong answers. Runs are published in the same commit as the rows they index.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.sources.commits import Conflict, Log

BUCKET = 1 << 20
#: Bits of a full bucket's filter (16 a hash) and how many of them a hash sets: one wrong answer in 400. Words without bits are not stored.
BITS, SET = 1 << 24, 4
FAN = 8
#: A batch with that many records for each bucket of a run, and no fewer than the run, reads it whole: ten wrong answers a bucket.
WHOLE = 1 << 12


def hashed(df: DataFrame, identity: Sequence[str]) -> DataFrame:
    """``df`` with its identity's hash as two longs, ``__h`` and ``__g``. A record without its own id is identified by the rest."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in identity]
    digest = F.md5(F.to_json(F.array(*parts)))
    return df.withColumns({n: F.conv(F.substring(digest, at, 16), 16, -10).cast("long") for n, at in (("__h", 1), ("__g", 17))})


def _bucket(buckets: Column) -> Column:
    return F.pmod(F.col("__h"), buckets).cast("int")


def _bits() -> Column:
    """The bits that a hash sets, one row each."""
    one, two = F.shiftrightunsigned("__g", 20), F.shiftrightunsigned("__h", 20)
    return F.explode(F.array(*[F.pmod(one + F.lit(i) * two, F.lit(BITS)).cast("int") for i in range(SET)]))


def names(table: str) -> tuple[str, str, str]:
    """Tables of the index: hashes, filters, and the mark that two appends at once both set."""
    return f"{table}_identities", f"{table}_filters", f"{table}_appends"


def _parts(unit: str) -> tuple[int, int]:
    """Level and number of buckets of a run, from its name."""
    level, buckets, _ = unit.split("-", 2)
    return int(level), int(buckets)


def run_of(log: Log, table: str, identities: DataFrame, n: int, level: int) -> list[dict]:
    """Write a run of ``n`` identities (``__h``, ``__g``); gives the entries that publish it."""
    buckets = max(1, -(-n // BUCKET))
    unit = f"{level}-{buckets}-{uuid.uuid4().hex}"
    dealt = identities.select("__h", "__g", _bucket(F.lit(buckets)).alias("bucket")).repartitionById(buckets, "bucket").sortWithinPartitions("__h", "__g")
    hashes, masks, _ = names(table)
    attempt = log.write({hashes: dealt})[hashes]
    back = log.spark.read.schema(dealt.schema).parquet(log.attempt_path(hashes, attempt))
    bits = back.select("bucket", _bits().alias("bit"))
    word = F.expr("shiftleft(1L, bit & 63)")
    filters = bits.groupBy(F.lit(unit).alias("run"), "bucket", F.shiftright("bit", 6).alias("word")).agg(F.bit_or(word).alias("bits"))
    entry = {"unit": unit, "digest": "", "rows": n, "retired": False}
    return [
        entry | {"table": hashes, "attempt": attempt, "schema": dealt.schema.json()},
        entry | {"table": masks, "attempt": log.write({masks: filters})[masks], "schema": filters.schema.json()},
    ]


def seen_before(log: Log, table: str, batch: DataFrame, n: int = 0) -> tuple[DataFrame | None, int]:
    """Identities (``__h``, ``__g``) of the buckets that may hold one of ``batch``, and the number of these buckets. ``n``: its records, if known."""
    hashes, masks, _ = names(table)
    runs = {u: e for u, e in log.entries(masks).items() if e["rows"]}
    found: dict[str, list[int]] = {u: [*range(_parts(u)[1])] for u, e in runs.items() if n >= max(e["rows"], WHOLE * _parts(u)[1])}
    runs = {u: e for u, e in runs.items() if u not in found}
    if runs:
        found |= _asked(log, masks, runs, batch)
    if not found:
        return None, 0
    entries = log.entries(hashes)
    parts = [log.read(hashes, [entries[run]]).filter(F.col("bucket").isin(buckets)).select("__h", "__g") for run, buckets in found.items()]
    return reduce(DataFrame.unionByName, parts), sum(map(len, found.values()))


def _asked(log: Log, masks: str, runs: dict[str, dict], batch: DataFrame) -> dict[str, list[int]]:
    """By run, the buckets whose filters may hold an identity of ``batch``."""
    listed = F.explode(F.array(*[F.struct(F.lit(u).alias("run"), F.lit(_parts(u)[1]).alias("buckets")) for u in runs])).alias("r")
    own = batch.select("__h", "__g").distinct().select("__h", "__g", listed).select("__h", "__g", "r.run", _bucket(F.col("r.buckets")).alias("bucket"), _bits().alias("bit"))
    own = own.withColumn("word", F.shiftright("bit", 6))
    held = own.join(log.read(masks, runs.values()), ["run", "bucket", "word"]).filter(F.getbit("bits", F.col("bit").bitwiseAND(63)) == 1)
    # A hash may be there if each of its bits is set; two of its bits may be one.
    asked = held.groupBy("run", "bucket", "__h", "__g").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == SET).select("run", "bucket").distinct()
    found: dict[str, list[int]] = {}
    for r in asked.collect():
        found.setdefault(r.run, []).append(r.bucket)
    return found


def merge(log: Log, table: str) -> None:
    """Merge runs of each level that has ``FAN`` of them. Someone else may do it at the same time; then it is left to them."""
    hashes, masks, _ = names(table)
    level = 0
    while True:
        seen = log.head()
        runs = log.entries(hashes)
        own = sorted((u for u in runs if _parts(u)[0] == level), key=lambda u: runs[u]["number"])
        if len(own) >= FAN:
            old = [runs[u] for u in own]
            n = sum(e["rows"] for e in old)
            entries = run_of(log, table, log.read(hashes, old), n, level + 1)
            gone = [{"table": t, "unit": u, "attempt": "", "digest": "", "rows": 0, "schema": "", "retired": True} for t in (hashes, masks) for u in own]
            try:
                log.commit([*entries, *gone], seen)
            except Conflict:
                return
        elif not any(_parts(u)[0] > level for u in runs):
            return
        level += 1
