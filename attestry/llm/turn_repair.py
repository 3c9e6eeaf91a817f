"""Repair of conversations: the cheapest edits after which turns read ``(s?(ua)+)?``, by a square-root checkpointed dynamic program.

A conversation's rows come by turn (nulls first), then role and the text's digest. A row's first fault counts: blank (nothing but white
space), duplicate (an earlier row has its role and text) or truncated (its last character is none of ``.!?``). Each row is kept (free),
given the role user or assistant (1) or deleted (2, which blank and duplicate rows must be); empty user and assistant turns may be inserted
(5 each); a truncated row that stays costs 5 more. A role counts by its first letter; a row whose role is no s, u or a cannot be kept as it is.

The program's state is the last role written. A vector holds the least cost from a row on for each state. Vectors are computed backwards and
stored at every ``sqrt(n)``-th row only; walking forward, each block's vectors are computed again from the checkpoint at its end, and
of the edits that reach the optimum the one with the least letter (D, I, K, R) is taken, which gives the ASCII-least string.

Scale: equal rows are counted before they are dealt out, and a row learns of an earlier equal one by joining the earliest turn of its role and text.
Rows are range-partitioned by conversation, turn, role and digest, so that a conversation of any size is spread evenly; their faults
and roles, one character each, are gathered by blocks of ``1 << CHUNK`` rows and then by conversation. So the program's task holds one
character a row, as does the string of edits that it returns. Texts stay where they lie: the edits go back to the rows by their place.

Defined results: null roles and texts read as one space; null turns come first; null ids are one conversation; rows that are equal in all
columns are each other's duplicates; other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from attestry.llm.tables import per_batch, ship, stored
from attestry.operators.segments import join_on_key

CHUNK = 12
WHITE = " \t\n\x0b\x0c\r"
#: States: nothing yet, after system, after user, after assistant; and what the next written turn leads to.
NEXT = (2, 2, 3, 2)
FINAL = (0, 10, 5, 0)
DELETE, INSERT, ROLE, TRUNCATED = 2, 5, 1, 5
FAULTS = ("none", "blank", "duplicate", "truncated")
ROLES = "sua"
#: Letters of steps: kept, deleted, role set to user or assistant, user or assistant turn inserted.
AUDIT = str.maketrans("KDUAua", "KDRRII")


@lru_cache(maxsize=None)
def _choices(kind: int) -> tuple[tuple[tuple[int, str, int], ...], ...]:
    """By state the edits (cost, step, next state) that use a row up, in the order of their letters; ``kind`` is four times the role's number
    plus the fault's."""
    role, fault = divmod(kind, 4)
    more = TRUNCATED if fault == 3 else 0
    out = []
    for state in range(4):
        edits = [(DELETE, "D", state)]
        if fault not in (1, 2):
            target = role + 1
            if (target == 1 and state == 0) or (1 < target < 4 and NEXT[state] == target):
                edits.append((more, "K", target))
            edits.append((ROLE + more, "U" if NEXT[state] == 2 else "A", NEXT[state]))
        out.append(tuple(edits))
    return tuple(out)


@lru_cache(maxsize=None)
def _before(kind: int, vector: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    """The vector before a row from the one after it, less its least entry, and that entry. There are few different ones."""
    use = [min(cost + vector[to] for cost, _, to in edits) for edits in _choices(kind)]
    costs = [min(use[s], INSERT + use[NEXT[s]], 2 * INSERT + use[NEXT[NEXT[s]]]) for s in range(4)]
    least = min(costs)
    return tuple(c - least for c in costs), least


def _vectors(kinds: list[int], vector: tuple[int, ...], base: int) -> list[tuple[tuple[int, ...], int]]:
    """Vectors before each of the rows and after the last, from the one after the last."""
    out = [(vector, base)]
    for kind in reversed(kinds):
        vector, more = _before(kind, vector)
        base += more
        out.append((vector, base))
    return out[::-1]


def tight_edits(kinds: list[int]) -> tuple[int, list[str]]:
    """Least cost, and each row's steps: insertions before it, its own, and for the last row insertions after it."""
    n = len(kinds)
    block = isqrt(n) + 1
    vector, base = FINAL, 0
    checkpoints = {n: (vector, base)}
    for at in range(n - 1, -1, -1):
        vector, more = _before(kinds[at], vector)
        base += more
        if at % block == 0:
            checkpoints[at] = (vector, base)
    cost = vector[0] + base
    steps, state = [], 0
    for begin in range(0, n, block):
        end = min(begin + block, n)
        known = _vectors(kinds[begin:end], *checkpoints[end])
        for i, kind in enumerate(kinds[begin:end]):
            (here, low), (after, low_after) = known[i], known[i + 1]
            done = ""
            while True:
                left = here[state] + low
                edits = _choices(kind)[state]
                fits = [(step, to) for price, step, to in edits if price + after[to] + low_after == left]
                # Letters in their order: deletion, insertion, then the others.
                if fits and fits[0][0] == "D":
                    break
                if INSERT + here[NEXT[state]] + low == left:
                    done += "u" if NEXT[state] == 2 else "a"
                    state = NEXT[state]
                    continue
                break
            done += fits[0][0]
            state = fits[0][1]
            steps.append(done)
    tail = ("", "ua", "a", "")[state]
    if steps:
        steps[-1] += tail
    return cost, steps


def faults(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, digest, kind): one for each row of ``rows`` (conv_id, turn, role, text, copies), with its fault and role."""
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")).withColumn("digest", F.sha2("text", 256))
    # False sorts first: a missing turn comes before all others.
    place = F.struct(F.col("turn").isNotNull(), "turn")
    first = counted.groupBy("conv_id", "role", "digest").agg(F.min(place).alias("first"))
    joined = join_on_key(counted, first, ["conv_id", "role", "digest"], "inner", nulls_match=True)
    each = joined.select("conv_id", "turn", "role", "text", "digest", (place > F.col("first")).alias("later"), F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    written = F.rtrim(F.col("text"), F.lit(WHITE))
    fault = F.when(written == "", 1).when(F.col("later") | (F.col("copy") > 1), 2).when(F.substring(written, -1, 1).isin(".", "!", "?"), 0).otherwise(3)
    role = F.substring("role", 1, 1)
    number = F.when(role == "s", 0).when(role == "u", 1).when(role == "a", 2).otherwise(3)
    return each.select("conv_id", "turn", "role", "text", "digest", (number * 4 + fault).alias("kind"))


def placed(rows: DataFrame) -> DataFrame:
    """``faults`` with ``pos``, which rises along each conversation; written, so that places stay what they are."""
    by = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "digest")]
    dealt = faults(rows).repartitionByRange(*by).sortWithinPartitions(*by)
    return stored(dealt.withColumn("pos", F.monotonically_increasing_id()).drop("digest"), "turns")


def solve(turns: DataFrame) -> DataFrame:
    """For ``placed`` turns, one row per conversation: conv_id, blank, duplicate, truncated, illegal, cost, audit, and pieces (pos, steps)."""
    kinds = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "kind"))), lambda x: F.char(x["kind"] + 65)), "")
    chunks = turns.groupBy("conv_id", F.shiftright("pos", CHUNK)).agg(F.min("pos").alias("pos"), kinds.alias("kinds"))
    whole = chunks.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("pos", "kinds"))).alias("chunks"))
    legal = {(0, 1), (1, 2), (2, 1)}

    def rows_of(columns: list) -> list:
        out: list[list] = [[] for _ in range(8)]
        for conv, chunks in zip(*columns):
            codes = [ord(k) - 65 for c in chunks for k in c["kinds"]]
            cost, steps = tight_edits(codes)
            found, roles = [k % 4 for k in codes], [k // 4 for k in codes]
            pieces, at = [], 0
            for c in chunks:
                pieces.append({"pos": c["pos"], "steps": steps[at : at + len(c["kinds"])]})
                at += len(c["kinds"])
            values = (conv, found.count(1), found.count(2), found.count(3), sum(p not in legal for p in zip(roles, roles[1:])), cost, "".join(steps).translate(AUDIT), pieces)
            for column, value in zip(out, values):
                column.append(value)
        return out

    kind = dict(turns.dtypes)["conv_id"]
    schema = f"conv_id {kind}, blank long, duplicate long, truncated long, illegal long, cost long, audit string, pieces array<struct<pos:long,steps:array<string>>>"
    return stored(per_batch(whole, rows_of, schema), "repairs")


def repaired(turns: DataFrame, solved: DataFrame) -> DataFrame:
    """The repaired conversations' rows (conv_id, pos, n, step, turn, role, text), in the order of pos and n; ``turn`` is null for inserted ones."""
    pieces = solved.select(F.explode("pieces").alias("p")).select("p.pos", F.posexplode("p.steps").alias("i", "steps"))
    steps = pieces.select((F.col("pos") + F.col("i")).alias("pos"), "steps")
    each = turns.join(steps, "pos").select("*", F.posexplode(F.split("steps", "")).alias("n", "step")).filter("step NOT IN ('', 'D')")
    role = F.when(F.col("step").isin("u", "U"), "user").when(F.col("step").isin("a", "A"), "assistant").otherwise(F.col("role"))
    added = F.col("step").isin("u", "a")
    return each.select("conv_id", "pos", "n", "step", F.when(~added, F.col("turn")).alias("turn"), role.alias("role"), F.when(added, "").otherwise(F.col("text")).alias("text"))


def repair(conversations: DataFrame) -> DataFrame:
    """The repaired rows of ``conversations`` (conv_id, turn, role, text): see ``repaired``."""
    turns = placed(_clean(conversations).withColumn("copies", F.lit(1)))
    return repaired(turns, solve(turns))


def _clean(conversations: DataFrame) -> DataFrame:
    return conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows damaged by the checksum of their id and turn: dropped, emptied, without full stops, repeated, or given the role user."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    damage: Column = F.crc32(F.concat_ws(":", *shown)) % 20
    rows = _clean(conversations).withColumn("damage", damage).filter("damage <> 0")
    text = F.when(F.col("damage") == 1, "").when(F.col("damage") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("damage") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(F.col("damage") == 3, 2).otherwise(1).alias("copies"))


def _hashed(rows: DataFrame) -> DataFrame:
    """Digest of each conversation's ``role:text`` lines. A digest is one chain, so a conversation's rows stream through one task, in order."""
    schema = f"conv_id {dict(rows.dtypes)['conv_id']}, digest string"
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, chain, done = None, None, []
        for batch in batches:
            for conv, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                line = f"{role}:{text}".encode()
                if chain is not None and conv == held:
                    chain.update(b"\n" + line)
                    continue
                if chain is not None:
                    done.append((held, chain.hexdigest()))
                held, chain = conv, hashlib.sha256(line)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*done), arrow)], schema=arrow)
                done = []
        if chain is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held], arrow.field(0).type), pa.array([chain.hexdigest()])], schema=arrow)

    dealt = rows.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "pos", "n")
    return dealt.select("conv_id", "role", "text").mapInArrow(run, schema)


def audit(conversations: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 after ``damaged``."""
    rows = damaged(conversations)
    turns = placed(rows)
    solved = solve(turns)
    counts = ("blank", "duplicate", "truncated", "illegal", "cost")
    span = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).cast("long")
    parts = [
        conversations.select("conv_id").distinct(),
        turns.groupBy("conv_id").agg(span.alias("gaps")),
        solved.select("conv_id", *counts, "audit"),
        _hashed(repaired(turns, solved)),
    ]
    joined = parts[0]
    for part in parts[1:]:
        joined = joined.unionByName(part, allowMissingColumns=True)
    zeros = [F.coalesce(F.max(c), F.lit(0).cast("long")).alias(c) for c in ("gaps", *counts)]
    return joined.groupBy("conv_id").agg(
        *zeros, F.coalesce(F.max("audit"), F.lit("")).alias("audit"), F.coalesce(F.max("digest"), F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256")
    )
