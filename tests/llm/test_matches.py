"""Benchmark matches, turn repair and word runs against brute force, on odd rows and against their SQL."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from attestry.llm import benchmark_matches, queries, turn_repair, word_runs
from compare import connect, difference

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WHITE = "[^\\x20\\x09-\\x0D]"


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def some_texts(rng, n, sizes, vocabulary=4):
    known = [f"w{i}" for i in range(vocabulary)] + ["Éa", "B", "日本"]
    return [rng.choice([" ", ", ", "\n"]).join(rng.choice(known) for _ in range(rng.choice(sizes))) for _ in range(n)]


def passage(rng, text, size):
    own = words(text)
    at = rng.randrange(max(1, len(own) - size))
    return " - ".join(own[at : at + size]).upper()


def plain_report(docs, items):
    out = []
    for key, text in docs:
        own = words(text)
        hit, found = set(), set()
        for item, test in items:
            w = words(test)
            size = min(10, len(w))
            for s in range(len(w) - size + 1) if size else ():
                for q in range(len(own) - size + 1):
                    if own[q : q + size] == w[s : s + size]:
                        hit |= set(range(q, q + size))
                        found |= {str(item)} if item is not None else set()
        out.append((key, len(own), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [benchmark_matches.BLOCK, 60])
def test_matches_against_all_windows(spark, monkeypatch, block):
    """Also with shards of a few texts, and with many blocks of test items."""
    monkeypatch.setattr(benchmark_matches, "BLOCK", block)
    rng = random.Random(11)
    texts = some_texts(rng, 40, [0, 3, 9, 10, 30, 200], 30)
    docs = [*enumerate(texts), (None, texts[5]), (6, texts[6]), (6, None), (99, ""), (100, "w1 " * 400)]
    items = [(i, t) for i, t in enumerate(some_texts(rng, 5, [0, 1, 5, 10, 25], 30))]
    items += [(100 + i, passage(rng, rng.choice(texts), size)) for i, size in enumerate([4, 9, 10, 11, 14, 40])]
    items += [(7, None), (None, passage(rng, texts[3], 12)), (100, passage(rng, texts[3], 12)), (200, "w1 " * 10)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(map(tuple, benchmark_matches.report(df, benchmark).collect()), key=repr)
    assert got == plain_report(docs, items)
    clean = benchmark_matches.decontaminate(df.withColumn("kept", F.lit("own")), benchmark)
    assert clean.columns == ["doc_id", "text", "kept"]
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=repr) == sorted((d for d, r in zip(docs, [plain_report([d], items)[0] for d in docs]) if not r[-1]), key=repr)


def test_longest_matches_and_their_places(spark):
    rng = random.Random(12)
    texts = some_texts(rng, 12, [30, 80], 3)
    items = [(str(i), t) for i, t in enumerate([*some_texts(rng, 2, [12, 40], 3), passage(rng, texts[0], 25), passage(rng, texts[1], 6)])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = benchmark_matches.longest_matches(df, spark.createDataFrame(items, "item_id string, text string"))
    want = set()
    for item, test in items:
        w = words(test)
        for s in range(max(1, len(w) - 9)):
            ends = []
            for d, text in enumerate(texts):
                own = words(text)
                for q in range(len(own)):
                    n = 0
                    while q + n < len(own) and s + n < len(w) and own[q + n] == w[s + n]:
                        n += 1
                    ends.append((n, d, q))
            best = max(e[0] for e in ends)
            if best >= min(10, len(w)):
                want |= {(item, s, best, d, q) for n, d, q in ends if n == best}
    assert {tuple(r) for r in got.collect()} == want and want


def test_suffix_array_is_sorted_to_its_depth():
    rng = random.Random(13)
    texts = [t.encode() for t in some_texts(rng, 8, [0, 5, 60], 2) * 3]
    shard = benchmark_matches.Shard(texts, 50)
    suffixes = []
    for at in shard.sa.tolist():
        end = at + int(np.flatnonzero(shard.line[at:] == 0)[0])
        suffixes.append(tuple(shard.line[at : min(end, at + 50)].tolist()))
    assert suffixes == sorted(suffixes) and len(suffixes) == shard.counts.sum()


def test_matches_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert benchmark_matches.report(none, items).collect() == []
    row = benchmark_matches.report(spark.createDataFrame([(1, "a b")], none.schema), items.limit(0)).first()
    assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (2, 0, 0, False)
    assert benchmark_matches.longest_matches(none, items).collect() == []


# --- turn repair ------------------------------------------------------------------------------

NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}


def cheapest(kinds):
    """Cost and letters of the least edits, by cost and then letters, over all paths."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, letters, i, state = heapq.heappop(heap)
        if i == len(kinds) and state in ("", "a"):
            return cost, letters
        if (i, state) in seen:
            continue
        seen.add((i, state))
        steps = [(5, "I", i, c) for c in NEXT[state] if c != "s"]
        if i < len(kinds):
            role, fault = divmod(kinds[i], 4)
            more = 5 if fault == 3 else 0
            steps.append((2, "D", i + 1, state))
            if fault not in (1, 2):
                steps += [(more, "K", i + 1, c) for c in NEXT[state] if role < 3 and c == "sua"[role]]
                steps += [(1 + more, "R", i + 1, c) for c in NEXT[state] if c != "s"]
        for price, letter, j, c in steps:
            heapq.heappush(heap, (cost + price, letters + letter, j, c))


def test_edits_against_all_paths():
    rng = random.Random(14)
    for _ in range(3000):
        kinds = [rng.choice([0, 4, 8, 12]) + rng.choice([0, 0, 0, 0, 1, 2, 3]) for _ in range(rng.randint(0, 12))]
        cost, steps = turn_repair.tight_edits(kinds)
        assert (cost, "".join(steps).translate(turn_repair.AUDIT)) == cheapest(kinds)
        assert len(steps) == len(kinds)


def plain_audit(rows):
    """The contract, row by row, for rows (conv_id, turn, role, text) of one conversation."""
    left = []
    show = lambda v: " " if v is None else str(v)
    for conv, turn, role, text in rows:
        role, text = show(role), show(text)
        damage = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        if damage:
            text = "" if damage == 1 else re.sub("[.!?]", "", text) if damage == 2 else text
            left += [(turn, "user" if damage == 4 else role, text)] * (2 if damage == 3 else 1)
    left.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    seen, kinds = set(), []
    for _, role, text in left:
        solid = re.findall(WHITE, text)
        fault = 1 if not solid else 2 if (role, text) in seen else 3 if solid[-1] not in ".!?" else 0
        seen.add((role, text))
        kinds.append(({"s": 0, "u": 1, "a": 2}.get(role[:1], 3)) * 4 + fault)
    cost, audit = cheapest(kinds)
    lines, i, state = [], 0, ""
    for letter in audit:
        if letter == "D":
            i += 1
            continue
        state = left[i][1][0] if letter == "K" else "a" if state == "u" else "u"
        role = left[i][1] if letter == "K" else {"u": "user", "a": "assistant"}[state]
        lines.append(f"{role}:{'' if letter == 'I' else left[i][2]}")
        i += letter != "I"
    turns = [t for t, *_ in left if t is not None]
    first = [r[1][:1] for r in left]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[sum(k % 4 == f for k in kinds) for f in (1, 2, 3)],
        sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def odd_conversations(rng):
    texts = ["Yes.", "no", " ", "", "Hm!  ", None, "Long. " * 50, "a\n?"]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", "user", "assistant", None]), rng.choice(texts)) for c in range(60) for t in range(rng.randint(1, 9))]
    rows += rows[:40] + [(None, None, "user", "Hi."), (None, 1, "assistant", "Ho."), (None, None, "user", "Hi."), (61, None, None, None), (62, 2**40, "user", "x."), (62, 5, "user", "x.")]
    # A long conversation over several blocks and partitions.
    return rows + [(63, i, ("user", "assistant")[i % 2] if rng.random() < 0.95 else "user", f"t{rng.randrange(4000)}." if rng.random() < 0.9 else "cut") for i in range(9000)]


def test_audit_against_row_by_row(spark):
    rows = odd_conversations(random.Random(15))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("pos", F.lit("own"))
    got = {r.conv_id: tuple(r)[1:] for r in turn_repair.audit(df.select("conv_id", "turn", "role", "text", "pos")).collect()}
    want = {c: plain_audit([r for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    assert got == want
    assert turn_repair.audit(df.limit(0)).collect() == []


def test_repaired_rows_read_well(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "user", "Hi."), (1, 3, "tool", "Done."), (2, 0, "assistant", "Lost."), (3, 0, "user", "Why?")]
    out = turn_repair.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).orderBy("conv_id", "pos", "n").collect()
    assert [(r.conv_id, r.turn, r.role, r.text) for r in out] == [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 3, "assistant", "Done.")]


# --- word runs --------------------------------------------------------------------------------


def plain_runs(ids):
    found = {}
    for q in range(1, len(ids) // 3 + 1):
        i = 0
        while i + q < len(ids):
            j = i
            while j + q < len(ids) and ids[j] == ids[j + q]:
                j += 1
            if j > i and j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e, q) for (s, e), q in found.items())


def periodic(rng, letters):
    out = []
    for _ in range(rng.randint(0, 6)):
        kind = rng.random()
        if kind < 0.4:
            out += [rng.randrange(letters) for _ in range(rng.randint(0, 40))]
        elif kind < 0.9:
            out += ([rng.randrange(letters) for _ in range(rng.randint(1, 15))] * 90)[: rng.randint(2, 90)]
        elif out:
            at = rng.randrange(len(out))
            out += out[at : at + rng.randint(1, 100)]
    return out


def test_runs_against_all_periods():
    rng = random.Random(16)
    total = 0
    for _ in range(1500):
        ids = periodic(rng, rng.choice([1, 2, 3, 5]))
        found = word_runs.runs(np.array(ids, np.int64))
        assert found == plain_runs(ids)
        total += len(found)
    assert total > 1000


def test_grammar_gives_the_words_back():
    rng = random.Random(17)
    for _ in range(300):
        ids = periodic(rng, 2)
        rules, rest = word_runs.re_pair(ids)

        def words_of(symbol):
            return [-1 - symbol] if symbol < 0 else words_of(rules[symbol][0]) + words_of(rules[symbol][1])

        assert [w for s in rest for w in words_of(s)] == ids
        pairs = list(zip(rest, rest[1:]))
        # No pair is left twice, but for places of equal symbols that overlap.
        assert all(pairs.count(p) < 2 or p[0] == p[1] for p in pairs)


def test_runs_of_odd_rows(spark):
    rows = [(1, "a b c " * 20), (1, "a b c " * 20), (None, "x " * 30), (2, None), (3, ""), (4, " \n\t\x0b"), (5, " ".join(f"w{i}" for i in range(50_000)))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit("own"))
    got = {(r.doc_id, r.n_runs, r.length, r.period, r.exponent_milli) for r in word_runs.digests(df).collect()}
    assert {g for g in got if g[0] != 5} >= {(None, 1, 30, 1, 30000), (2, 0, None, None, None), (3, 0, None, None, None), (4, 0, None, None, None)}
    assert word_runs.digests(df.limit(0)).collect() == []
    found = word_runs.detect(df.filter("doc_id = 1")).collect()
    assert [[(x.start, x.length, x.period) for x in r.runs] for r in found] == [[(0, 60, 3)]] * 2


def test_planting_follows_the_checksum():
    own = [f"w{i}" for i in range(100)]
    for key in range(200):
        h = zlib.crc32(str(key).encode())
        g, n = h // 10, len(own)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        want = [own[i] if i < a else own[a + (i - a) % p] for i in range(n)] if h % 10 == 0 else own
        assert word_runs.planted(own, key) == want


# --- SQL --------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["op11_benchmark_matches", "op12_turn_repair", "op13_word_runs"])
def test_sql_gives_the_same(spark, name):
    folder = "/root/testdata/sf0.001"
    assert difference(queries.QUERIES[name](spark, folder), connect(folder), queries.ORACLES[name]) is None


def test_sql_repairs_odd_conversations_alike(spark):
    rows = [r for r in odd_conversations(random.Random(18)) if r[0] != 63]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    con = duckdb.connect()
    con.register("conversations", df.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    assert difference(turn_repair.audit(df), con, queries.ORACLES["op12_turn_repair"]) is None
