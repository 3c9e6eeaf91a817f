"""Quality rules as a bitmask ledger: measure once, keep the failures as bits, decide later by policy.

``ledger`` evaluates every rule once per row and stores the measurements beside one long whose bit ``i`` says that rule ``i`` failed.
A policy is a version and a mask of rules, so a changed policy, several policies side by side and the effect of leaving one rule out
are bit operations over the ledger and never read the texts again.

Defined results: a null text counts as empty and fails ``few_words``; a null id is carried along; repeated rows get the same result
each; an empty table gives an empty ledger. Only ``text`` is read, so other columns may have any name; ledger columns win over
columns of the same name. All work is column expressions inside one scan, without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.llm.tables import text_of

# What counts as a word and as a symbol.
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")


@dataclass(frozen=True)
class Rule:
    """``failed`` is SQL over the measurements; ``bit`` never changes once a ledger has been written."""

    bit: int
    name: str
    failed: str


RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > 4 * n_words"),
    Rule(3, "short_words", "word_chars < 2 * n_words"),
    Rule(4, "long_words", "word_chars > 14 * n_words"),
    Rule(5, "repeated_lines", "n_dup_lines > 2 AND 100 * n_dup_lines > 30 * n_lines"),
    Rule(6, "capitals", "2 * n_capitals > word_chars"),
)

#: Policy versions: the rules that reject.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "capitals"),
    "v2": ("few_words", "repeated_windows", "symbols", "short_words", "long_words", "repeated_lines", "capitals"),
}
CURRENT = "v2"


def mask_of(rules: tuple[str, ...]) -> int:
    return sum(1 << r.bit for r in RULES if r.name in rules)


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` with the measurements as long columns."""
    text = text_of()
    # Own columns travel in a struct, so none clashes with the names used below.
    names = [c for c in docs.columns if c not in MEASURES]
    kept = [F.col("_own").getField(c).alias(c) for c in names]
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))
    return (
        docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_own"), text.alias("_text"), words.alias("_words"), lines.alias("_lines"))
        .withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long"))
        .withColumn("n_symbols", F.regexp_count("_text", F.lit(SYMBOLS)).cast("long"))
        .withColumn("n_capitals", F.regexp_count("_text", F.lit("[A-Z]")).cast("long"))
        .withColumn("n_lines", F.size("_lines").cast("long"))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .withColumn("_low", F.expr("shiftleft(1L, length(bin(size(_words)))) - 1"))
        # Windows as `hash bits | position`: in a sort of plain longs, equal windows become neighbours.
        .withColumn(
            "_sorted",
            F.expr(
                "CASE WHEN size(_words) < 3 THEN array() ELSE sort_array(transform(sequence(0, size(_words) - 3), "
                "i -> (xxhash64(_words[i], _words[i + 1], _words[i + 2]) & ~_low) | i)) END"
            ),
        )
        # Neighbours of equal hash bits, then the positions of those that are equal word by word.
        .withColumn(
            "_pairs",
            F.expr("CASE WHEN size(_sorted) < 2 THEN array() ELSE filter(sequence(1, size(_sorted) - 1), k -> ((_sorted[k] ^ _sorted[k - 1]) & ~_low) = 0) END"),
        )
        .withColumn("_pairs", F.expr("transform(_pairs, k -> array(int(_sorted[k - 1] & _low), int(_sorted[k] & _low)))"))
        .withColumn(
            "_places",
            F.expr(
                """sort_array(array_distinct(flatten(filter(_pairs, p -> _words[p[0]] = _words[p[1]]
                    AND _words[p[0] + 1] = _words[p[1] + 1] AND _words[p[0] + 2] = _words[p[1] + 2]))))"""
            ),
        )
        # Each window covers its three words; what the next one covers too counts there.
        .withColumn(
            "n_repeat_words",
            F.expr(
                "aggregate(transform(_places, (p, k) -> CASE WHEN k = size(_places) - 1 THEN 3L "
                "ELSE bigint(least(3, _places[k + 1] - p)) END), 0L, (s, x) -> s + x)"
            ),
        )
        # As generated rows, so that no later filter is pushed below and measures again.
        .select(F.inline(F.array(F.struct(*kept, *MEASURES))))
    )


def ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of ``docs``: its columns without ``text``, the measurements and ``failed_bits``."""
    bits = F.lit(0).cast("long")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(F.expr(rule.failed), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long"))
    measured = measure(docs)
    return measured.withColumn("failed_bits", bits).drop("text")


def passes(mask: int, bits: str = "failed_bits") -> Column:
    return F.col(bits).bitwiseAND(F.lit(mask).cast("long")) == 0


def apply_policies(ledger_rows: DataFrame, policies: dict[str, tuple[str, ...]] = POLICIES) -> DataFrame:
    """The ledger with one boolean ``kept_<version>`` for each policy."""
    return ledger_rows.select("*", *[passes(mask_of(rules)).alias(f"kept_{version}") for version, rules in policies.items()])


def ablations(ledger_rows: DataFrame, version: str = CURRENT) -> DataFrame:
    """What each rule of a policy does: rows it fails, rows that fail by it alone, rows kept without it.

    Rows are first counted by their bit pattern, so the shuffle carries at most one row per pattern and task.
    """
    mask = mask_of(POLICIES[version])
    patterns = ledger_rows.groupBy(F.col("failed_bits").bitwiseAND(F.lit(mask).cast("long")).alias("bits")).agg(F.count("*").alias("n"))
    rules = [r for r in RULES if mask >> r.bit & 1]
    named = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in rules]))
    return (
        patterns.select("bits", "n", named.alias("r"))
        .groupBy(F.lit(version).alias("policy"), F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_failed_alone"),
            F.sum(F.when(F.col("bits").bitwiseAND(F.bitwise_not(F.col("r.bit"))) == 0, F.col("n")).otherwise(0)).alias("n_kept_without"),
        )
    )


def keep_good(docs: DataFrame, version: str = CURRENT) -> DataFrame:
    """The rows of ``docs`` that a policy keeps, with their own columns only."""
    columns = [f"`{c}`" for c in docs.columns]
    carried = docs.select(F.struct(*columns).alias("_row"), F.col("text"))
    return ledger(carried).filter(passes(mask_of(POLICIES[version]))).select("_row.*")
