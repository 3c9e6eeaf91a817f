"""The registered queries of this subpackage and their DuckDB counterparts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.llm import (
    benchmark_matches,
    license_scan,
    line_dedup,
    order_minhash,
    packing,
    page_text,
    piece_codec,
    quality_rules,
    repeats,
    secret_spans,
    turn_repair,
    vector_links,
    word_runs,
)
from attestry.llm.tables import read, text_of


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licence families of every document's paragraphs."""
    out = license_scan.scan(read(spark, folder, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id",
        "n_candidates",
        F.size("licenses").cast("long").alias("n_licenses"),
        F.array_join(F.array_sort(F.array_distinct("licenses.family")), ",").alias("families"),
        F.array_join(F.transform("licenses", lambda x: F.concat_ws(":", x["paragraph"].cast("string"), x["family"])), ",").alias("paragraphs"),
    )


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines that go from every document by their frequency on its source."""
    out = line_dedup.drop_boilerplate(read(spark, folder, "documents").select("doc_id", "source", "text"))
    text = text_of()
    return out.select("doc_id", "line_dedup.n_lines", "line_dedup.n_dropped", F.length(text).cast("long").alias("n_chars"), F.sha2(text, 256).alias("kept_sha256"))


def op3_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate group of every document."""
    return order_minhash.near_duplicates(read(spark, folder, "documents").select("doc_id", "text"))


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Place of every piece of every document in the packed sequences."""
    docs = read(spark, folder, "documents").select("doc_id", "text")
    # The vocabulary of byte_bpe_50k.json as ranks: the same ids.
    return packing.pack(packing.pieces_of(docs, public_tokenizers.path("byte_bpe_50k.tiktoken")))


def op5_piece_codec(spark: SparkSession, folder: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    return piece_codec.digests(read(spark, folder, "documents").select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """The rule ledger of every document and the verdict of the current policy."""
    rows = quality_rules.ledger(read(spark, folder, "documents").select("doc_id", "text"))
    base = ~quality_rules.passes(quality_rules.mask_of(quality_rules.POLICIES["base"]))
    kept = quality_rules.passes(quality_rules.mask_of(quality_rules.POLICIES[quality_rules.CURRENT]))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), kept.alias("kept"), "n_lines", "n_capitals", "failed_bits"
    )


def op7_page_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return page_text.extract(read(spark, folder, "pages").select("page_id", "url", "html"))


def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secret spans of every document."""
    return secret_spans.scan(read(spark, folder, "documents").select("doc_id", "text"))


def op9_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """What repeats of 100 bytes take from every document."""
    return repeats.removed(read(spark, folder, "documents").select("doc_id", "text"))


def op10_vector_links(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of every vector."""
    return vector_links.near_duplicates(read(spark, folder, "embeddings").select("vec_id", "embedding", "label"))


def op11_benchmark_matches(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that stand in a window of a benchmark item."""
    return benchmark_matches.report(read(spark, folder, "documents").select("doc_id", "text"), read(spark, folder, "benchmark").select("item_id", "text"))


def op12_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults of every damaged conversation and its cheapest repair."""
    return turn_repair.audit(read(spark, folder, "conversations").select("conv_id", "turn", "role", "text"))


def op13_word_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of every document's words, with planted ones."""
    return word_runs.digests(read(spark, folder, "documents").select("doc_id", "text"))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_line_dedup": op2_line_dedup,
    "op3_order_minhash": op3_order_minhash,
    "op4_packing": op4_packing,
    "op5_piece_codec": op5_piece_codec,
    "op6_quality_rules": op6_quality_rules,
    "op7_page_text": op7_page_text,
    "op8_secret_scan": op8_secret_scan,
    "op9_repeats": op9_repeats,
    "op10_vector_links": op10_vector_links,
    "op11_benchmark_matches": op11_benchmark_matches,
    "op12_turn_repair": op12_turn_repair,
    "op13_word_runs": op13_word_runs,
}

LINES_SQL = """
WITH lines AS (SELECT doc_id, source, text, l.i, l.line FROM (
    SELECT doc_id, source, text, unnest([{'i': i, 'line': line} FOR line, i IN string_split(coalesce(text, ''), chr(10))]) AS l FROM documents)),
pages AS (SELECT source, count(DISTINCT coalesce(text, '')) AS pages FROM documents GROUP BY source),
counts AS (SELECT source, trim(line) AS line, count(DISTINCT text) AS n FROM lines WHERE trim(line) <> '' GROUP BY 1, 2),
boiler AS (SELECT c.source, c.line FROM counts c JOIN pages p ON c.source IS NOT DISTINCT FROM p.source WHERE c.n >= 2 AND c.n > p.pages * 0.1),
kept AS (SELECT d.doc_id, count(*) AS n_lines, count(b.line) AS n_dropped,
    coalesce(string_agg(d.line, chr(10) ORDER BY d.i) FILTER (b.line IS NULL), '') AS text
    FROM lines d LEFT JOIN boiler b ON d.source IS NOT DISTINCT FROM b.source AND trim(d.line) = b.line GROUP BY d.doc_id)
SELECT doc_id, n_lines, n_dropped, CAST(length(text) AS BIGINT) AS n_chars, sha256(text) AS kept_sha256 FROM kept
"""

RULES_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM documents),
w AS (SELECT doc_id, i, words[i] || chr(10) || words[i + 1] || chr(10) || words[i + 2] AS win
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM d)),
twice AS (SELECT doc_id, i FROM w QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
m AS (SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS BIGINT) AS n_capitals
    FROM d LEFT JOIN covered c ON c.doc_id = d.doc_id),
b AS (SELECT *, CAST(CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > 4 * n_words THEN 4 ELSE 0 END + CASE WHEN word_chars < 2 * n_words THEN 8 ELSE 0 END
    + CASE WHEN word_chars > 14 * n_words THEN 16 ELSE 0 END + CASE WHEN n_dup_lines > 2 AND 100 * n_dup_lines > 30 * n_lines THEN 32 ELSE 0 END
    + CASE WHEN 2 * n_capitals > word_chars THEN 64 ELSE 0 END AS BIGINT) AS failed_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed_bits & 3 <> 0 AS base_failed, failed_bits = 0 AS kept,
    n_lines, n_capitals, failed_bits FROM b
"""

MATCHES_SQL = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
items AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
windows AS (SELECT DISTINCT item_id, k, array_to_string(words[i : i + k - 1], ' ') AS w
    FROM (SELECT item_id, words, least(len(words), 10) AS k, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM items WHERE len(words) > 0)),
places AS (SELECT doc_id, i, k, array_to_string(words[i : i + k - 1], ' ') AS w
    FROM (SELECT doc_id, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM docs, (SELECT DISTINCT k FROM windows))),
hits AS (SELECT p.doc_id, p.i, p.k, x.item_id FROM places p JOIN windows x ON p.k = x.k AND p.w = x.w),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(f.n_items, 0) AS BIGINT) AS n_items,
    sha256(coalesce(f.items, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN covered c ON d.doc_id = c.doc_id LEFT JOIN found f ON d.doc_id = f.doc_id
"""


def _crc32(text: str) -> str:
    """SQL for the checksum of an ASCII string: bit by bit, least significant first."""
    bits = f"flatten(list_transform(string_split({text}, ''), lambda c: list_transform(range(8), lambda b: CAST((ascii(c) >> b) & 1 AS BIGINT))))"
    return f"xor(list_reduce({bits}, lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)), CAST(4294967295 AS BIGINT)), 4294967295)"


TURNS_SQL = rf"""
WITH RECURSIVE base AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS damage FROM conversations),
damaged AS (SELECT conv_id, turn, CASE WHEN damage = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN damage = 1 THEN '' WHEN damage = 2 THEN translate(text, '.!?', '') ELSE text END AS text, copy
    FROM (SELECT *, unnest(CASE WHEN damage = 3 THEN [1, 2] ELSE [1] END) AS copy FROM base WHERE damage <> 0)),
ordered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i, substr(role, 1, 1) AS c FROM damaged),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen FROM ordered),
r AS (SELECT conv_id, turn, role, text, i, c, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 1 WHEN seen > 1 THEN 2
    WHEN NOT regexp_matches(text, '[.!?][ 	-
]*\z') THEN 3 ELSE 0 END AS fault,
    lag(c) OVER (PARTITION BY conv_id ORDER BY i) AS c0 FROM numbered),
sizes AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (i > 1 AND c0 || c NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id),
-- Least cost from row i on, by the last role written: none, system, user, assistant.
back AS (SELECT conv_id, n + 1 AS i, 0 AS b0, 10 AS b1, 5 AS b2, 0 AS b3 FROM sizes
    UNION ALL SELECT conv_id, i, least(u0, 5 + u2, 10 + u3), least(u1, 5 + u2, 10 + u3), least(u2, 5 + u3, 10 + u2), least(u3, 5 + u2, 10 + u3)
    FROM (SELECT r.conv_id, r.i,
        least(2 + b0, CASE WHEN fault NOT IN (1, 2) THEN more + least(1 + b2, CASE c WHEN 's' THEN b1 WHEN 'u' THEN b2 ELSE 999999999 END) ELSE 999999999 END) AS u0,
        least(2 + b1, CASE WHEN fault NOT IN (1, 2) THEN more + least(1 + b2, CASE c WHEN 'u' THEN b2 ELSE 999999999 END) ELSE 999999999 END) AS u1,
        least(2 + b2, CASE WHEN fault NOT IN (1, 2) THEN more + least(1 + b3, CASE c WHEN 'a' THEN b3 ELSE 999999999 END) ELSE 999999999 END) AS u2,
        least(2 + b3, CASE WHEN fault NOT IN (1, 2) THEN more + least(1 + b2, CASE c WHEN 'u' THEN b2 ELSE 999999999 END) ELSE 999999999 END) AS u3
        FROM back JOIN (SELECT *, CASE WHEN fault = 3 THEN 5 ELSE 0 END AS more FROM r) r ON r.conv_id IS NOT DISTINCT FROM back.conv_id AND r.i = back.i - 1)),
costs AS (SELECT conv_id, i, [b0, b1, b2, b3] AS b FROM back),
walk AS (SELECT conv_id, CAST(1 AS BIGINT) AS i, 0 AS s, '' AS audit, CAST([] AS VARCHAR[]) AS lines FROM sizes
    UNION ALL SELECT conv_id, i + CASE WHEN step = 'I' THEN 0 ELSE 1 END, CASE step WHEN 'D' THEN s WHEN 'K' THEN target ELSE follow END, audit || step,
        CASE step WHEN 'D' THEN lines WHEN 'I' THEN list_append(lines, CASE WHEN follow = 2 THEN 'user:' ELSE 'assistant:' END)
            WHEN 'K' THEN list_append(lines, role || ':' || text) ELSE list_append(lines, CASE WHEN follow = 2 THEN 'user:' ELSE 'assistant:' END || text) END
    FROM (SELECT *, CASE WHEN has_row AND 2 + after[s + 1] = here[s + 1] THEN 'D' WHEN 5 + here[follow + 1] = here[s + 1] THEN 'I'
            WHEN has_row AND fault NOT IN (1, 2) AND ((target = 1 AND s = 0) OR (target > 1 AND target = follow)) AND more + after[target + 1] = here[s + 1] THEN 'K'
            WHEN has_row THEN 'R' END AS step
        FROM (SELECT w.*, r.role, r.text, r.fault, r.i IS NOT NULL AS has_row, CASE WHEN w.s = 2 THEN 3 ELSE 2 END AS follow,
            CASE r.c WHEN 's' THEN 1 WHEN 'u' THEN 2 WHEN 'a' THEN 3 ELSE 0 END AS target, CASE WHEN r.fault = 3 THEN 5 ELSE 0 END AS more, h.b AS here, a.b AS after
            FROM walk w JOIN costs h ON h.conv_id IS NOT DISTINCT FROM w.conv_id AND h.i = w.i
            LEFT JOIN costs a ON a.conv_id IS NOT DISTINCT FROM w.conv_id AND a.i = w.i + 1
            LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i)
        WHERE has_row OR here[s + 1] > 0) WHERE step IS NOT NULL),
ends AS (SELECT conv_id, audit, array_to_string(lines, chr(10)) AS body FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC, length(audit) DESC) = 1)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, CAST(coalesce(b[1], 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN sizes z ON o.conv_id IS NOT DISTINCT FROM z.conv_id
    LEFT JOIN costs k ON o.conv_id IS NOT DISTINCT FROM k.conv_id AND k.i = 1 LEFT JOIN ends e ON o.conv_id IS NOT DISTINCT FROM e.conv_id
"""

RUNS_SQL = rf"""
WITH plain AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS words, {_crc32("CAST(doc_id AS VARCHAR)")} AS h FROM documents),
sized AS (SELECT *, CAST(len(words) AS BIGINT) AS n, h // 10 AS g, h % 10 = 0 AND len(words) > 0 AS plants FROM plain),
cut AS (SELECT *, CASE WHEN plants THEN g % n END AS a FROM sized),
d AS (SELECT doc_id, n, CASE WHEN plants THEN list_transform(range(n), lambda i: words[CASE WHEN i >= a THEN a + (i - a) % (1 + (n - a) // (3 + g % 8)) ELSE i END + 1])
    ELSE words END AS words FROM cut),
-- Any run has 16 neighbouring words or more that are equal to those a period on.
grams AS (SELECT doc_id, i, array_to_string(words[i + 1 : i + 16], ' ') AS gram FROM (SELECT doc_id, words, unnest(range(n - 15)) AS i FROM d WHERE n >= 24)),
pairs AS (SELECT a.doc_id, a.i, b.i - a.i AS q FROM grams a JOIN grams b ON a.doc_id = b.doc_id AND a.gram = b.gram AND a.i < b.i),
islands AS (SELECT doc_id, q, min(i) AS s, max(i) + 16 + q AS e
    FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs) GROUP BY doc_id, q, island),
runs AS (SELECT doc_id, s, e, min(q) AS q FROM islands WHERE e - s >= greatest(24, 3 * q) GROUP BY doc_id, s, e),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, e)) AS i FROM runs),
kept AS (SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.i) AS body FROM (SELECT doc_id, unnest(words) AS word, unnest(range(n)) AS i FROM d) w
    ANTI JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i GROUP BY w.doc_id),
listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || (e - s) || ',' || q || chr(10), '' ORDER BY s, q) AS body FROM runs GROUP BY doc_id),
top AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY (e - s) / q DESC, s, q) = 1)
SELECT d.doc_id, coalesce(l.n_runs, 0) AS n_runs, CAST(t.s AS BIGINT) AS start, CAST(t.e - t.s AS BIGINT) AS length, CAST(t.q AS BIGINT) AS period,
    CAST(1000 * (t.e - t.s) // t.q AS BIGINT) AS exponent_milli, sha256(coalesce(l.body, '')) AS runs_sha256, sha256(coalesce(k.body, '')) AS collapsed_sha256
FROM d LEFT JOIN listed l ON d.doc_id = l.doc_id LEFT JOIN top t ON d.doc_id = t.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

ORACLES = {
    "op2_line_dedup": LINES_SQL,
    "op6_quality_rules": RULES_SQL,
    "op11_benchmark_matches": MATCHES_SQL,
    "op12_turn_repair": TURNS_SQL,
    "op13_word_runs": RUNS_SQL,
}
