"""Every operator and pipeline stage on nulls, empty tables, ties, very long texts and extra columns of clashing names."""

from __future__ import annotations

import random

import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from attestry.llm import license_scan, line_dedup, order_minhash, packing, page_text, piece_codec, quality_rules, repeats, secret_spans, vector_links

CLASHES = ["_row", "_a", "_b", "_text", "_words", "_lines", "_host", "_h", "_key", "_own", "n_words", "n_rows", "cid", "top", "key", "kept", "lines", "piece", "line_dedup", "c0", "a.b", "Text 2", "none"]


def good(seed: int, n: int = 90) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Documents with null ids, texts and sources, an all-null row, repeated rows, equal ids, a very long text, and clashing columns."""
    long = good(99, 60_000)
    rows = [
        (1, good(1), "en", "s", 1), (2, good(2), None, None, None), (None, good(3), "en", "s", 3), (None, None, None, None, None),
        (4, None, "en", "s", 0), (5, "", "en", "s", 0), (6, good(6), "en", "s", 6), (6, good(6), "en", "s", 6), (6, good(7), "en", "s", 7),
        (7, long, "en", "s", len(long)), (8, "\n\n \r\n\t", "en", "s", 6), (9, good(9) + " \U0001f600 \x00  ", "en", "s", 9),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHES]).cache()


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_stages_keep_columns(spark, odd, stage):
    out = stage[1](spark, odd, "")
    assert out.columns == odd.columns
    rows = out.collect()
    assert all(r[c] == f"own {c}" for r in rows for c in CLASHES)
    # Long enough documents stay; near-dedup keeps one of the repeated rows.
    assert {r.doc_id for r in rows} >= {1, 2, None, 6, 7, 9} and 7 <= len(rows) <= 12
    assert stage[1](spark, odd.limit(0), "").collect() == []


def test_last_stage(spark, odd):
    stage = corpus_pipeline.STAGES[-1][1]
    rows = stage(spark, odd, "").collect()
    assert sum(r.piece == 0 for r in rows) == 12 and sum(r.length for r in rows if r.doc_id == 4) == 1
    assert stage(spark, odd.limit(0), "").collect() == []


@pytest.mark.parametrize(
    "operator",
    [
        lambda d: license_scan.scan(d),
        lambda d: line_dedup.drop_boilerplate(d),
        lambda d: order_minhash.near_duplicates(d),
        lambda d: piece_codec.digests(d, public_tokenizers.path("piece_bpe_32k.model")),
        lambda d: quality_rules.ledger(d),
        lambda d: secret_spans.scan(d),
        lambda d: repeats.removed(d),
        lambda d: packing.pieces_of(d, public_tokenizers.path("byte_bpe_50k.tiktoken")).filter("piece = 0"),
    ],
    ids=["license", "lines", "near", "codec", "quality", "secrets", "repeats", "pieces"],
)
def test_operators_on_clashing_columns(odd, operator):
    assert operator(odd).count() == 12
    assert operator(odd.limit(0)).count() == 0
