"""The corpus pipeline: documents through quality rules, line dedup, near-dedup, secret masking and packing.

All stages: a null text counts as empty, null ids and repeated rows are rows like others, texts of any length are read whole, an empty table gives an empty
one, and columns beyond those of documents pass through the first four stages, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from attestry.llm import line_dedup, order_minhash, packing, quality_rules, secret_spans
from attestry.llm.tables import read, stored, with_length


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy keeps; a null or empty text has too few words and goes."""
    return quality_rules.keep_good(docs)


def drop_site_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without its source's boilerplate lines; a null source is one source, and a line on exactly a tenth of its pages stays."""
    return with_length(line_dedup.drop_boilerplate(docs, report=None))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest id (null ids last), of repeated rows any one."""
    return order_minhash.keep_one(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets masked; of spans that touch, the fixed patterns' stay."""
    return with_length(secret_spans.mask_secrets(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document and its place in a sequence; an empty document is its end id alone."""
    return packing.pack(packing.pieces_of(docs, public_tokenizers.path("byte_bpe_50k.tiktoken")))


STAGES = [
    ("quality rules", apply_quality_rules),
    ("line dedup", drop_site_lines),
    ("near-dedup", keep_one_of_each_group),
    ("secret scan", mask_secrets),
    ("packing", pack_sequences),
]

#: Several stages are beyond SQL; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{number}")
    return docs
