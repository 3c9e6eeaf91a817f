"""Column profiles as mergeable sketches, kept per source version.

A profile row holds counts, extremes and two sketches: a HyperLogLog sketch of the distinct values and a KLL sketch of the numbers. Profiles of
several versions merge into one of all their rows without reading these again. With ``LG_K`` of 12 a distinct count is within 1.6 % in
two of three cases (4.9 % in 997 of 1,000); a quantile of a sketch with ``K`` of 200 is within 1.33 % of the rank asked for in 99 of 100.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 12
K = 200
NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _number(df: DataFrame, name: str) -> Column:
    kind = dict(df.dtypes)[name]
    value = F.col(name).cast("double") if kind in NUMBERS or kind.startswith("decimal") else F.lit(None).cast("double")
    # A quantile of what is no number means nothing.
    return F.when(~F.isnan(value), value)


def profile_versions(df: DataFrame, version: str, columns: Sequence[str]) -> DataFrame:
    """One row per version and column: rows, nulls, extremes as text, numeric extremes and the two sketches, in one aggregate."""
    sums = [F.count(F.lit(1)).alias("__rows")]
    for i, name in enumerate(columns):
        text, number = F.col(name).cast("string"), _number(df, name)
        sums += [
            F.count_if(F.col(name).isNull()).alias(f"__n{i}"), F.hll_sketch_agg(text, LG_K).alias(f"__d{i}"),
            F.kll_sketch_agg_double(number, K).alias(f"__q{i}"), F.min(text).alias(f"__l{i}"), F.max(text).alias(f"__h{i}"),
            F.min(number).alias(f"__a{i}"), F.max(number).alias(f"__z{i}"), F.count(number).alias(f"__c{i}"),
        ]
    fields = {"null_count": "n", "distinct_sketch": "d", "quantile_sketch": "q", "min_text": "l", "max_text": "h", "min_number": "a", "max_number": "z", "number_count": "c"}
    rows = [F.struct(F.lit(name).alias("column_name"), F.col("__rows").alias("row_count"), *[F.col(f"__{s}{i}").alias(f) for f, s in fields.items()]) for i, name in enumerate(columns)]
    return df.groupBy(version).agg(*sums).select(version, F.inline(F.array(*rows)))


def merge_profiles(profiles: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Profiles of versions merged per column (and ``keys``): sketches are united, counts added. No row of the data is read."""
    return profiles.groupBy(*keys, "column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"),
        F.hll_union_agg("distinct_sketch", False).alias("distinct_sketch"), F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
        F.min("min_text").alias("min_text"), F.max("max_text").alias("max_text"),
        F.min("min_number").alias("min_number"), F.max("max_number").alias("max_number"), F.sum("number_count").alias("number_count"),
    )


def read_profiles(profiles: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Estimates of profile rows: ``distinct_count`` and ``quantiles`` in their order (null where no number was seen)."""
    asked = F.array(*[F.lit(float(q)) for q in quantiles])
    found = F.when(F.col("number_count") > 0, F.kll_sketch_get_quantile_double("quantile_sketch", asked))
    distinct = F.when(F.col("null_count") == F.col("row_count"), F.lit(0).cast("bigint")).otherwise(F.hll_sketch_estimate("distinct_sketch"))
    return profiles.withColumns({"distinct_count": distinct, "quantiles": found}).drop("distinct_sketch", "quantile_sketch")


def exact_distincts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact distinct counts, on demand: one column's values after the other's in one aggregate, counted by value first."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    values = df.select(F.inline(pairs)).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    return values.groupBy("column_name").agg(F.count("value").alias("distinct_count"))


def drift(before: DataFrame, after: DataFrame, quantile: float = 0.5) -> DataFrame:
    """Two merged profiles side by side per column: shares of nulls, distinct estimates and a quantile, before and after."""
    parts = []
    for name, df in (("before", before), ("after", after)):
        read = read_profiles(df, (quantile,))
        parts.append(
            read.select(
                "column_name", (F.col("null_count") / F.col("row_count")).alias(f"null_share_{name}"), F.col("distinct_count").alias(f"distinct_{name}"), F.get("quantiles", F.lit(0)).alias(f"quantile_{name}")
            )
        )
    return reduce(lambda a, b: a.join(b, "column_name", "full_outer"), parts)
