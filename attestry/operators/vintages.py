"""Bitemporal features: each snapshot shows what was known at its time, with the run and the versions behind it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.functions.digest import content_id
from attestry.operators.segments import Ordered


def known_at(records: DataFrame, identity: Sequence[str], vintage: str, tie: str, as_of: Sequence[str]) -> DataFrame:
    """``records`` once for each time of ``as_of`` at which they were the newest of their identity, with that time as ``as_of``.

    A record is known from its ``vintage`` (when the source published it) until the next one of its identity; ``tie`` orders records of one
    instant. One dealing finds the ends, whatever the number of times asked for.
    """
    closed = Ordered(records, identity, [vintage, tie]).neighbour([vintage], prefix="__until_", forward=True).rows()
    kind = dict(records.dtypes)[vintage]
    times = F.array(*[F.lit(t).cast(kind) for t in as_of])
    start, end = F.col(vintage), F.col(f"__until_{vintage}")
    valid = F.filter(times, lambda t: (t >= start) & (end.isNull() | (t < end)))
    return closed.withColumn("as_of", F.explode(valid)).drop(f"__until_{vintage}")


def snapshots(
    records: DataFrame,
    keys: Sequence[str],
    identity: Sequence[str],
    vintage: str,
    tie: str,
    version: str,
    features: Mapping[str, str],
    definition: str,
    as_of: Sequence[str],
    run_id: Column,
) -> DataFrame:
    """One row per time of ``as_of`` and key: sums of ``features`` over what was known then, the newest vintage, the source versions behind it and
    the run that wrote it. A later correction changes later snapshots only; the id comes from time, key and definition.

    Versions are counted per key first, so the list of a row has each once, with its number of records.
    """
    known = known_at(records, identity, vintage, tie, as_of)
    per = known.groupBy("as_of", *keys, version).agg(
        F.count(F.lit(1)).alias("n"), F.max(vintage).alias("newest"), *[F.sum(c).alias(name) for name, c in features.items()]
    )
    behind = F.array_sort(F.collect_list(F.struct(F.col(version).alias("version"), F.col("n").alias("records"))))
    rows = per.groupBy("as_of", *keys).agg(
        F.sum("n").alias("input_rows"), F.max("newest").alias("newest_vintage"), *[F.sum(name).alias(name) for name in features], behind.alias("versions")
    )
    return rows.withColumns(
        {
            "feature_snapshot_id": content_id(F.lit("feature"), F.lit(definition), F.col("as_of"), *[F.col(k) for k in keys]),
            "definition_version": F.lit(definition),
            "run_id": run_id,
        }
    )
