"""State derived from append-only ledgers: latest rows, validity intervals, supersession, changes over time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestry.operators.segments import Ordered, join_on_key, latest_per_key, neighbour

__all__ = [
    "close_intervals",
    "current_datasets",
    "current_status",
    "dedupe_keep_observations",
    "document_diff",
    "join_open",
    "latest_per_key",
    "latest_resources",
    "observed_cadence",
    "open_rows",
    "prior_success",
    "retire_orphans",
    "supersessions",
    "upsert_by_key",
    "valid_at",
]


def latest_resources(resources: DataFrame) -> DataFrame:
    """Newest snapshot of each resource: repeated evidence runs register a resource again, the queue shows it once."""
    return latest_per_key(resources, ["resource_key"], ["registered_at", "catalog_resource_id"])


def current_datasets(datasets: DataFrame) -> DataFrame:
    """Newest metadata snapshot of each dataset; the stored flag is never cleared and is not used."""
    return latest_per_key(datasets, ["dataset_key"], ["discovered_at", "catalog_dataset_id"])


def supersessions(decisions: DataFrame) -> DataFrame:
    """Link every decision to the previous one of the same resource."""
    linked = neighbour(
        decisions,
        ["resource_key"],
        ["decided_at", "manual_review_decision_id"],
        ["manual_review_decision_id"],
        prefix="supersedes_",
    )
    return linked.withColumnRenamed("supersedes_manual_review_decision_id", "supersedes_decision_id")


def close_intervals(profiles: DataFrame, keys: Sequence[str], start: str, tie: str) -> DataFrame:
    """Slowly changing history: a version ends where the next version of its key starts; the last stays open."""
    closed = neighbour(profiles, keys, [start, tie], [start], prefix="__next_", forward=True)
    return closed.withColumnRenamed(f"__next_{start}", "effective_to")


def open_rows(df: DataFrame, end: str) -> DataFrame:
    return df.filter(F.col(end).isNull())


def join_open(resources: DataFrame, history: DataFrame, key: str, end: str) -> DataFrame:
    """Every resource with its open history row, if any; the filter runs before the join."""
    return resources.join(open_rows(history, end).drop(end), key, "left")


def valid_at(
    events: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    at: str,
    start: str,
    end: str,
    event_id: str,
    values: Sequence[str],
) -> DataFrame:
    """The history row valid at each event (``start <= at < end``, null end is open), as columns ``as_of_*``.

    Both inputs are laid on one time axis and every event takes the nearest history row at or
    before it: one shuffle, no pair of event and version is ever built.
    """
    carried = [start, end, *values]
    marks = history.select(
        *keys,
        F.col(start).alias("__at"),
        F.lit(0).alias("__side"),
        F.struct(*carried).alias("__version"),
        F.lit(None).cast(events.schema[event_id].dataType).alias("__id"),
        F.lit(None).cast(events.drop(*keys).schema).alias("__event"),
    )
    points = events.select(
        *keys,
        F.col(at).alias("__at"),
        F.lit(1).alias("__side"),
        F.lit(None).cast(marks.schema["__version"].dataType).alias("__version"),
        F.col(event_id).alias("__id"),
        F.struct(*[c for c in events.columns if c not in keys]).alias("__event"),
    )
    line = neighbour(
        marks.unionByName(points),
        keys,
        ["__at", "__side", "__id"],
        ["__version"],
        prefix="__on",
        where=F.col("__side") == 0,
    ).filter(F.col("__side") == 1)
    version = F.col("__on__version")
    valid = version[end].isNull() | (F.col(at) < version[end])
    return line.select(*keys, "__event.*", "__on__version").select(
        *events.columns, *[F.when(valid, version[v]).alias(f"as_of_{v}") for v in values]
    )


def retire_orphans(versions: DataFrame, decisions: DataFrame, retired_at: Column) -> DataFrame:
    """Superseding RETIRED rows for open versions whose recorded decision is not in the ledger."""
    suspects = versions.filter(F.col("retired_at").isNull() & F.col("approved_decision_id").isNotNull())
    known = decisions.select(F.col("manual_review_decision_id").alias("approved_decision_id"))
    orphans = suspects.join(known, "approved_decision_id", "left_anti").select(*versions.columns)
    return orphans.withColumn("status", F.lit("RETIRED")).withColumn("retired_at", retired_at)


def prior_success(
    runs: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    run_id: str,
    succeeded: Column,
) -> DataFrame:
    """Add ``prior_successful_run_id``: the last successful run of the key strictly before each run."""
    found = neighbour(runs, keys, order, [run_id], prefix="__prior_", where=succeeded)
    return found.withColumnRenamed(f"__prior_{run_id}", "prior_successful_run_id")


def document_diff(snapshots: DataFrame) -> DataFrame:
    """Mark a document snapshot whose content differs from the previous one of its resource and type."""
    compared = neighbour(
        snapshots,
        ["resource_key", "document_type"],
        ["retrieved_at", "source_document_snapshot_id"],
        ["content_sha256", "source_document_snapshot_id"],
    )
    changed = F.col("prev_source_document_snapshot_id").isNotNull() & ~F.col("content_sha256").eqNullSafe(
        F.col("prev_content_sha256")
    )
    return compared.withColumn("is_material_change", changed)


def dedupe_keep_observations(df: DataFrame, keys: Sequence[str], order: Sequence[str], id_column: str) -> DataFrame:
    """Keep every row; name the first observation of its key and how many there are."""
    firsts = df.groupBy(*keys).agg(
        F.min_by(id_column, F.struct(*order)).alias("canonical_id"), F.count(F.lit(1)).alias("n_observations")
    )
    marked = join_on_key(df, firsts, keys, "left", nulls_match=True)
    return marked.withColumn("is_canonical", F.col(id_column).eqNullSafe(F.col("canonical_id")))


def upsert_by_key(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], newest_by: Sequence[str], changed: Sequence[str]
) -> DataFrame:
    """Target rows with ``changed`` columns taken from the newest update of their key, plus keys not yet present.

    Union and one aggregate: each key meets its update by partial aggregation, not by a join.
    """
    rest = [c for c in target.columns if c not in keys]
    old = target.select(*keys, F.struct(*rest).alias("__old"))
    fresh = updates.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*newest_by)).alias("__new"))
    both = old.unionByName(fresh, allowMissingColumns=True).groupBy(*keys).agg(
        F.first("__old", ignorenulls=True).alias("__old"), F.first("__new", ignorenulls=True).alias("__new")
    )
    has_new, has_old = F.col("__new").isNotNull(), F.col("__old").isNotNull()
    merged = []
    for name in rest:
        from_new = (has_new & ~has_old) | (has_new & F.lit(name in changed))
        merged.append(F.when(from_new, F.col("__new")[name]).otherwise(F.col("__old")[name]).alias(name))
    return both.select(*keys, *merged).select(*target.columns)


def current_status(status_events: DataFrame, run_id: str, at: str, sequence: str) -> DataFrame:
    """Last status event of each run; earlier ones, failures included, stay in the ledger."""
    return latest_per_key(status_events, [run_id], [at, sequence])


def observed_cadence(snapshots: DataFrame, key: str, at: str, tie: str, content: str) -> DataFrame:
    """Typical hours between real content changes per key: the lower median, exact.

    Changes and the gaps between them are found on the same dealt rows. Equal gaps are counted first, so the ordered part per key is the number of distinct gaps.
    """
    seen = Ordered(snapshots.select(key, at, tie, content), [key], [at, tie]).neighbour([content, tie])
    changes = seen.filter(F.col(f"prev_{tie}").isNull() | ~F.col(content).eqNullSafe(F.col(f"prev_{content}")))
    gaps = changes.neighbour([at]).rows().filter(F.col(f"prev_{at}").isNotNull())
    hours = F.timestamp_diff("HOUR", F.col(f"prev_{at}"), F.col(at))
    counted = gaps.groupBy(key, hours.alias("gap_hours")).agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy(key).orderBy("gap_hours").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("__upto", F.sum("n").over(upto)).withColumn(
        "__all", F.sum("n").over(Window.partitionBy(key))
    )
    return ranked.groupBy(key).agg(
        F.max("__all").alias("n_gaps"),
        F.min(F.when(F.col("__upto") * 2 >= F.col("__all"), F.col("gap_hours"))).alias("typical_gap_hours"),
    )
