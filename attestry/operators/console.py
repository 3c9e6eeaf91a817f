"""Relations behind a review console."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.operators.gate import count_matches, flag_exists
from attestry.operators.history import join_open
from attestry.operators.segments import join_on_key, latest_per_key

REVIEW_QUEUE_SIZE = 200


def approval_queue(
    resources: DataFrame,
    datasets: DataFrame,
    assessments: DataFrame,
    decisions: DataFrame,
    changes: DataFrame,
    requeue_on_change: bool = False,
) -> DataFrame:
    """Active resources awaiting a decision, with dataset, latest assessment and a change flag.

    ``requeue_on_change`` brings back a decided resource when a change was detected after the
    decision. Several snapshots of one resource count once: callers pass the latest.
    """
    material = changes.filter(F.col("compatibility_outcome") != "COMPATIBLE")
    assessment = latest_per_key(assessments, ["resource_key"], ["assessed_at", "dataset_quality_assessment_id"]).select(
        "resource_key", "assessment_status", "overall_score", "recommendation", "assessed_at"
    )
    decision = latest_per_key(decisions, ["resource_key"], ["decided_at", "manual_review_decision_id"]).select(
        "resource_key", F.col("decision").alias("latest_decision"), F.col("decided_at").alias("latest_decision_at")
    )
    active = resources.filter("is_active")
    if requeue_on_change:
        last = material.groupBy("resource_key").agg(F.max("detected_at").alias("__changed_at"))
        waiting = (
            active.join(decision, "resource_key", "left")
            .join(last, "resource_key", "left")
            .filter(F.col("latest_decision").isNull() | (F.col("__changed_at") > F.col("latest_decision_at")))
            .drop("__changed_at")
        )
    else:
        waiting = active.join(decisions.select("resource_key").distinct(), "resource_key", "left_anti").withColumns(
            {
                "latest_decision": F.lit(None).cast("string"),
                "latest_decision_at": F.lit(None).cast(decisions.schema["decided_at"].dataType),
            }
        )
    # One row per resource: the joins on the resource share one partitioning, the dataset comes last.
    assessed = waiting.join(assessment, "resource_key", "left")
    flagged = flag_exists(assessed, material, "resource_key", "has_material_schema_change", unique=True)
    return flagged.join(
        datasets.select("catalog_dataset_id", "catalog_name", "dataset_key"), "catalog_dataset_id", "left"
    )


def approval_detail(queue: DataFrame, profiles: DataFrame, documents: DataFrame, schemas: DataFrame) -> DataFrame:
    """Queue rows with their open access profile and the number of document and schema snapshots."""
    with_profile = join_open(queue, profiles, "resource_key", "effective_to")
    counted = count_matches(with_profile, documents, "resource_key", "document_snapshot_count", unique=True)
    return count_matches(counted, schemas, "resource_key", "schema_snapshot_count", unique=True)


def queue_filter(
    queue: DataFrame,
    *,
    catalogs: Sequence[str] | None = None,
    resource_types: Sequence[str] | None = None,
    score_between: tuple[float, float] | None = None,
    assessed_between: tuple[Column, Column] | None = None,
    statuses: Sequence[str] | None = None,
) -> DataFrame:
    """Compose the console's filters; each absent one is no filter at all."""
    if catalogs is not None:
        queue = queue.filter(F.col("catalog_name").isin(*catalogs))
    if resource_types is not None:
        queue = queue.filter(F.col("resource_type").isin(*resource_types))
    if score_between is not None:
        queue = queue.filter(F.col("overall_score").between(*score_between))
    if assessed_between is not None:
        queue = queue.filter((F.col("assessed_at") >= assessed_between[0]) & (F.col("assessed_at") < assessed_between[1]))
    if statuses is not None:
        queue = queue.filter(F.col("assessment_status").isin(*statuses))
    return queue


def review_queue_top(queue: DataFrame, size: int = REVIEW_QUEUE_SIZE) -> DataFrame:
    """First page of the queue: changed first, then best score, then longest waiting."""
    return queue.orderBy(
        F.desc("has_material_schema_change"),
        F.desc_nulls_last("overall_score"),
        F.asc_nulls_last("assessed_at"),
        F.asc("resource_key"),
    ).limit(size)


def review_history(decisions: DataFrame) -> DataFrame:
    """Governed column list over the decision ledger; columns a ledger lacks come out null."""
    columns = (
        "manual_review_decision_id",
        "resource_key",
        "decision",
        "rationale",
        "conditions",
        "reviewer_username",
        "supersedes_decision_id",
        "data_source_version_id",
        "app_version",
        "correlation_id",
        "decided_at",
    )
    return decisions.select(*[F.col(c) if c in decisions.columns else F.lit(None).cast("string").alias(c) for c in columns])


def active_stewards(stewards: DataFrame) -> DataFrame:
    return stewards.filter("is_active").select("username", "authorization_scope")


def lookup(df: DataFrame, key: str, value: object) -> DataFrame:
    """Point lookup with a bound value (never spliced into SQL text)."""
    return df.filter(F.col(key) == F.lit(value))


def first_generation_queue(assessments: DataFrame, decisions: DataFrame) -> DataFrame:
    """The earlier queue: each distinct assessment outcome of a resource with its last decision time.

    Both sides are reduced before they meet, so no assessment is paired with every decision.
    """
    outcomes = assessments.select("resource_key", "assessment_status", "overall_score", "recommendation").distinct()
    last = decisions.groupBy("resource_key").agg(F.max("decided_at").alias("latest_decision_at"))
    return join_on_key(outcomes, last, ["resource_key"], "left")


def without_columns(df: DataFrame, blocked: Sequence[str]) -> DataFrame:
    return df.drop(*blocked)


# Columns an export never carries.
EXPORT_BLOCKED = ("payload", "resource_payload", "metadata_payload", "secret_reference", "artifact_content")


def export_summary(df: DataFrame, path: str, kind: str = "csv", blocked: Sequence[str] = EXPORT_BLOCKED) -> DataFrame:
    """Write filtered review metadata as CSV or JSON, without payload and secret columns."""
    safe = without_columns(df, blocked)
    writer = safe.write.mode("overwrite")
    if kind == "csv":
        writer.option("header", True).csv(path)
    elif kind == "json":
        writer.json(path)
    else:
        raise ValueError(f"unknown export kind: {kind}")
    return safe
