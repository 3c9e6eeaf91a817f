"""Approval gate: which rows and which decisions may pass."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.functions.digest import content_id
from attestry.operators.segments import join_on_key, latest_per_key, neighbour

# Decisions, those that need conditions, those that create a version, and error codes.
DECISIONS = ("APPROVED", "APPROVED_WITH_CONDITIONS", "REJECTED", "RETIRED", "DEFERRED")
CONDITIONS_REQUIRED = ("APPROVED_WITH_CONDITIONS", "REJECTED", "RETIRED", "DEFERRED")
APPROVING = ("APPROVED", "APPROVED_WITH_CONDITIONS")
ELIGIBLE = ("APPROVED", "CONDITIONAL")
RATIONALE_MIN, RATIONALE_MAX = 10, 10_000
UNSUPPORTED_DECISION = -20001
INVALID_RATIONALE = -20002
MISSING_CONDITIONS = -20003
UNAUTHORIZED_STEWARD = -20004
INCOMPLETE_EVIDENCE = -20005


def is_eligible(status: Column, retired_at: Column) -> Column:
    """Approved or conditional and not retired; an absent version is not eligible."""
    return F.coalesce(status.isin(*ELIGIBLE) & retired_at.isNull(), F.lit(False))


def gate(raw: DataFrame, versions: DataFrame) -> DataFrame:
    """Rows of RAW whose source version is approved; each row passes at most once."""
    allowed = versions.filter(is_eligible(F.col("status"), F.col("retired_at"))).select("data_source_version_id")
    return raw.join(allowed, "data_source_version_id", "left_semi")


def flag_exists(df: DataFrame, matches: DataFrame, key: str, name: str, unique: bool = False) -> DataFrame:
    """EXISTS as a column; matches collapse to one row per key before they are joined.

    ``unique`` says that ``df`` has one row per key: then no key can be hot, and the join may use
    the partitioning that is already there.
    """
    found = matches.select(key).distinct().withColumn(name, F.lit(True))
    joined = df.join(found, key, "left") if unique else join_on_key(df, found, [key], "left")
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def count_matches(df: DataFrame, matches: DataFrame, key: str, name: str, unique: bool = False) -> DataFrame:
    """Correlated COUNT(*) as a column, zero where there is no match. ``unique`` as above."""
    counts = matches.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    joined = df.join(counts, key, "left") if unique else join_on_key(df, counts, [key], "left")
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(0)).cast("bigint"))


def unresolved_changes(changes: DataFrame, decisions: DataFrame | None = None) -> DataFrame:
    """Change events that still block: not compatible, not justified, not followed by an approving decision."""
    blocking = changes.filter(~F.col("compatibility_outcome").isin("COMPATIBLE", "IGNORED_WITH_JUSTIFICATION"))
    if decisions is None:
        return blocking
    approving = decisions.filter(F.col("decision").isin("APPROVED", "APPROVED_WITH_CONDITIONS"))
    last = approving.groupBy("resource_key").agg(F.max("decided_at").alias("__last_decided"))
    joined = join_on_key(blocking, last, ["resource_key"], "left")
    return joined.filter(
        F.col("__last_decided").isNull() | (F.col("__last_decided") <= F.col("detected_at"))
    ).drop("__last_decided")


def evidence_facts(
    documents: DataFrame, schemas: DataFrame, open_profiles: DataFrame, assessments: DataFrame, blocking: DataFrame, resources: DataFrame | None = None
) -> DataFrame:
    """One row per resource with counts of each kind of evidence and the latest assessment status.

    With the register of ``resources``, ``resource_count`` says how many active entries a resource has there.

    The five ledgers are stacked and aggregated once: one shuffle with partial aggregation in
    place of five joins, and no ledger's hot resource lands in one task.
    """
    kinds = {
        "document_count": documents,
        "schema_count": schemas,
        "open_profile_count": open_profiles,
        "blocking_count": blocking,
    }
    if resources is not None:
        kinds["resource_count"] = resources.filter("is_active")
    parts = [
        df.select("resource_key", *[F.lit(int(k == name)).alias(k) for k in kinds]) for name, df in kinds.items()
    ]
    stacked = reduce(lambda a, b: a.unionByName(b), parts)
    counts = stacked.groupBy("resource_key").agg(*[F.sum(k).cast("bigint").alias(k) for k in kinds])
    newest = latest_per_key(assessments, ["resource_key"], ["assessed_at", "dataset_quality_assessment_id"]).select(
        "resource_key", "assessment_status"
    )
    both = counts.join(newest, "resource_key", "full_outer")
    return both.select(
        "resource_key", *[F.coalesce(F.col(k), F.lit(0)).cast("bigint").alias(k) for k in kinds], "assessment_status"
    )


def prerequisites_met(registered: bool = False) -> Column:
    """Over ``evidence_facts``: documents, schema, one open profile, pending review, nothing blocking; and, if ``registered``
    is asked for, exactly one active entry in the register."""
    entered = F.col("resource_count") == 1 if registered else F.lit(True)
    return F.coalesce(
        entered
        & (F.col("document_count") > 0)
        & (F.col("schema_count") > 0)
        & (F.col("open_profile_count") == 1)
        & (F.col("assessment_status") == "PENDING_REVIEW")
        & (F.col("blocking_count") == 0),
        F.lit(False),
    )


def evidence_complete(resources: DataFrame, documents: DataFrame, schemas: DataFrame, pending: DataFrame) -> DataFrame:
    """Resources that have a document snapshot, a schema snapshot and a pending assessment."""
    return reduce(
        lambda left, right: left.join(right.select("resource_key").distinct(), "resource_key", "left_semi"),
        (documents, schemas, pending),
        resources,
    )


def input_error() -> Column:
    """Error code of a decision row judged by itself, or null."""
    rationale = F.coalesce(F.col("rationale"), F.lit(""))
    size = F.length(F.regexp_replace(rationale, r"^\s+|\s+$", ""))
    named = F.exists(
        F.coalesce(F.col("conditions"), F.array().cast("array<string>")),
        lambda c: F.coalesce(F.length(F.regexp_replace(c, r"\s+", "")) > 0, F.lit(False)),
    )
    return (
        F.when(~F.coalesce(F.col("decision").isin(*DECISIONS), F.lit(False)), UNSUPPORTED_DECISION)
        .when(~size.between(RATIONALE_MIN, RATIONALE_MAX), INVALID_RATIONALE)
        .when(F.col("decision").isin(*CONDITIONS_REQUIRED) & ~named, MISSING_CONDITIONS)
    )


def validate_decisions(batch: DataFrame) -> DataFrame:
    return batch.withColumn("error_code", input_error())


def steward_matches(batch: DataFrame, stewards: DataFrame) -> DataFrame:
    """Add ``steward_count``: active grants of the reviewer that cover the resource (global or by key).

    Grants are counted per (user, scope) first, so a user with many grants never multiplies rows.
    """
    grants = stewards.filter("is_active").groupBy("username", "authorization_scope").agg(
        F.count(F.lit(1)).alias("__n")
    )
    everywhere = grants.filter(F.col("authorization_scope") == "GLOBAL").select(
        F.col("username").alias("reviewer_username"), F.col("__n").alias("__global")
    )
    scoped = grants.filter(F.col("authorization_scope") != "GLOBAL").select(
        F.col("username").alias("reviewer_username"),
        F.col("authorization_scope").alias("__scope"),
        F.col("__n").alias("__scoped"),
    )
    keyed = batch.withColumn("__scope", F.col("resource_key").cast("string"))
    joined = join_on_key(keyed, everywhere, ["reviewer_username"], "left")
    joined = join_on_key(joined, scoped, ["reviewer_username", "__scope"], "left")
    total = F.coalesce(F.col("__global"), F.lit(0)) + F.coalesce(F.col("__scoped"), F.lit(0))
    return joined.withColumn("steward_count", total.cast("bigint")).drop("__scope", "__global", "__scoped")


@dataclass(frozen=True)
class DecisionOutcome:
    """Rows to append: accepted decisions, the versions they create, and rejected input."""

    decisions: DataFrame
    versions: DataFrame
    rejects: DataFrame
    judged: DataFrame


def apply_decisions(batch: DataFrame, stewards: DataFrame, facts: DataFrame, ledger: DataFrame) -> DecisionOutcome:
    """Judge a whole batch of decisions in one plan.

    Facts that were made with the register of resources refuse the approval of an unregistered one.

    Checks run in a fixed order (input, steward, evidence) and the first failure is reported.
    Accepted decisions supersede the previous accepted one of the same resource, which may be in
    the ledger or earlier in the batch. Identifiers come from content, so a rerun repeats them.
    """
    judged = steward_matches(validate_decisions(batch), stewards)
    judged = join_on_key(judged, facts, ["resource_key"], "left")
    judged = judged.withColumn(
        "error_code",
        F.coalesce(
            F.col("error_code"),
            F.when(F.col("steward_count") != 1, UNAUTHORIZED_STEWARD),
            F.when(F.col("decision").isin(*APPROVING) & ~prerequisites_met("resource_count" in facts.columns), INCOMPLETE_EVIDENCE),
        ),
    ).select(*batch.columns, "error_code")
    accepted = judged.filter(F.col("error_code").isNull()).drop("error_code")
    named = accepted.withColumn(
        "manual_review_decision_id",
        content_id(*[F.col(c) for c in ("resource_key", "decision", "reviewer_username", "correlation_id", "decided_at")]),
    )
    chain = ledger.select(
        "resource_key", "decided_at", F.col("manual_review_decision_id").cast("string"), F.lit(0).alias("__new")
    ).unionByName(
        named.select("*", F.lit(1).alias("__new")), allowMissingColumns=True
    )
    linked = neighbour(
        chain,
        ["resource_key"],
        ["decided_at", "__new", "manual_review_decision_id"],
        ["manual_review_decision_id"],
        prefix="supersedes_",
    ).filter(F.col("__new") == 1)
    creates = F.col("decision").isin(*APPROVING)
    decisions = (
        linked.withColumnRenamed("supersedes_manual_review_decision_id", "supersedes_decision_id")
        .withColumn(
            "data_source_version_id",
            F.when(creates, content_id(F.lit("version"), F.col("manual_review_decision_id"))),
        )
        .drop("__new")
    )
    versions = decisions.filter(creates).select(
        "data_source_version_id",
        "resource_key",
        F.when(F.col("decision") == "APPROVED", "APPROVED").otherwise("CONDITIONAL").alias("status"),
        F.col("manual_review_decision_id").alias("approved_decision_id"),
        F.col("decided_at").alias("created_at"),
        F.lit(None).cast(batch.schema["decided_at"].dataType).alias("retired_at"),
    )
    return DecisionOutcome(decisions, versions, judged.filter(F.col("error_code").isNotNull()), judged)


def promotion_gate(runs: DataFrame, results: DataFrame, blocking: DataFrame) -> DataFrame:
    """Verdict per run: BLOCKED_REVIEW on a failed blocking rule or an unresolved change, else PROMOTABLE."""
    failed = F.col("status") == "FAIL"
    per_run = results.groupBy("ingestion_run_id").agg(
        F.count_if(failed & (F.col("severity") == "BLOCKING")).alias("n_blocking_failures"),
        F.count_if(failed & (F.col("severity") != "BLOCKING")).alias("n_warnings"),
    )
    judged = join_on_key(runs, per_run, ["ingestion_run_id"], "left")
    judged = flag_exists(judged, blocking, "resource_key", "has_material_change")
    judged = judged.withColumns(
        {n: F.coalesce(F.col(n), F.lit(0)).cast("bigint") for n in ("n_blocking_failures", "n_warnings")}
    )
    blocked = (F.col("n_blocking_failures") > 0) | F.col("has_material_change")
    return judged.withColumn("promotion_status", F.when(blocked, "BLOCKED_REVIEW").otherwise("PROMOTABLE"))


def resource_latest_state(resources: DataFrame, versions: DataFrame, decisions: DataFrame) -> DataFrame:
    """Latest open version, latest decision and full-ingestion eligibility of every resource.

    Decision columns come from the decision ledger itself, so decided resources show theirs.
    """
    open_versions = versions.filter(F.col("retired_at").isNull())
    version = latest_per_key(open_versions, ["resource_key"], ["created_at", "data_source_version_id"]).select(
        "resource_key",
        "data_source_version_id",
        F.col("status").alias("source_version_status"),
        "approved_decision_id",
        "created_at",
        "retired_at",
    )
    decision = latest_per_key(decisions, ["resource_key"], ["decided_at", "manual_review_decision_id"]).select(
        "resource_key", F.col("decision").alias("latest_decision"), F.col("decided_at").alias("latest_decision_at")
    )
    state = resources.select("resource_key").join(version, "resource_key", "left").join(decision, "resource_key", "left")
    return state.withColumn(
        "eligible_for_full_ingestion", is_eligible(F.col("source_version_status"), F.col("retired_at"))
    )
