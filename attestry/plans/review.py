"""Queries: typed layers, history, review queue, gate and decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.functions.values import (
    COUNTY_SURVEILLANCE,
    annotate_semantics,
    mark_value_states,
    score_sources,
    type_payload,
    value_state,
)
from attestry.operators import console, gate, history
from attestry.operators.lineage import attach_provenance, dim_source_version
from attestry.operators.segments import latest_per_key
from attestry.plans.registry import ASSESSED, QUEUE, Tables, query

SURVEILLANCE_FIELDS = {
    "county_fips": ("fips", "string"),
    "report_year": ("year", "decimal(38,0)"),
    "case_status": ("case_status", "string"),
    "sex": ("sex", "string"),
    "age_category_years": ("age_cat_yrs", "string"),
    "frequency": ("frequency", "decimal(38,0)"),
}


def assessments(t: Tables) -> DataFrame:
    return score_sources(t.components)


def surveillance_raw(t: Tables) -> DataFrame:
    return t.surveillance.withColumn("payload", F.parse_json("payload"))


def staging(t: Tables) -> DataFrame:
    """The flagship: approved source versions only, typed fields, value states kept apart."""
    typed = type_payload(gate.gate(surveillance_raw(t), t.source_versions), "payload", SURVEILLANCE_FIELDS)
    marked = {n: F.col(n) for n in ("county_fips", "sex", "age_category_years")}
    marked["frequency"] = F.try_variant_get("payload", "$.frequency", "string")
    return typed.withColumn("source_value_status", mark_value_states(marked))


STAGED_SQL = """
    staged AS (
      SELECT s.source_record_id, s.data_source_version_id, json_extract_string(s.payload, '$.fips') AS county_fips,
             TRY_CAST(json_extract_string(s.payload, '$.year') AS BIGINT) AS report_year,
             json_extract_string(s.payload, '$.case_status') AS case_status,
             json_extract_string(s.payload, '$.sex') AS sex,
             json_extract_string(s.payload, '$.age_cat_yrs') AS age_category_years,
             TRY_CAST(json_extract_string(s.payload, '$.frequency') AS BIGINT) AS frequency,
             json_extract_string(s.payload, '$.frequency') AS frequency_text
      FROM surveillance s
      WHERE EXISTS (SELECT 1 FROM source_versions v WHERE v.data_source_version_id = s.data_source_version_id
                    AND v.status IN ('APPROVED', 'CONDITIONAL') AND v.retired_at IS NULL)),
    marked AS (
      SELECT *, '{' || array_to_string(list_filter([
          CASE WHEN lower(county_fips) IN ('unknown','suppressed','not reported') THEN '"county_fips":"' || lower(county_fips) || '"' END,
          CASE WHEN lower(sex) IN ('unknown','suppressed','not reported') THEN '"sex":"' || lower(sex) || '"' END,
          CASE WHEN lower(age_category_years) IN ('unknown','suppressed','not reported') THEN '"age_category_years":"' || lower(age_category_years) || '"' END,
          CASE WHEN lower(frequency_text) IN ('unknown','suppressed','not reported') THEN '"frequency":"' || lower(frequency_text) || '"' END],
          lambda x: x IS NOT NULL), ',') || '}' AS source_value_status
      FROM staged)"""
STAGING_COLUMNS = "source_record_id data_source_version_id county_fips report_year case_status sex age_category_years frequency source_value_status".split()


@query(
    "staging_gate",
    f"WITH {STAGED_SQL} SELECT {', '.join(STAGING_COLUMNS)} FROM marked",
    ["surveillance", "source_versions"],
)
def staging_gate(t: Tables) -> DataFrame:
    whole = {c: F.col(c).cast("bigint") for c in ("report_year", "frequency")}
    return staging(t).withColumns(whole).select(*STAGING_COLUMNS)


@query(
    "conformed",
    f"""WITH {STAGED_SQL}
    SELECT m.source_record_id, m.county_fips, m.report_year, m.frequency, m.source_value_status,
           v.resource_key AS source_name, d.decision_total, p.n_name AS artifact_nation,
           'COUNTY_OF_RESIDENCE' AS geography_semantics, 'COUNTY_YEAR_CASE_STATUS_SEX_AGE' AS source_resolution,
           'ANNUAL_SURVEILLANCE_YEAR' AS temporal_window,
           '2022-current surveillance era; not comparable to prior eras without review' AS caveat
    FROM marked m
    LEFT JOIN source_versions v ON v.data_source_version_id = m.data_source_version_id
    LEFT JOIN (SELECT resource_key, COUNT(*) AS decision_total FROM decisions GROUP BY 1) d ON d.resource_key = m.data_source_version_id
    LEFT JOIN (SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey) p ON p.c_custkey = m.data_source_version_id""",
    ["surveillance", "source_versions", "decisions"],
)
def conformed(t: Tables) -> DataFrame:
    facts = annotate_semantics(staging(t), COUNTY_SURVEILLANCE).withColumns(
        {"ingestion_run_id": F.col("data_source_version_id"), "artifact_id": F.col("data_source_version_id")}
    )
    versions = dim_source_version(t.source_versions).select(
        "data_source_version_id", F.col("resource_key").alias("source_name")
    )
    runs = t.decisions.groupBy(F.col("resource_key").alias("ingestion_run_id")).agg(
        F.count(F.lit(1)).alias("decision_total")
    )
    artifacts = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("artifact_id"), F.col("n_name").alias("artifact_nation")
    )
    whole = {c: F.col(c).cast("bigint") for c in ("report_year", "frequency")}
    return attach_provenance(facts, versions, runs, artifacts).withColumns(whole).select(
        "source_record_id", "county_fips", "report_year", "frequency", "source_value_status", "source_name",
        "decision_total", "artifact_nation", "geography_semantics", "source_resolution", "temporal_window", "caveat",
    )


@query(
    "value_states",
    """SELECT source_record_id,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'UNKNOWN' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'NULL'
              WHEN o_custkey = 0 THEN 'ZERO' ELSE 'VALUE' END AS fips_state,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'MISSING' WHEN '2-HIGH' THEN 'NOT_REPORTED' ELSE 'VALUE' END AS sex_state,
         CASE WHEN o_orderstatus = 'P' THEN 'SUPPRESSED' WHEN o_orderpriority = '3-MEDIUM' THEN 'ZERO'
              WHEN CAST(ROUND(o_totalprice * 100) AS BIGINT) % 1000 = 0 THEN 'ZERO' ELSE 'VALUE' END AS frequency_state
       FROM surveillance JOIN orders ON o_orderkey = source_record_id""",
    ["surveillance"],
)
def value_states(t: Tables) -> DataFrame:
    raw = surveillance_raw(t)
    return raw.select(
        "source_record_id",
        value_state(F.col("payload"), "fips").alias("fips_state"),
        value_state(F.col("payload"), "sex").alias("sex_state"),
        value_state(F.col("payload"), "frequency").alias("frequency_state"),
    )


@query(
    "score_sources",
    "SELECT dataset_quality_assessment_id, resource_key, overall_score, recommendation FROM assessments",
    ASSESSED[:3],
)
def score_sources_query(t: Tables) -> DataFrame:
    return assessments(t).select(
        "dataset_quality_assessment_id", "resource_key", F.col("overall_score").cast("double").alias("overall_score"), "recommendation"
    )


@query(
    "latest_assessment",
    "SELECT resource_key, dataset_quality_assessment_id, assessment_status, overall_score, recommendation, assessed_at FROM latest_assessment",
    ASSESSED,
)
def latest_assessment(t: Tables) -> DataFrame:
    newest = latest_per_key(assessments(t), ["resource_key"], ["assessed_at", "dataset_quality_assessment_id"])
    return newest.select(
        "resource_key", "dataset_quality_assessment_id", "assessment_status",
        F.col("overall_score").cast("double").alias("overall_score"), "recommendation", "assessed_at",
    )


def queue(t: Tables) -> DataFrame:
    return console.approval_queue(t.resources, t.datasets, assessments(t), t.decisions, t.changes)


QUEUE_COLUMNS = "resource_key resource_type canonical_source_url catalog_name dataset_key assessment_status overall_score recommendation assessed_at has_material_schema_change".split()


def _queue_output(df: DataFrame, *more: str) -> DataFrame:
    return df.withColumn("overall_score", F.col("overall_score").cast("double")).select(*QUEUE_COLUMNS, *more)


@query("approval_queue", f"SELECT {', '.join(QUEUE_COLUMNS)} FROM queue", QUEUE)
def approval_queue(t: Tables) -> DataFrame:
    return _queue_output(queue(t))


@query(
    "approval_queue_requeued",
    """WITH q AS (
      SELECT r.resource_key, l.decision AS latest_decision, l.decided_at AS latest_decision_at,
             MAX(c.detected_at) AS changed_at
      FROM resources r LEFT JOIN latest_decision l ON l.resource_key = r.resource_key
      LEFT JOIN changes c ON c.resource_key = r.resource_key AND c.compatibility_outcome <> 'COMPATIBLE'
      WHERE r.is_active GROUP BY 1, 2, 3)
    SELECT resource_key, latest_decision, latest_decision_at, changed_at IS NOT NULL AS has_material_schema_change
    FROM q WHERE latest_decision IS NULL OR changed_at > latest_decision_at""",
    ["resources", "decisions", "changes", "latest_decision"],
)
def approval_queue_requeued(t: Tables) -> DataFrame:
    again = console.approval_queue(t.resources, t.datasets, assessments(t), t.decisions, t.changes, requeue_on_change=True)
    return again.select("resource_key", "latest_decision", "latest_decision_at", "has_material_schema_change")


@query(
    "approval_queue_top",
    f"""SELECT {', '.join(QUEUE_COLUMNS)} FROM queue
        ORDER BY has_material_schema_change DESC, overall_score DESC NULLS LAST, assessed_at ASC NULLS LAST, resource_key LIMIT 200""",
    QUEUE,
)
def approval_queue_top(t: Tables) -> DataFrame:
    return _queue_output(console.review_queue_top(queue(t)))


@query(
    "approval_queue_filtered",
    f"""SELECT {', '.join(QUEUE_COLUMNS)} FROM queue
        WHERE catalog_name IN ('ASIA', 'EUROPE') AND resource_type IN ('API', 'DATA') AND overall_score BETWEEN 40 AND 80
          AND assessed_at >= TIMESTAMP '1999-01-01' AND assessed_at < TIMESTAMP '2001-07-01'
          AND assessment_status IN ('PENDING_REVIEW', 'DRAFT')""",
    QUEUE,
)
def approval_queue_filtered(t: Tables) -> DataFrame:
    kept = console.queue_filter(
        queue(t),
        catalogs=["ASIA", "EUROPE"],
        resource_types=["API", "DATA"],
        score_between=(40, 80),
        assessed_between=(F.lit("1999-01-01").cast("timestamp_ntz"), F.lit("2001-07-01").cast("timestamp_ntz")),
        statuses=["PENDING_REVIEW", "DRAFT"],
    )
    return _queue_output(kept)


def profiles(t: Tables) -> DataFrame:
    return history.close_intervals(t.profile_events, ["resource_key"], "effective_from", "source_access_profile_id")


@query(
    "approval_detail",
    """SELECT q.resource_key, q.overall_score, q.has_material_schema_change, p.source_access_profile_id, p.connector_name,
         (SELECT COUNT(*) FROM document_snapshots s WHERE s.resource_key = q.resource_key) AS document_snapshot_count,
         (SELECT COUNT(*) FROM schema_snapshots s WHERE s.resource_key = q.resource_key) AS schema_snapshot_count
       FROM queue q LEFT JOIN profiles p ON p.resource_key = q.resource_key AND p.effective_to IS NULL""",
    [*QUEUE, "document_snapshots", "schema_snapshots", "profile_events", "profiles"],
)
def approval_detail(t: Tables) -> DataFrame:
    detail = console.approval_detail(queue(t), profiles(t), t.document_snapshots, t.schema_snapshots)
    return detail.select(
        "resource_key", F.col("overall_score").cast("double").alias("overall_score"), "has_material_schema_change",
        "source_access_profile_id", "connector_name", "document_snapshot_count", "schema_snapshot_count",
    )


@query(
    "evidence_counts",
    """SELECT r.resource_key, (SELECT COUNT(*) FROM document_snapshots s WHERE s.resource_key = r.resource_key) AS document_snapshot_count,
         (SELECT COUNT(*) FROM schema_snapshots s WHERE s.resource_key = r.resource_key) AS schema_snapshot_count,
         EXISTS (SELECT 1 FROM changes c WHERE c.resource_key = r.resource_key AND c.compatibility_outcome <> 'COMPATIBLE') AS has_material_change
       FROM resources r""",
    ["resources", "document_snapshots", "schema_snapshots", "changes"],
)
def evidence_counts(t: Tables) -> DataFrame:
    counted = gate.count_matches(t.resources.select("resource_key"), t.document_snapshots, "resource_key", "document_snapshot_count")
    counted = gate.count_matches(counted, t.schema_snapshots, "resource_key", "schema_snapshot_count")
    material = t.changes.filter(F.col("compatibility_outcome") != "COMPATIBLE")
    return gate.flag_exists(counted, material, "resource_key", "has_material_change")


@query(
    "review_history",
    """SELECT manual_review_decision_id, resource_key, decision, rationale, reviewer_username,
         LAG(manual_review_decision_id) OVER (PARTITION BY resource_key ORDER BY decided_at, manual_review_decision_id) AS supersedes_decision_id,
         decided_at FROM decisions""",
    ["decisions"],
)
def review_history(t: Tables) -> DataFrame:
    linked = history.supersessions(t.decisions)
    return console.review_history(linked).drop("conditions", "data_source_version_id", "app_version", "correlation_id")


@query(
    "lookup_resource",
    """SELECT manual_review_decision_id, decision, decided_at FROM decisions
       WHERE resource_key = (SELECT MIN(resource_key) FROM decisions) ORDER BY decided_at DESC, manual_review_decision_id""",
    ["decisions"],
)
def lookup_resource(t: Tables) -> DataFrame:
    wanted = t.decisions.agg(F.min("resource_key")).scalar()
    found = t.decisions.filter(F.col("resource_key") == wanted)
    return found.select("manual_review_decision_id", "decision", "decided_at").orderBy(
        F.desc("decided_at"), "manual_review_decision_id"
    )


@query(
    "queue_first_generation",
    """SELECT a.resource_key, a.overall_score, a.recommendation, a.assessment_status, MAX(d.decided_at) AS latest_decision_at
       FROM assessments a LEFT JOIN decisions d USING (resource_key) GROUP BY 1, 2, 3, 4""",
    [*ASSESSED[:3], "decisions"],
)
def queue_first_generation(t: Tables) -> DataFrame:
    first = console.first_generation_queue(assessments(t), t.decisions)
    return first.select(
        "resource_key", F.col("overall_score").cast("double").alias("overall_score"), "recommendation",
        "assessment_status", "latest_decision_at",
    )


@query(
    "pipeline_status",
    """WITH v AS (SELECT * FROM resource_versions WHERE retired_at IS NULL QUALIFY ROW_NUMBER() OVER (
         PARTITION BY resource_key ORDER BY created_at DESC, data_source_version_id DESC) = 1)
       SELECT r.resource_key, v.data_source_version_id, v.status AS source_version_status, v.created_at,
         l.decision AS latest_decision, l.decided_at AS latest_decision_at,
         COALESCE(v.status IN ('APPROVED', 'CONDITIONAL'), FALSE) AS eligible_for_full_ingestion
       FROM resources r LEFT JOIN v ON v.resource_key = r.resource_key LEFT JOIN latest_decision l ON l.resource_key = r.resource_key""",
    ["resources", "resource_versions", "decisions", "latest_decision"],
)
def pipeline_status(t: Tables) -> DataFrame:
    state = gate.resource_latest_state(t.resources, t.resource_versions, t.decisions)
    return state.select(
        "resource_key", "data_source_version_id", "source_version_status", "created_at", "latest_decision",
        "latest_decision_at", "eligible_for_full_ingestion",
    )


@query("active_stewards", "SELECT username, authorization_scope FROM stewards WHERE is_active", ["stewards"])
def active_stewards(t: Tables) -> DataFrame:
    return console.active_stewards(t.stewards)


def decision_batch(t: Tables) -> DataFrame:
    """Decisions submitted through the console: reviewers are suppliers' names, some unknown."""
    return t.spark.sql(DECISION_BATCH.format(cents="CAST(ROUND(value * 100) AS BIGINT)", events="{events}", conditions=SPARK_CONDITIONS), events=t.events)


SPARK_CONDITIONS = "CASE WHEN value < 60 THEN array('check ' || props) WHEN value < 110 THEN array(' ', '') END"
DUCK_CONDITIONS = "CASE WHEN value < 60 THEN ['check ' || props] WHEN value < 110 THEN [' ', ''] END"
DECISION_BATCH = """
    SELECT event_id AS submission_id, user_id AS resource_key, ts AS decided_at,
           CASE event_type WHEN 'purchase' THEN 'APPROVED' WHEN 'view' THEN 'APPROVED_WITH_CONDITIONS' WHEN 'click' THEN 'REJECTED'
             WHEN 'signup' THEN 'DEFERRED' ELSE 'PUBLISH' END AS decision,
           CASE WHEN value < 3 THEN '   short   ' ELSE 'because of ' || props END AS rationale,
           {conditions} AS conditions,
           'Supplier#' || lpad(CAST({cents} % 120 AS STRING), 9, '0') AS reviewer_username,
           'console' AS app_version, CAST(event_id AS STRING) AS correlation_id
    FROM {events}"""
BATCH_SQL = "batch AS (" + DECISION_BATCH.format(cents="CAST(ROUND(value * 100) AS BIGINT)", events="events", conditions=DUCK_CONDITIONS) + ")"
FACTS_SQL = """
    facts AS (
      SELECT k.resource_key,
        (SELECT COUNT(*) FROM document_snapshots s WHERE s.resource_key = k.resource_key) AS document_count,
        (SELECT COUNT(*) FROM schema_snapshots s WHERE s.resource_key = k.resource_key) AS schema_count,
        (SELECT COUNT(*) FROM profiles s WHERE s.resource_key = k.resource_key AND s.effective_to IS NULL) AS open_profile_count,
        (SELECT COUNT(*) FROM changes s WHERE s.resource_key = k.resource_key
           AND s.compatibility_outcome NOT IN ('COMPATIBLE', 'IGNORED_WITH_JUSTIFICATION')
           AND NOT EXISTS (SELECT 1 FROM decisions d WHERE d.resource_key = s.resource_key AND d.decided_at > s.detected_at AND d.decision IN ('APPROVED', 'APPROVED_WITH_CONDITIONS'))) AS blocking_count,
        a.assessment_status
      FROM (SELECT resource_key FROM document_snapshots UNION SELECT resource_key FROM schema_snapshots
            UNION SELECT resource_key FROM profiles UNION SELECT resource_key FROM assessments
            UNION SELECT resource_key FROM changes c WHERE c.compatibility_outcome NOT IN ('COMPATIBLE', 'IGNORED_WITH_JUSTIFICATION')
              AND NOT EXISTS (SELECT 1 FROM decisions d WHERE d.resource_key = c.resource_key AND d.decided_at > c.detected_at AND d.decision IN ('APPROVED', 'APPROVED_WITH_CONDITIONS'))) k
      LEFT JOIN latest_assessment a ON a.resource_key = k.resource_key)"""
FACTS_USES = [*ASSESSED, "document_snapshots", "schema_snapshots", "profile_events", "profiles", "changes", "decisions"]
READY_SQL = "COALESCE(document_count > 0 AND schema_count > 0 AND open_profile_count = 1 AND assessment_status = 'PENDING_REVIEW' AND blocking_count = 0, FALSE)"
JUDGED_SQL = f"""
    judged AS (
      SELECT b.*, CASE
        WHEN b.decision NOT IN ('APPROVED','APPROVED_WITH_CONDITIONS','REJECTED','RETIRED','DEFERRED') THEN -20001
        WHEN length(trim(b.rationale)) NOT BETWEEN 10 AND 10000 THEN -20002
        WHEN b.decision <> 'APPROVED' AND NOT COALESCE(len(list_filter(b.conditions, lambda c: length(trim(c)) > 0)) > 0, FALSE) THEN -20003
        WHEN (SELECT COUNT(*) FROM stewards s WHERE s.is_active AND s.username = b.reviewer_username
                AND s.authorization_scope IN ('GLOBAL', CAST(b.resource_key AS STRING))) <> 1 THEN -20004
        WHEN b.decision IN ('APPROVED','APPROVED_WITH_CONDITIONS') AND NOT COALESCE({READY_SQL}, FALSE) THEN -20005 END AS error_code
      FROM batch b LEFT JOIN facts f ON f.resource_key = b.resource_key)"""


def facts(t: Tables) -> DataFrame:
    blocking = gate.unresolved_changes(t.changes, t.decisions)
    return gate.evidence_facts(
        t.document_snapshots, t.schema_snapshots, history.open_rows(profiles(t), "effective_to"), assessments(t), blocking
    )


@query(
    "prerequisites",
    f"WITH {FACTS_SQL} SELECT resource_key, document_count, schema_count, open_profile_count, blocking_count, assessment_status, {READY_SQL} AS ready FROM facts",
    FACTS_USES,
)
def prerequisites(t: Tables) -> DataFrame:
    return facts(t).withColumn("ready", gate.prerequisites_met())


@query(
    "evidence_complete",
    """SELECT resource_key, is_active FROM resources r
       WHERE EXISTS (SELECT 1 FROM document_snapshots s WHERE s.resource_key = r.resource_key)
         AND EXISTS (SELECT 1 FROM schema_snapshots s WHERE s.resource_key = r.resource_key)
         AND EXISTS (SELECT 1 FROM components s WHERE s.resource_key = r.resource_key AND s.assessment_status = 'PENDING_REVIEW')""",
    ["resources", "document_snapshots", "schema_snapshots", "components"],
)
def evidence_complete(t: Tables) -> DataFrame:
    pending = t.components.filter(F.col("assessment_status") == "PENDING_REVIEW")
    done = gate.evidence_complete(t.resources, t.document_snapshots, t.schema_snapshots, pending)
    return done.select("resource_key", "is_active")


@query(
    "validate_decisions",
    f"""WITH {BATCH_SQL} SELECT submission_id, CASE
        WHEN decision NOT IN ('APPROVED','APPROVED_WITH_CONDITIONS','REJECTED','RETIRED','DEFERRED') THEN -20001
        WHEN length(trim(rationale)) NOT BETWEEN 10 AND 10000 THEN -20002
        WHEN decision <> 'APPROVED' AND NOT COALESCE(len(list_filter(conditions, lambda c: length(trim(c)) > 0)) > 0, FALSE) THEN -20003 END AS error_code
        FROM batch""",
)
def validate_decisions(t: Tables) -> DataFrame:
    return gate.validate_decisions(decision_batch(t)).select("submission_id", "error_code")


@query(
    "authorize",
    f"""WITH {BATCH_SQL} SELECT b.submission_id, (SELECT COUNT(*) FROM stewards s WHERE s.is_active AND s.username = b.reviewer_username
          AND s.authorization_scope IN ('GLOBAL', CAST(b.resource_key AS STRING))) AS steward_count FROM batch b""",
    ["stewards"],
)
def authorize(t: Tables) -> DataFrame:
    return gate.steward_matches(decision_batch(t), t.stewards).select("submission_id", "steward_count")


def outcome(t: Tables) -> gate.DecisionOutcome:
    return gate.apply_decisions(decision_batch(t), t.stewards, facts(t), t.decisions)


@query(
    "apply_decisions",
    f"WITH {BATCH_SQL}, {FACTS_SQL}, {JUDGED_SQL} SELECT submission_id, resource_key, decision, error_code FROM judged",
    [*FACTS_USES, "stewards"],
)
def apply_decisions(t: Tables) -> DataFrame:
    return outcome(t).judged.select("submission_id", "resource_key", "decision", "error_code")


@query(
    "apply_decisions_accepted",
    f"""WITH {BATCH_SQL}, {FACTS_SQL}, {JUDGED_SQL},
      chain AS (SELECT resource_key, decided_at, 0 AS fresh, manual_review_decision_id AS ref, NULL AS submission_id, NULL AS decision FROM decisions
                UNION ALL SELECT resource_key, decided_at, 1, submission_id, submission_id, decision FROM judged WHERE error_code IS NULL),
      linked AS (SELECT *, LAG(ref) OVER w AS prior, LAG(fresh) OVER w AS prior_fresh FROM chain
                 WINDOW w AS (PARTITION BY resource_key ORDER BY decided_at, fresh, ref))
      SELECT submission_id, resource_key, decision, prior IS NOT NULL AS supersedes,
             CASE WHEN prior_fresh = 0 THEN CAST(prior AS STRING) END AS supersedes_ledger_id,
             decision IN ('APPROVED', 'APPROVED_WITH_CONDITIONS') AS creates_version
      FROM linked WHERE fresh = 1""",
    [*FACTS_USES, "stewards"],
)
def apply_decisions_accepted(t: Tables) -> DataFrame:
    prior = F.col("supersedes_decision_id")
    return outcome(t).decisions.select(
        "submission_id", "resource_key", "decision",
        prior.isNotNull().alias("supersedes"),
        F.when(F.length(prior) < 64, prior).alias("supersedes_ledger_id"),
        F.col("data_source_version_id").isNotNull().alias("creates_version"),
    )


@query(
    "upsert_by_key",
    """WITH newest AS (
         SELECT 'Supplier#' || lpad(CAST(user_id AS STRING), 9, '0') AS username, props AS authorization_scope, value < 50 AS is_active
         FROM events QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
       SELECT COALESCE(s.username, n.username) AS username, COALESCE(n.authorization_scope, s.authorization_scope) AS authorization_scope,
              CASE WHEN n.username IS NOT NULL THEN n.is_active ELSE s.is_active END AS is_active,
              CASE WHEN s.username IS NOT NULL THEN s.granted_by ELSE 'console' END AS granted_by
       FROM stewards s FULL OUTER JOIN newest n ON n.username = s.username""",
    ["stewards"],
)
def upsert_by_key(t: Tables) -> DataFrame:
    updates = t.events.select(
        F.concat(F.lit("Supplier#"), F.lpad(F.col("user_id").cast("string"), 9, "0")).alias("username"),
        F.col("props").alias("authorization_scope"),
        (F.col("value") < 50).alias("is_active"),
        F.lit("console").alias("granted_by"),
        "ts",
        "event_id",
    )
    return history.upsert_by_key(t.stewards, updates, ["username"], ["ts", "event_id"], ["authorization_scope", "is_active"])


@query(
    "retire_orphans",
    """SELECT data_source_version_id, resource_key, 'RETIRED' AS status, approved_decision_id FROM resource_versions v
       WHERE retired_at IS NULL AND approved_decision_id IS NOT NULL
         AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_acctbal >= 0 AND c.c_custkey = v.approved_decision_id)""",
    ["resource_versions"],
)
def retire_orphans(t: Tables) -> DataFrame:
    recorded = t.customer.filter("c_acctbal >= 0").select(F.col("c_custkey").alias("manual_review_decision_id"))
    retired = history.retire_orphans(t.resource_versions, recorded, F.lit("2002-01-01").cast("timestamp_ntz"))
    return retired.select("data_source_version_id", "resource_key", "status", "approved_decision_id")


@query(
    "scd2_profiles",
    "SELECT source_access_profile_id, resource_key, effective_from, effective_to FROM profiles",
    ["profile_events", "profiles"],
)
def scd2_profiles(t: Tables) -> DataFrame:
    return profiles(t).select("source_access_profile_id", "resource_key", "effective_from", "effective_to")


@query(
    "profile_as_of",
    """SELECT d.manual_review_decision_id, d.resource_key, p.source_access_profile_id AS as_of_source_access_profile_id
       FROM decisions d LEFT JOIN profiles p ON p.resource_key = d.resource_key
         AND p.effective_from <= d.decided_at AND (p.effective_to IS NULL OR d.decided_at < p.effective_to)""",
    ["decisions", "profile_events", "profiles"],
)
def profile_as_of(t: Tables) -> DataFrame:
    found = history.valid_at(
        t.decisions, profiles(t), ["resource_key"], "decided_at", "effective_from", "effective_to",
        "manual_review_decision_id", ["source_access_profile_id"],
    )
    return found.select("manual_review_decision_id", "resource_key", "as_of_source_access_profile_id")


@query(
    "open_profile",
    """SELECT r.resource_key, p.source_access_profile_id, p.connector_name FROM resources r
       LEFT JOIN profiles p ON p.resource_key = r.resource_key AND p.effective_to IS NULL""",
    ["resources", "profile_events", "profiles"],
)
def open_profile(t: Tables) -> DataFrame:
    return history.join_open(t.resources.select("resource_key"), profiles(t), "resource_key", "effective_to").select(
        "resource_key", "source_access_profile_id", "connector_name"
    )


@query(
    "promotion_gate",
    """WITH results AS (SELECT user_id AS ingestion_run_id, CASE WHEN value > 200 THEN 'FAIL' ELSE 'PASS' END AS status,
             CASE WHEN event_type IN ('view', 'click') THEN 'BLOCKING' ELSE 'WARNING' END AS severity FROM events),
       c AS (SELECT ingestion_run_id, COUNT(*) FILTER (status = 'FAIL' AND severity = 'BLOCKING') AS nb,
               COUNT(*) FILTER (status = 'FAIL' AND severity <> 'BLOCKING') AS nw FROM results GROUP BY 1),
       m AS (SELECT r.resource_key, COALESCE(nb, 0) AS n_blocking_failures, COALESCE(nw, 0) AS n_warnings,
               EXISTS (SELECT 1 FROM changes s WHERE s.resource_key = r.resource_key
                 AND s.compatibility_outcome NOT IN ('COMPATIBLE', 'IGNORED_WITH_JUSTIFICATION')
                 AND NOT EXISTS (SELECT 1 FROM decisions d WHERE d.resource_key = s.resource_key AND d.decided_at > s.detected_at AND d.decision IN ('APPROVED', 'APPROVED_WITH_CONDITIONS'))) AS has_material_change
             FROM resources r LEFT JOIN c ON c.ingestion_run_id = r.resource_key)
       SELECT *, CASE WHEN n_blocking_failures > 0 OR has_material_change THEN 'BLOCKED_REVIEW' ELSE 'PROMOTABLE' END AS promotion_status FROM m""",
    ["resources", "changes", "decisions"],
)
def promotion_gate(t: Tables) -> DataFrame:
    runs = t.resources.select("resource_key", F.col("resource_key").alias("ingestion_run_id"))
    results = t.events.select(
        F.col("user_id").alias("ingestion_run_id"),
        F.when(F.col("value") > 200, "FAIL").otherwise("PASS").alias("status"),
        F.when(F.col("event_type").isin("view", "click"), "BLOCKING").otherwise("WARNING").alias("severity"),
    )
    return gate.promotion_gate(runs, results, gate.unresolved_changes(t.changes, t.decisions)).drop("ingestion_run_id")
