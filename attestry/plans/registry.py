"""Registration of queries and the adapters that shape the given tables into ledgers.

An adapter is one SQL text that both engines run, so that a query and its counterpart start from
the same rows; the operators under test are never shared.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

CENTS = "CAST(ROUND(o_totalprice * 100) AS BIGINT)"

ADAPTERS: dict[str, str] = {
    # Catalog and review ledgers.
    "resources": """
        SELECT c_custkey AS resource_key, c_nationkey AS catalog_dataset_id,
               CASE c_mktsegment WHEN 'MACHINERY' THEN 'API' WHEN 'BUILDING' THEN 'DATA'
                 WHEN 'AUTOMOBILE' THEN 'DOCUMENTATION' WHEN 'HOUSEHOLD' THEN 'LANDING_PAGE'
                 ELSE 'DATA_DICTIONARY' END AS resource_type,
               'https://data.example.org/resource/' || c_name AS canonical_source_url,
               c_acctbal >= 0 AS is_active
        FROM {customer}""",
    "datasets": """
        SELECT n_nationkey AS catalog_dataset_id, n_name AS dataset_key, r_name AS catalog_name
        FROM {nation} n JOIN {region} r ON n.n_regionkey = r.r_regionkey""",
    "components": f"""
        SELECT o_orderkey AS dataset_quality_assessment_id, o_custkey AS resource_key, o_orderdate AS assessed_at,
               CASE o_orderstatus WHEN 'P' THEN 'PENDING_REVIEW' WHEN 'O' THEN 'DRAFT' ELSE 'CONDITIONAL' END AS assessment_status,
               CAST({CENTS} % 101 AS DECIMAL(5,2)) AS relevance_score,
               CAST(CAST(FLOOR({CENTS} / 7) AS BIGINT) % 101 AS DECIMAL(5,2)) AS joinability_score,
               CAST(CAST(FLOOR({CENTS} / 11) AS BIGINT) % 101 AS DECIMAL(5,2)) AS accessibility_score,
               CAST(CAST(FLOOR({CENTS} / 13) AS BIGINT) % 101 AS DECIMAL(5,2)) AS documentation_score,
               CAST(CAST(FLOOR({CENTS} / 17) AS BIGINT) % 101 AS DECIMAL(5,2)) AS quality_score
        FROM {{orders}}""",
    "decisions": """
        SELECT event_id AS manual_review_decision_id, user_id AS resource_key, ts AS decided_at,
               CASE WHEN value < 80 THEN 'DEFERRED' WHEN value < 95 THEN 'APPROVED' WHEN value < 110 THEN 'APPROVED_WITH_CONDITIONS'
                 WHEN value < 130 THEN 'REJECTED' WHEN value < 160 THEN 'RETIRED' ELSE 'DEFERRED' END AS decision,
               'reviewed with ' || props AS rationale, event_type AS reviewer_username
        FROM {events} WHERE event_type = 'purchase'""",
    "changes": """
        SELECT event_id AS schema_change_event_id, user_id AS resource_key, ts AS detected_at,
               CASE WHEN value < 90 THEN 'COMPATIBLE' WHEN value < 130 THEN 'BREAKING'
                 WHEN value < 180 THEN 'REVIEW_REQUIRED' ELSE 'IGNORED_WITH_JUSTIFICATION' END AS compatibility_outcome
        FROM {events} WHERE event_type = 'error'""",
    "document_snapshots": """
        SELECT event_id AS source_document_snapshot_id, user_id AS resource_key, ts AS retrieved_at,
               CASE WHEN value < 25 THEN 'LICENSE' WHEN value < 60 THEN 'METHODOLOGY' ELSE 'TERMS' END AS document_type,
               props AS content_sha256
        FROM {events} WHERE event_type = 'view'""",
    "schema_snapshots": """
        SELECT event_id AS schema_snapshot_id, user_id AS resource_key, ts AS retrieved_at
        FROM {events} WHERE event_type = 'click'""",
    "profile_events": """
        SELECT event_id AS source_access_profile_id, user_id AS resource_key, ts AS effective_from,
               CASE WHEN value < 50 THEN ':id ASC' WHEN value < 100 THEN 'name ASC' END AS deterministic_order_clause,
               'SODA-' || props AS connector_name
        FROM {events} WHERE event_type = 'signup'""",
    "stewards": """
        SELECT s_name AS username, CASE WHEN s_acctbal < 4000 THEN 'GLOBAL' ELSE CAST(s_nationkey AS STRING) END AS authorization_scope,
               s_acctbal >= 0 AS is_active, CAST(s_suppkey AS STRING) AS granted_by
        FROM {supplier}""",
    "resource_versions": """
        SELECT o_orderkey AS data_source_version_id, o_custkey AS resource_key,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'APPROVED' WHEN '2-HIGH' THEN 'CONDITIONAL'
                 WHEN '3-MEDIUM' THEN 'APPROVED' WHEN '5-LOW' THEN 'REJECTED' ELSE 'PENDING_REVIEW' END AS status,
               CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_custkey END AS approved_decision_id,
               o_orderdate AS created_at, CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS retired_at
        FROM {orders}""",
    "source_versions": """
        SELECT c_custkey AS data_source_version_id, c_name AS resource_key,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'APPROVED' WHEN 'AUTOMOBILE' THEN 'CONDITIONAL'
                 WHEN 'FURNITURE' THEN 'APPROVED' WHEN 'MACHINERY' THEN 'RETIRED' ELSE 'REJECTED' END AS status,
               CASE WHEN c_acctbal < 0 THEN c_name END AS retired_at
        FROM {customer}""",
    # Surveillance records as source JSON, with markers, an explicit null and a suppressed count.
    "surveillance": f"""
        SELECT o_orderkey AS source_record_id, o_custkey AS data_source_version_id, o_orderdate AS retrieved_at,
               '{{{{"year":' || CASE WHEN o_orderstatus = 'O' THEN '"' || CAST(EXTRACT(YEAR FROM o_orderdate) AS STRING) || '"'
                                  ELSE CAST(EXTRACT(YEAR FROM o_orderdate) AS STRING) END
               || ',"fips":' || CASE o_orderpriority WHEN '5-LOW' THEN '"Unknown"' WHEN '4-NOT SPECIFIED' THEN 'null'
                                  ELSE '"' || CAST(o_custkey AS STRING) || '"' END
               || ',"case_status":"' || o_orderstatus || '"'
               || CASE o_orderpriority WHEN '1-URGENT' THEN '' WHEN '2-HIGH' THEN ',"sex":"Not Reported"' ELSE ',"sex":"F"' END
               || ',"age_cat_yrs":"' || o_orderpriority || '"'
               || ',"frequency":' || CASE WHEN o_orderstatus = 'P' THEN '"Suppressed"' WHEN o_orderpriority = '3-MEDIUM' THEN '0'
                                       ELSE CAST({CENTS} % 1000 AS STRING) END
               || '}}}}' AS payload
        FROM {{orders}}""",
    # Acquisition runs and requests.
    "pages_fetched": """
        SELECT l_orderkey AS ingestion_run_id, l_linenumber AS request_sequence, CAST(l_quantity AS BIGINT) AS retrieved_row_count
        FROM {lineitem}""",
    "turns": """
        SELECT conv_id AS ingestion_run_id, turn AS request_sequence, text FROM {conversations}""",
    "runs": """
        SELECT event_id AS ingestion_run_id, user_id AS resource_key, ts AS started_at,
               CASE event_type WHEN 'view' THEN 'COMPLETED' WHEN 'click' THEN 'PARTIAL' WHEN 'error' THEN 'FAILED'
                 WHEN 'purchase' THEN 'BLOCKED_REVIEW' ELSE 'RUNNING' END AS status
        FROM {events}""",
    # Releases: orders by year.
    "release_rows": """
        SELECT CAST(EXTRACT(YEAR FROM o_orderdate) AS STRING) AS release_id, o_orderkey AS record_key,
               CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS geometry_json, o_orderdate AS generated_at
        FROM {orders}""",
    # Schema snapshots whose fields are the lines of an order.
    "schema_history": """
        SELECT o_orderkey AS schema_snapshot_id, o_custkey AS resource_key, o_orderdate AS retrieved_at FROM {orders}""",
    "schema_fields": """
        SELECT l_orderkey AS schema_snapshot_id, 'field_' || CAST(l_linenumber AS STRING) AS field_name,
               MAX(l_returnflag) AS data_type, MAX(l_linestatus) AS domain,
               CAST(MAX(CAST(l_quantity AS BIGINT)) AS STRING) AS description, MIN(l_suppkey) AS position
        FROM {lineitem} GROUP BY l_orderkey, 'field_' || CAST(l_linenumber AS STRING)""",
    # Places for spatial matching.
    "places": """
        SELECT c_custkey AS point_id, ((c_custkey * 7919) % 36000) / 100.0 - 180 AS lon,
               ((c_custkey * 104729) % 17000) / 100.0 - 85 AS lat, c_acctbal AS amount
        FROM {customer}""",
    "stations": """
        SELECT s_suppkey AS station_id, ((s_suppkey * 15013) % 36000) / 100.0 - 180 AS lon,
               ((s_suppkey * 7001) % 17000) / 100.0 - 85 AS lat
        FROM {supplier}""",
    "districts": """
        SELECT n_nationkey AS area_id, CAST(n_nationkey * 13 - 160 AS DOUBLE) AS cx, CAST((n_nationkey * 37) % 120 - 60 AS DOUBLE) AS cy,
               CAST(6 + n_regionkey * 3 AS DOUBLE) + 0.303 AS half
        FROM {nation}""",
    # Lineage: lines feed orders, orders feed customers, customers feed nations, nations feed regions.
    "edges": """
        SELECT 'order:' || CAST(o_orderkey AS STRING) AS output_object, 'customer:' || CAST(o_custkey AS STRING) AS input_object FROM {orders}
        UNION ALL SELECT 'customer:' || CAST(c_custkey AS STRING), 'nation:' || CAST(c_nationkey AS STRING) FROM {customer}
        UNION ALL SELECT 'nation:' || CAST(n_nationkey AS STRING), 'region:' || CAST(n_regionkey AS STRING) FROM {nation}""",
}

# CTEs that exist only on the DuckDB side and build on adapters.
DERIVED: dict[str, str] = {
    "scored": """
        SELECT *, (25 * relevance_score + 25 * joinability_score + 20 * accessibility_score
                   + 15 * documentation_score + 15 * quality_score) / 100.0 AS raw_score FROM components""",
    "assessments": """
        SELECT *, CAST(ROUND(raw_score, 2) AS DOUBLE) AS overall_score,
               CASE WHEN raw_score >= 70 THEN 'APPROVED' WHEN raw_score >= 50 THEN 'CONDITIONAL' ELSE 'REJECTED' END AS recommendation
        FROM scored""",
    "latest_assessment": """
        SELECT * FROM assessments QUALIFY ROW_NUMBER() OVER (
          PARTITION BY resource_key ORDER BY assessed_at DESC, dataset_quality_assessment_id DESC) = 1""",
    "latest_decision": """
        SELECT * FROM decisions QUALIFY ROW_NUMBER() OVER (
          PARTITION BY resource_key ORDER BY decided_at DESC, manual_review_decision_id DESC) = 1""",
    "queue": """
        SELECT r.resource_key, r.resource_type, r.canonical_source_url, d.catalog_name, d.dataset_key, a.assessment_status,
               a.overall_score, a.recommendation, a.assessed_at,
               EXISTS (SELECT 1 FROM changes e WHERE e.resource_key = r.resource_key
                       AND e.compatibility_outcome <> 'COMPATIBLE') AS has_material_schema_change
        FROM resources r LEFT JOIN datasets d USING (catalog_dataset_id)
        LEFT JOIN latest_assessment a ON a.resource_key = r.resource_key
        WHERE r.is_active AND NOT EXISTS (SELECT 1 FROM decisions x WHERE x.resource_key = r.resource_key)""",
    "profiles": """
        SELECT *, LEAD(effective_from) OVER (PARTITION BY resource_key ORDER BY effective_from, source_access_profile_id) AS effective_to
        FROM profile_events""",
}

_ASSESSED = ("components", "scored", "assessments", "latest_assessment")
QUEUE = ("resources", "datasets", "decisions", "changes", *_ASSESSED, "queue")
ASSESSED = _ASSESSED


class Tables:
    """The given tables and the adapters over them, read lazily."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if name in ADAPTERS:
            text = ADAPTERS[name]
            used = {t: getattr(self, t) for t in TABLES if "{" + t + "}" in text}
            return self.spark.sql(text, **used)
        raise AttributeError(name)


def duckdb_text(sql: str, uses: Sequence[str]) -> str:
    """Counterpart SQL with the adapters it uses in front as common table expressions."""
    plain = {t: t for t in TABLES}
    parts = [f"{n} AS ({(ADAPTERS[n].format(**plain) if n in ADAPTERS else DERIVED[n]).strip()})" for n in uses]
    body, recursive = sql.strip(), ""
    for head in ("WITH RECURSIVE ", "WITH "):
        if body.startswith(head):
            body, recursive = body.removeprefix(head), "RECURSIVE " if "RECURSIVE" in head else ""
            return f"WITH {recursive}{', '.join([*parts, body])}"
    return f"WITH {', '.join(parts)} {body}" if parts else body


def query(name: str, sql: str | None = None, uses: Sequence[str] = ()) -> Callable:
    """Register ``fn(tables)`` under ``name``, with its counterpart SQL if there is one."""

    def wrap(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = duckdb_text(sql, uses)
        return fn

    return wrap
