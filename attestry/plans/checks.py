"""Queries: quality rules, reconciliation, change detection, freshness and value-aware aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.operators import change, history, quality
from attestry.plans.registry import Tables, query


# --- rules ------------------------------------------------------------------------------------

DQ_SQL = """
    counted AS (
      SELECT COUNT(*) FILTER (l_partkey IS NULL) AS r1, COUNT(*) FILTER (l_returnflag NOT IN ('A', 'R')) AS r2,
        COUNT(*) FILTER (NOT (l_quantity BETWEEN 1 AND 45)) AS r3, COUNT(*) FILTER (l_returnflag = 'N' AND l_linestatus = 'F') AS r4,
        COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)) AS r5, CAST(COUNT(*) < 100 AS BIGINT) AS r6,
        CAST(date_diff('hour', MAX(l_shipdate), TIMESTAMP '2001-12-01') > 720 AS BIGINT) AS r7 FROM lineitem),
    volume AS (SELECT l_suppkey, date_trunc('month', l_shipdate) AS period, COUNT(*) AS n FROM lineitem GROUP BY 1, 2),
    judged AS (SELECT *, stddev_samp(n) OVER w AS sd, avg(n) OVER w AS m FROM volume WINDOW w AS (PARTITION BY l_suppkey)),
    months AS (SELECT l_suppkey, period, lag(period) OVER (PARTITION BY l_suppkey ORDER BY period) AS before FROM volume),
    results AS (
      SELECT 'partkey_not_null' AS rule_id, 'BLOCKING' AS severity, r1 AS offences FROM counted
      UNION ALL SELECT 'returnflag_domain', 'BLOCKING', r2 FROM counted
      UNION ALL SELECT 'quantity_range', 'BLOCKING', r3 FROM counted
      UNION ALL SELECT 'flag_semantics', 'WARNING', r4 FROM counted
      UNION ALL SELECT 'line_unique', 'BLOCKING', r5 FROM counted
      UNION ALL SELECT 'row_count', 'BLOCKING', r6 FROM counted
      UNION ALL SELECT 'freshness', 'WARNING', r7 FROM counted
      UNION ALL SELECT 'supplier_volume', 'WARNING', COUNT(*) FILTER (sd > 0 AND abs(n - m) > 3.5 * sd) FROM judged
      UNION ALL SELECT 'supplier_continuity', 'WARNING', COALESCE(SUM(date_diff('month', before, period) - 1), 0) FROM months)"""


def dq_results(t: Tables) -> DataFrame:
    lines = t.lineitem
    rules = [
        quality.not_null("partkey_not_null", "l_partkey"),
        quality.in_domain("returnflag_domain", "l_returnflag", ["A", "R"]),
        quality.in_range("quantity_range", "l_quantity", 1, 45),
        quality.semantic("flag_semantics", ~((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"))),
        quality.row_count("row_count", 100),
        quality.fresh_enough("freshness", "l_shipdate", F.lit("2001-12-01").cast("timestamp_ntz"), 720),
    ]
    month = F.date_trunc("month", "l_shipdate").cast("date")
    return quality.combine_results(
        [
            quality.single_pass_rules(lines, rules),
            quality.unique_rule(lines, "line_unique", ["l_orderkey", "l_linenumber"]),
            quality.volume_rule(lines, "supplier_volume", ["l_suppkey"], month),
            quality.continuity_rule(lines.withColumn("period", month), "supplier_continuity", ["l_suppkey"], "period", "month"),
        ]
    )


@query(
    "dq_rules",
    f"WITH {DQ_SQL} SELECT rule_id, severity, CASE WHEN offences > 0 THEN 'FAIL' ELSE 'PASS' END AS status, CAST(offences AS BIGINT) AS offences FROM results",
)
def dq_rules(t: Tables) -> DataFrame:
    return dq_results(t)


@query(
    "quality_summary",
    f"WITH {DQ_SQL} SELECT severity, COUNT(*) FILTER (offences = 0) AS n_pass, COUNT(*) FILTER (offences > 0) AS n_fail FROM results GROUP BY severity",
)
def quality_summary(t: Tables) -> DataFrame:
    return quality.quality_summary(dq_results(t))


@query(
    "referential_checks",
    """SELECT 'line_order' AS relation, COUNT(*) AS orphan_rows, COUNT(DISTINCT l_orderkey) AS orphan_keys FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
       UNION ALL SELECT 'order_active_customer', COUNT(*), COUNT(DISTINCT o_custkey) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
       UNION ALL SELECT 'label_document', COUNT(*), COUNT(DISTINCT doc_id) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en')""",
)
def referential_checks(t: Tables) -> DataFrame:
    return quality.referential_checks(
        {
            "line_order": (t.lineitem, "l_orderkey", t.orders, "o_orderkey"),
            "order_active_customer": (t.orders, "o_custkey", t.customer.filter("c_acctbal >= 0"), "c_custkey"),
            "label_document": (t.labels, "doc_id", t.documents.filter("lang = 'en'"), "doc_id"),
        }
    )


# --- acquisition ------------------------------------------------------------------------------


@query(
    "page_gaps",
    """WITH p AS (SELECT ingestion_run_id, request_sequence, COUNT(*) AS n, MAX(retrieved_row_count) AS page_rows FROM pages_fetched GROUP BY 1, 2)
       SELECT ingestion_run_id, CAST(MAX(request_sequence) AS BIGINT) AS last_sequence, COUNT(*) AS distinct_pages,
         CAST(MAX(request_sequence) - COUNT(*) AS BIGINT) AS missing_pages, CAST(SUM(n - 1) AS BIGINT) AS repeated_pages,
         COUNT(*) FILTER (page_rows < 25) - CASE WHEN arg_max(page_rows, request_sequence) < 25 THEN 1 ELSE 0 END AS short_inner_pages,
         arg_max(page_rows, request_sequence) < 25 AS short_last_page FROM p GROUP BY 1""",
    ["pages_fetched"],
)
def page_gaps(t: Tables) -> DataFrame:
    return quality.page_gaps(t.pages_fetched, "ingestion_run_id", "request_sequence", "retrieved_row_count", 25)


@query(
    "page_gap_ranges",
    """WITH p AS (SELECT DISTINCT ingestion_run_id, request_sequence FROM pages_fetched),
       l AS (SELECT *, COALESCE(lag(request_sequence) OVER (PARTITION BY ingestion_run_id ORDER BY request_sequence), 0) AS prior FROM p)
       SELECT ingestion_run_id, CAST(prior + 1 AS BIGINT) AS gap_from, CAST(request_sequence - 1 AS BIGINT) AS gap_to FROM l WHERE request_sequence > prior + 1""",
    ["pages_fetched"],
)
def page_gap_ranges(t: Tables) -> DataFrame:
    return quality.page_gap_ranges(t.pages_fetched, "ingestion_run_id", "request_sequence")


@query(
    "number_requests",
    """SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS request_sequence FROM lineitem""",
)
def number_requests(t: Tables) -> DataFrame:
    from attestry.operators.segments import numbered

    numbered_rows = numbered(
        t.lineitem, ["l_suppkey"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"],
        "request_sequence",
    )
    return numbered_rows.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "request_sequence")


@query(
    "reconcile_counts",
    """WITH e AS (SELECT o_orderkey AS run, COUNT(*) AS expected FROM orders GROUP BY 1),
       r AS (SELECT l_orderkey AS run, COUNT(*) AS retrieved, COUNT(DISTINCT l_linenumber) AS landed FROM lineitem GROUP BY 1)
       SELECT run, expected, retrieved, landed, expected IS NOT DISTINCT FROM retrieved AND expected IS NOT DISTINCT FROM landed AS is_reconciled
       FROM e FULL OUTER JOIN r USING (run)""",
)
def reconcile_counts(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_orderkey").alias("run"), "l_linenumber")
    count = F.count(F.lit(1)).alias("n")
    return quality.reconcile_counts(
        "run",
        expected=t.orders.groupBy(F.col("o_orderkey").alias("run")).agg(count),
        retrieved=lines.groupBy("run").agg(count),
        landed=lines.distinct().groupBy("run").agg(count),
    )


@query(
    "prior_success",
    """SELECT ingestion_run_id, resource_key, status, LAST_VALUE(CASE WHEN status = 'COMPLETED' THEN ingestion_run_id END IGNORE NULLS) OVER (
         PARTITION BY resource_key ORDER BY started_at, ingestion_run_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_successful_run_id FROM runs""",
    ["runs"],
)
def prior_success(t: Tables) -> DataFrame:
    found = history.prior_success(
        t.runs, ["resource_key"], ["started_at", "ingestion_run_id"], "ingestion_run_id", F.col("status") == "COMPLETED"
    )
    return found.select("ingestion_run_id", "resource_key", "status", "prior_successful_run_id")


REQUESTS = """
    SELECT event_id, CASE WHEN event_type <> 'error' THEN 200 WHEN value < 20 THEN 429 WHEN value < 35 THEN 503 WHEN value < 42 THEN 501 WHEN value < 50 THEN 520 WHEN value < 80 THEN 401 WHEN value < 120 THEN 403 ELSE 422 END AS status_code,
           CAST(1 + user_id % 3 AS INT) AS attempt FROM {events}"""


@query(
    "retry_class",
    f"""WITH q AS ({REQUESTS.replace("{events}", "events")})
        SELECT event_id, status_code, attempt,
          CASE WHEN status_code BETWEEN 200 AND 299 THEN 'SUCCESS' WHEN (status_code = 429 OR status_code BETWEEN 500 AND 599) THEN 'RETRYABLE' ELSE 'REVIEW' END AS retry_class,
          CASE WHEN (status_code = 429 OR status_code BETWEEN 500 AND 599) AND attempt < 3 THEN CAST(pow(2, attempt - 1) AS BIGINT) END AS delay_seconds FROM q""",
)
def retry_class(t: Tables) -> DataFrame:
    requests = t.spark.sql(REQUESTS, events=t.events)
    return requests.withColumns(
        {
            "retry_class": quality.retry_class(F.col("status_code")),
            "delay_seconds": quality.retry_delay(F.col("status_code"), F.col("attempt")),
        }
    )


# --- change detection -------------------------------------------------------------------------

SCHEMA_DIFF_SQL = """
    linked AS (SELECT *, LAG(schema_snapshot_id) OVER (PARTITION BY resource_key ORDER BY retrieved_at, schema_snapshot_id) AS prior_id FROM schema_history),
    pairs AS (SELECT resource_key, schema_snapshot_id, prior_id FROM linked WHERE prior_id IS NOT NULL),
    n AS (SELECT p.*, f.* EXCLUDE (schema_snapshot_id) FROM pairs p JOIN schema_fields f ON f.schema_snapshot_id = p.schema_snapshot_id),
    o AS (SELECT p.*, f.* EXCLUDE (schema_snapshot_id) FROM pairs p JOIN schema_fields f ON f.schema_snapshot_id = p.prior_id),
    j AS (SELECT COALESCE(n.resource_key, o.resource_key) AS resource_key, COALESCE(n.prior_id, o.prior_id) AS prior_schema_snapshot_id,
            COALESCE(n.schema_snapshot_id, o.schema_snapshot_id) AS new_schema_snapshot_id, COALESCE(n.field_name, o.field_name) AS field_name,
            n.field_name AS has_new, o.field_name AS has_old, n.data_type AS t1, o.data_type AS t0, n.domain AS d1, o.domain AS d0,
            n.description AS x1, o.description AS x0, n.position AS p1, o.position AS p0
          FROM n FULL OUTER JOIN o ON n.schema_snapshot_id = o.schema_snapshot_id AND n.field_name = o.field_name),
    changes AS (
      SELECT resource_key, prior_schema_snapshot_id, new_schema_snapshot_id, field_name, unnest(list_filter([
        CASE WHEN has_old IS NULL THEN 'FIELD_ADDED' END, CASE WHEN has_new IS NULL THEN 'FIELD_REMOVED' END,
        CASE WHEN t1 <> t0 THEN 'TYPE_CHANGED' END, CASE WHEN d1 <> d0 THEN 'DOMAIN_CHANGED' END,
        CASE WHEN x1 <> x0 THEN 'DESCRIPTION_CHANGED' END, CASE WHEN p1 <> p0 THEN 'ORDER_CHANGED' END], lambda v: v IS NOT NULL)) AS change_type FROM j)"""


def schema_changes(t: Tables) -> DataFrame:
    return change.schema_diff(t.schema_history, t.schema_fields)


@query("schema_diff", f"WITH {SCHEMA_DIFF_SQL} SELECT * FROM changes", ["schema_history", "schema_fields"])
def schema_diff(t: Tables) -> DataFrame:
    return schema_changes(t)


@query(
    "classify_change",
    f"""WITH {SCHEMA_DIFF_SQL}, c AS (SELECT *, CASE WHEN change_type IN ('FIELD_ADDED', 'ORDER_CHANGED') THEN 'COMPATIBLE'
            WHEN field_name = 'field_3' THEN 'IGNORED_WITH_JUSTIFICATION'
            WHEN change_type IN ('FIELD_REMOVED', 'TYPE_CHANGED') THEN 'BREAKING' ELSE 'REVIEW_REQUIRED' END AS compatibility_outcome FROM changes)
        SELECT resource_key, compatibility_outcome, COUNT(*) AS n FROM c GROUP BY 1, 2""",
    ["schema_history", "schema_fields"],
)
def classify_change(t: Tables) -> DataFrame:
    note = F.when(F.col("field_name") == "field_3", "field 3 is not used")
    judged = schema_changes(t).withColumn("compatibility_outcome", change.classify_change(F.col("change_type"), note))
    return judged.groupBy("resource_key", "compatibility_outcome").agg(F.count(F.lit(1)).alias("n"))


@query(
    "document_diff",
    """WITH d AS (SELECT *, LAG(content_sha256) OVER w AS before, LAG(source_document_snapshot_id) OVER w AS prev_id FROM document_snapshots
         WINDOW w AS (PARTITION BY resource_key, document_type ORDER BY retrieved_at, source_document_snapshot_id))
       SELECT source_document_snapshot_id, resource_key, document_type, prev_id AS prev_source_document_snapshot_id,
              prev_id IS NOT NULL AND content_sha256 IS DISTINCT FROM before AS is_material_change FROM d""",
    ["document_snapshots"],
)
def document_diff(t: Tables) -> DataFrame:
    return history.document_diff(t.document_snapshots).select(
        "source_document_snapshot_id", "resource_key", "document_type", "prev_source_document_snapshot_id", "is_material_change"
    )


@query(
    "snapshot_diff",
    """WITH o AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
       n AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
       SELECT COALESCE(o.o_custkey, n.o_custkey) AS o_custkey, sha256(o.o_orderstatus) AS old_value, sha256(n.o_orderstatus) AS new_value,
         CASE WHEN o.o_custkey IS NULL THEN 'INSERTED' WHEN n.o_custkey IS NULL THEN 'DELETED' WHEN o.o_orderstatus = n.o_orderstatus THEN 'SAME' ELSE 'CHANGED' END AS change
       FROM o FULL OUTER JOIN n ON o.o_custkey = n.o_custkey""",
)
def snapshot_diff(t: Tables) -> DataFrame:
    hashed = t.orders.withColumn("row_hash", F.sha2("o_orderstatus", 256))

    def newest(rows: DataFrame) -> DataFrame:
        return history.latest_per_key(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"])

    old = newest(hashed.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")))
    new = newest(hashed.filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")))
    return change.snapshot_diff(old, new, ["o_custkey"], "row_hash")


@query(
    "incremental_since",
    """WITH c AS (SELECT user_id, MAX(ts) AS seen FROM events WHERE event_type = 'view' GROUP BY 1)
       SELECT event_id, e.user_id, ts FROM events e LEFT JOIN c ON c.user_id = e.user_id WHERE seen IS NULL OR ts > seen""",
)
def incremental_since(t: Tables) -> DataFrame:
    marks = t.events.filter("event_type = 'view'").select("user_id", F.col("ts").alias("seen_at"))
    return change.changed_since(t.events, marks, "user_id", "ts", "seen_at").select("event_id", "user_id", "ts")


@query("advance_cursors", "SELECT user_id, MAX(ts) AS high_water_mark, COUNT(*) AS new_rows FROM events GROUP BY 1")
def advance_cursors(t: Tables) -> DataFrame:
    return change.advance_cursors(t.events, "user_id", "ts")


# --- time series and operations ---------------------------------------------------------------


@query(
    "volume_outliers",
    """WITH v AS (SELECT l_suppkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS period, COUNT(*) AS volume FROM lineitem GROUP BY 1, 2)
       SELECT l_suppkey, period, volume, avg(volume) OVER w AS mean_volume,
              COALESCE(stddev_samp(volume) OVER w > 0 AND abs(volume - avg(volume) OVER w) > 2.5 * stddev_samp(volume) OVER w, FALSE) AS is_outlier
       FROM v WINDOW w AS (PARTITION BY l_suppkey)""",
)
def volume_outliers(t: Tables) -> DataFrame:
    months = t.lineitem.select("l_suppkey", F.date_trunc("month", "l_shipdate").cast("date").alias("period"))
    return quality.volume_outliers(months, ["l_suppkey"], "period", sigmas=2.5)


@query(
    "temporal_gaps",
    """WITH p AS (SELECT DISTINCT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS period FROM orders),
       l AS (SELECT *, LAG(period) OVER (PARTITION BY o_custkey ORDER BY period) AS before FROM p)
       SELECT o_custkey, CAST(unnest(generate_series(before + INTERVAL 1 MONTH, period - INTERVAL 1 MONTH, INTERVAL 1 MONTH)) AS DATE) AS missing_period
       FROM l WHERE before IS NOT NULL AND before + INTERVAL 1 MONTH < period""",
)
def temporal_gaps(t: Tables) -> DataFrame:
    months = t.orders.select("o_custkey", F.date_trunc("month", "o_orderdate").cast("date").alias("period"))
    return quality.temporal_gaps(months, ["o_custkey"], "period", "month")


@query(
    "temporal_window",
    """WITH p AS (SELECT event_type, CAST(ts AS DATE) AS period, SUM(CAST(value AS DECIMAL(18,2))) AS total FROM events GROUP BY 1, 2)
       SELECT event_type, period, CAST(total AS DOUBLE) AS total, CAST(LAG(total) OVER (PARTITION BY event_type ORDER BY period) AS DOUBLE) AS previous_total,
         CAST(SUM(total) OVER (PARTITION BY event_type ORDER BY period RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS DOUBLE) AS trailing_total FROM p""",
)
def temporal_window(t: Tables) -> DataFrame:
    periods = quality.align_periods(
        t.events, ["event_type"], F.col("ts").cast("date"), F.col("value").cast("decimal(18,2)"), 7
    )
    return periods.withColumns({c: F.col(c).cast("double") for c in ("total", "previous_total", "trailing_total")})


@query(
    "freshness",
    """WITH s AS (SELECT user_id, CASE WHEN user_id % 3 = 0 THEN 'weather' WHEN user_id % 3 = 1 THEN 'annual_final' ELSE 'irregular' END AS cadence, MAX(ts) AS last_at FROM events GROUP BY 1, 2),
       a AS (SELECT *, datediff('second', last_at, TIMESTAMP '2024-02-10') // 3600 AS age_hours FROM s)
       SELECT user_id, cadence, last_at, age_hours, CASE WHEN cadence = 'irregular' THEN 'UNKNOWN' WHEN age_hours > CASE cadence WHEN 'weather' THEN 24 ELSE 720 END THEN 'STALE' ELSE 'FRESH' END AS freshness FROM a""",
)
def freshness(t: Tables) -> DataFrame:
    kind = F.when(F.col("user_id") % 3 == 0, "weather").when(F.col("user_id") % 3 == 1, "annual_final").otherwise("irregular")
    sources = t.events.groupBy("user_id", kind.alias("cadence")).agg(F.max("ts").alias("last_at"))
    return quality.freshness(sources, "last_at", "cadence", F.lit("2024-02-10").cast("timestamp_ntz"), quality.FRESHNESS_HOURS)


@query(
    "observed_cadence",
    """WITH s AS (SELECT *, LAG(content_sha256) OVER w AS before, LAG(source_document_snapshot_id) OVER w AS prev_id FROM document_snapshots
         WINDOW w AS (PARTITION BY resource_key ORDER BY retrieved_at, source_document_snapshot_id)),
       c AS (SELECT * FROM s WHERE prev_id IS NULL OR content_sha256 IS DISTINCT FROM before),
       g AS (SELECT resource_key, datediff('microsecond', LAG(retrieved_at) OVER (PARTITION BY resource_key ORDER BY retrieved_at, source_document_snapshot_id), retrieved_at) // 3600000000 AS gap_hours FROM c)
       SELECT resource_key, COUNT(*) AS n_gaps, CAST(quantile_disc(gap_hours, 0.5) AS BIGINT) AS typical_gap_hours FROM g WHERE gap_hours IS NOT NULL GROUP BY 1""",
    ["document_snapshots"],
)
def observed_cadence(t: Tables) -> DataFrame:
    return history.observed_cadence(
        t.document_snapshots, "resource_key", "retrieved_at", "source_document_snapshot_id", "content_sha256"
    )


@query(
    "ops_status",
    """SELECT resource_key, arg_max(status, (started_at, ingestion_run_id)) AS latest_status, COUNT(*) FILTER (status = 'FAILED') AS n_failed,
         COUNT(*) FILTER (status = 'PARTIAL') AS n_partial, COUNT(*) FILTER (status = 'BLOCKED_REVIEW') AS n_blocked,
         MAX(started_at) FILTER (status = 'COMPLETED') AS last_success_at,
         COALESCE(datediff('second', MAX(started_at) FILTER (status = 'COMPLETED'), TIMESTAMP '2024-01-31') // 3600 > 48, TRUE) AS is_stale FROM runs GROUP BY 1""",
    ["runs"],
)
def ops_status(t: Tables) -> DataFrame:
    return quality.ops_status(
        t.runs, "resource_key", "ingestion_run_id", "status", "started_at", F.lit("2024-01-31").cast("timestamp_ntz"), 48
    )


@query(
    "retention_due",
    """SELECT o_orderkey AS artifact_id, o_orderdate AS created_at FROM orders WHERE o_orderdate < TIMESTAMP '2004-01-01' - INTERVAL 7 YEAR
         AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'O')""",
)
def retention_due(t: Tables) -> DataFrame:
    artifacts = t.orders.select(F.col("o_orderkey").alias("artifact_id"), F.col("o_orderdate").alias("created_at"))
    held = t.lineitem.filter("l_returnflag = 'R' AND l_linestatus = 'O'").select(F.col("l_orderkey").alias("artifact_id"))
    return quality.retention_due(artifacts, held, "artifact_id", "created_at", F.lit("2004-01-01").cast("timestamp_ntz"))


# --- value-aware aggregation ------------------------------------------------------------------

MEASURED = """
    SELECT l_suppkey, l_returnflag, CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'SUPPRESSED' WHEN l_discount = 0.03 THEN 'NOT_REPORTED'
             WHEN l_discount = 0.05 THEN 'UNKNOWN' WHEN l_discount = 0.0 THEN 'ZERO' ELSE 'VALUE' END AS state,
           CASE WHEN l_discount = 0.0 THEN 0 ELSE CAST(ROUND(l_extendedprice * 100) AS BIGINT) END AS cents, CAST(l_quantity AS BIGINT) AS area
    FROM {lineitem}"""


@query(
    "conform_aggregate",
    f"""WITH m AS ({MEASURED.replace("{lineitem}", "lineitem")}),
        a AS (SELECT l_suppkey, l_returnflag, COUNT(*) FILTER (state = 'VALUE') AS n_value, COUNT(*) FILTER (state = 'ZERO') AS n_zero,
            COUNT(*) FILTER (state = 'UNKNOWN') AS n_unknown, COUNT(*) FILTER (state = 'SUPPRESSED') AS n_suppressed, COUNT(*) FILTER (state = 'NOT_REPORTED') AS n_not_reported,
            SUM(cents) FILTER (state IN ('VALUE', 'ZERO')) AS s, SUM(area) FILTER (state IN ('VALUE', 'ZERO')) AS w,
            SUM(cents * area) FILTER (state IN ('VALUE', 'ZERO')) AS sw FROM m GROUP BY 1, 2)
        SELECT l_suppkey, l_returnflag, k.method AS aggregation_method, n_value, n_zero, n_unknown, n_suppressed, n_not_reported,
          CASE k.method WHEN 'SUM' THEN CAST(s AS DOUBLE) WHEN 'MEAN' THEN s / NULLIF(n_value + n_zero, 0) WHEN 'RATE' THEN s / NULLIF(w, 0) ELSE sw / NULLIF(w, 0) END AS measure
        FROM a, (SELECT unnest(['SUM', 'MEAN', 'RATE', 'AREA_WEIGHTED_MEAN']) AS method) k""",
)
def conform_aggregate(t: Tables) -> DataFrame:
    rows = t.spark.sql(MEASURED, lineitem=t.lineitem)
    methods = ("SUM", "MEAN", "RATE", "AREA_WEIGHTED_MEAN")
    return quality.conform_aggregate(rows, ["l_suppkey", "l_returnflag"], "cents", "state", methods, "area").drop("n_null", "n_missing")


@query(
    "feature_snapshot",
    """SELECT l_suppkey, COUNT(*) AS input_rows, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity,
         CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents,
         COUNT(DISTINCT o_custkey) AS input_versions, MIN(o_custkey) AS first_version, MAX(o_custkey) AS last_version,
         'supplier-v1' AS definition_version, '2001-12-31' AS as_of, 'synthetic' AS caveat
       FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1""",
)
def feature_snapshot(t: Tables) -> DataFrame:
    lines = t.lineitem.select(
        "l_suppkey", "l_orderkey", F.col("l_quantity").cast("bigint").alias("q"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("c"),
    )
    facts = lines.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return quality.feature_snapshot(
        facts, ["l_suppkey"], "o_custkey", {"quantity": "q", "cents": "c"}, "supplier-v1", "2001-12-31", "synthetic"
    )


PROFILED = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")


@query(
    "profile_sample",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, COUNT(*) AS row_count, COUNT(*) FILTER ({c} IS NULL) AS null_count, COUNT(DISTINCT {c}) AS distinct_count,
            CAST(MIN({c}) AS STRING) AS min_value, CAST(MAX({c}) AS STRING) AS max_value FROM orders"""
        for c in PROFILED
    ),
)
def profile_sample(t: Tables) -> DataFrame:
    return quality.profile_sample(t.orders, PROFILED, exact=True)
