"""Queries: quality results per run and schema change events, recorded in ledgers and read from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.functions.values import mark_value_states
from attestry.operators import discovery, events, gate, history, lineage, rules, vintages
from attestry.operators import profiles as sketches
from attestry.plans.registry import Tables, query
from attestry.plans.review import FACTS_SQL, FACTS_USES, assessments, profiles
from attestry.session import cut_lineage, kept, scratch_path
from attestry.sources import files, ledger, paged

RULES = [
    {"rule_id": "keys_not_null", "kind": "not_null", "severity": "BLOCKING", "columns": ["l_partkey", "l_suppkey"]},
    {"rule_id": "returnflag_domain", "kind": "domain", "severity": "BLOCKING", "columns": ["l_returnflag"], "allowed": ["A", "R"]},
    {"rule_id": "quantity_range", "kind": "range", "severity": "BLOCKING", "columns": ["l_quantity"], "low": 1, "high": 49},
    {"rule_id": "flag_semantics", "kind": "semantic", "severity": "WARNING", "must_hold": "NOT (l_returnflag = 'N' AND l_linestatus = 'F')"},
    {"rule_id": "part_unique", "kind": "unique", "severity": "BLOCKING", "columns": ["l_partkey", "l_linenumber"]},
    {"rule_id": "row_count", "kind": "row_count", "severity": "BLOCKING", "low": 100, "high": 6000},
    {"rule_id": "freshness", "kind": "freshness", "severity": "WARNING", "columns": ["l_shipdate"], "as_of": "2001-12-01 00:00:00", "max_hours": 720},
    {"rule_id": "supplier_volume", "kind": "volume", "severity": "WARNING", "columns": ["l_suppkey"], "at": "l_shipdate", "unit": "month"},
    {"rule_id": "supplier_continuity", "kind": "continuity", "severity": "WARNING", "columns": ["l_suppkey"], "at": "l_shipdate", "unit": "month"},
]

RESULTS_SQL = """
    x AS (SELECT *, CAST(l_orderkey % 10 AS VARCHAR) AS run FROM lineitem),
    runs AS (SELECT CAST(unnest(range(11)) AS VARCHAR) AS run),
    counted AS (SELECT run, COUNT(*) AS n, COUNT(*) FILTER (l_partkey IS NULL OR l_suppkey IS NULL) AS r1, COUNT(*) FILTER (l_returnflag NOT IN ('A', 'R')) AS r2,
        COUNT(*) FILTER (NOT (l_quantity BETWEEN 1 AND 49)) AS r3, COUNT(*) FILTER (l_returnflag = 'N' AND l_linestatus = 'F') AS r4,
        COUNT(*) - COUNT(DISTINCT (l_partkey, l_linenumber)) AS r5, MAX(l_shipdate) AS newest FROM x GROUP BY 1),
    cells AS (SELECT run, l_suppkey, date_trunc('month', l_shipdate) AS period, COUNT(*) AS n FROM x GROUP BY 1, 2, 3),
    series AS (SELECT run, n, stddev_samp(n) OVER w AS sd, avg(n) OVER w AS m, date_diff('month', lag(period) OVER (w ORDER BY period), period) - 1 AS missing
        FROM cells WINDOW w AS (PARTITION BY run, l_suppkey)),
    judged AS (SELECT run, COUNT(*) FILTER (sd > 0 AND abs(n - m) > 3.5 * sd) AS r8, COALESCE(SUM(missing), 0) AS r9 FROM series GROUP BY 1),
    every AS (SELECT runs.run, COALESCE(n, 0) AS n, COALESCE(r1, 0) AS r1, COALESCE(r2, 0) AS r2, COALESCE(r3, 0) AS r3, COALESCE(r4, 0) AS r4, COALESCE(r5, 0) AS r5,
        newest, COALESCE(r8, 0) AS r8, COALESCE(r9, 0) AS r9 FROM runs LEFT JOIN counted USING (run) LEFT JOIN judged USING (run)),
    results AS (SELECT run AS ingestion_run_id, n, unnest([
        {'id': 'keys_not_null', 's': 'BLOCKING', 'x': '{"columns":["l_partkey","l_suppkey"],"kind":"not_null"}', 'o': r1},
        {'id': 'returnflag_domain', 's': 'BLOCKING', 'x': '{"allowed":["A","R"],"columns":["l_returnflag"],"kind":"domain"}', 'o': r2},
        {'id': 'quantity_range', 's': 'BLOCKING', 'x': '{"columns":["l_quantity"],"high":49,"kind":"range","low":1}', 'o': r3},
        {'id': 'flag_semantics', 's': 'WARNING', 'x': '{"kind":"semantic","must_hold":"NOT (l_returnflag = ''N'' AND l_linestatus = ''F'')"}', 'o': r4},
        {'id': 'part_unique', 's': 'BLOCKING', 'x': '{"columns":["l_partkey","l_linenumber"],"kind":"unique"}', 'o': r5},
        {'id': 'row_count', 's': 'BLOCKING', 'x': '{"high":6000,"kind":"row_count","low":100}', 'o': CASE WHEN n BETWEEN 100 AND 6000 THEN 0 ELSE 1 END},
        {'id': 'freshness', 's': 'WARNING', 'x': '{"as_of":"2001-12-01 00:00:00","columns":["l_shipdate"],"kind":"freshness","max_hours":720}',
            'o': CASE WHEN date_diff('hour', newest, TIMESTAMP '2001-12-01') <= 720 THEN 0 ELSE 1 END},
        {'id': 'supplier_volume', 's': 'WARNING', 'x': '{"at":"l_shipdate","columns":["l_suppkey"],"kind":"volume","unit":"month"}', 'o': r8},
        {'id': 'supplier_continuity', 's': 'WARNING', 'x': '{"at":"l_shipdate","columns":["l_suppkey"],"kind":"continuity","unit":"month"}', 'o': r9}]) AS r FROM every),
    dq AS (SELECT ingestion_run_id, r.id AS rule_id, r.s AS severity, CASE WHEN r.o > 0 THEN 'FAIL' ELSE 'PASS' END AS status, r.x AS expected,
        '{"offences":' || CAST(r.o AS BIGINT) || ',"rows":' || n || '}' AS observed FROM results)"""


def recorded_results(t: Tables) -> DataFrame:
    """Every run judged, recorded, judged and recorded once more as the same batch, and read back."""
    root = scratch_path(t.spark, "quality")
    rows = t.lineitem.withColumn("ingestion_run_id", (F.col("l_orderkey") % 10).cast("string"))
    expected = t.spark.range(11).select(F.col("id").cast("string").alias("ingestion_run_id"))
    results = rules.judge(rows, "ingestion_run_id", rules.rules_of(RULES), F.lit("2002-01-01").cast("timestamp"), expected)
    for _ in range(2):
        rules.record(results, root, "2002-01-01")
    return rules.recorded(t.spark, root)


@query("dq_results_by_run", f"WITH {RESULTS_SQL} SELECT * FROM dq")
def dq_results_by_run(t: Tables) -> DataFrame:
    return recorded_results(t).select(
        "ingestion_run_id", "rule_id", "severity", "status", F.to_json("expected_value").alias("expected"), F.to_json("observed_value").alias("observed")
    )


@query(
    "quality_summary_by_run",
    f"""WITH {RESULTS_SQL} SELECT ingestion_run_id, severity, COUNT(*) FILTER (status = 'PASS') AS n_pass, COUNT(*) FILTER (status = 'FAIL') AS n_fail
        FROM dq GROUP BY 1, 2""",
)
def quality_summary_by_run(t: Tables) -> DataFrame:
    return rules.summary(recorded_results(t))


# --- schema change events ---------------------------------------------------------------------

EVENTS_SQL = """
    marked AS (SELECT h.*, o.o_orderstatus = 'F' AS approved FROM schema_history h JOIN orders o ON o.o_orderkey = h.schema_snapshot_id),
    linked AS (SELECT *, LAST_VALUE(CASE WHEN approved THEN schema_snapshot_id END IGNORE NULLS) OVER (PARTITION BY resource_key
        ORDER BY retrieved_at, schema_snapshot_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_id FROM marked),
    pairs AS (SELECT resource_key, schema_snapshot_id, prior_id, retrieved_at FROM linked WHERE prior_id IS NOT NULL),
    n AS (SELECT p.*, f.* EXCLUDE (schema_snapshot_id) FROM pairs p JOIN schema_fields f ON f.schema_snapshot_id = p.schema_snapshot_id),
    o AS (SELECT p.*, f.* EXCLUDE (schema_snapshot_id) FROM pairs p JOIN schema_fields f ON f.schema_snapshot_id = p.prior_id),
    j AS (SELECT COALESCE(n.resource_key, o.resource_key) AS resource_key, COALESCE(n.prior_id, o.prior_id) AS prior_schema_snapshot_id,
            COALESCE(n.schema_snapshot_id, o.schema_snapshot_id) AS new_schema_snapshot_id, COALESCE(n.field_name, o.field_name) AS field_name,
            COALESCE(n.retrieved_at, o.retrieved_at) AS detected_at,
            n.field_name AS has_new, o.field_name AS has_old, n.data_type AS t1, o.data_type AS t0, n.domain AS d1, o.domain AS d0,
            n.description AS x1, o.description AS x0, n.position AS p1, o.position AS p0
          FROM n FULL OUTER JOIN o ON n.schema_snapshot_id = o.schema_snapshot_id AND n.field_name = o.field_name),
    changes AS (
      SELECT *, unnest(list_filter([
        CASE WHEN has_old IS NULL THEN 'FIELD_ADDED' END, CASE WHEN has_new IS NULL THEN 'FIELD_REMOVED' END,
        CASE WHEN t1 <> t0 THEN 'TYPE_CHANGED' END, CASE WHEN d1 <> d0 THEN 'DOMAIN_CHANGED' END,
        CASE WHEN x1 <> x0 THEN 'DESCRIPTION_CHANGED' END, CASE WHEN p1 <> p0 THEN 'ORDER_CHANGED' END], lambda v: v IS NOT NULL)) AS change_type FROM j),
    change_events AS (SELECT sha256('{"p0":"' || resource_key || '","p1":"' || prior_schema_snapshot_id || '","p2":"' || new_schema_snapshot_id || '","p3":"' || field_name || '","p4":"' || change_type || '"}') AS schema_change_event_id,
        resource_key, prior_schema_snapshot_id, new_schema_snapshot_id, field_name, change_type, detected_at,
        CASE WHEN has_old IS NOT NULL THEN '{"data_type":"' || t0 || '","domain":"' || d0 || '","description":"' || x0 || '","position":' || p0 || '}' END AS prior_definition,
        CASE WHEN has_new IS NOT NULL THEN '{"data_type":"' || t1 || '","domain":"' || d1 || '","description":"' || x1 || '","position":' || p1 || '}' END AS new_definition,
        CASE WHEN change_type IN ('FIELD_ADDED', 'ORDER_CHANGED') THEN 'COMPATIBLE' WHEN field_name = 'field_3' THEN 'IGNORED_WITH_JUSTIFICATION'
            WHEN change_type IN ('FIELD_REMOVED', 'TYPE_CHANGED') THEN 'BREAKING' ELSE 'REVIEW_REQUIRED' END AS compatibility_outcome,
        CASE WHEN field_name = 'field_3' THEN 'field 3 is not used' END AS justification FROM changes),
    -- A decision for each resource names one of its blocking events; those of resources with an odd key approve nothing.
    naming AS (SELECT resource_key, 'd' || resource_key AS manual_review_decision_id, MIN(schema_change_event_id) AS named, resource_key % 2 = 0 AS approves,
        CASE WHEN resource_key % 4 = 0 THEN TIMESTAMP '2030-01-01' ELSE TIMESTAMP '1990-01-01' END AS decided_at
        FROM change_events WHERE compatibility_outcome IN ('BREAKING', 'REVIEW_REQUIRED') GROUP BY resource_key),
    states AS (SELECT e.*, CASE WHEN compatibility_outcome IN ('COMPATIBLE', 'IGNORED_WITH_JUSTIFICATION') THEN 'NONE_NEEDED' WHEN d.named IS NULL THEN 'OPEN' ELSE 'RESOLVED' END AS resolution,
        d.manual_review_decision_id AS resolved_by FROM change_events e LEFT JOIN naming d ON d.named = e.schema_change_event_id AND d.approves AND d.decided_at >= e.detected_at)"""
EVENT_TABLES = ["schema_history", "schema_fields"]


def recorded_events(t: Tables) -> DataFrame:
    """Events against the last approved schema, appended to their ledger twice as one batch, and read back."""
    root = scratch_path(t.spark, "changes")
    approved = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("schema_snapshot_id"))
    pairs = kept(events.baselines(t.schema_history, approved, t.schema_fields), "baselines")
    found = events.change_events(pairs, None, F.when(F.col("field_name") == "field_3", "field 3 is not used"))
    for _ in range(2):
        ledger.append_ledger(root, "first", {"schema_change_events": found})
    return ledger.read_ledger(t.spark, root, "schema_change_events").drop("batch_id")


def naming_decisions(rows: DataFrame) -> DataFrame:
    blocking = rows.filter(~F.col("compatibility_outcome").isin(*events.HARMLESS))
    first = blocking.groupBy("resource_key").agg(F.min("schema_change_event_id").alias("named"))
    late = F.when(F.col("resource_key") % 4 == 0, "2030-01-01").otherwise("1990-01-01").cast("timestamp_ntz")
    return first.select(
        F.concat(F.lit("d"), F.col("resource_key").cast("string")).alias("manual_review_decision_id"), "resource_key",
        F.when(F.col("resource_key") % 2 == 0, "APPROVED").otherwise("DEFERRED").alias("decision"),
        F.array("named").alias("resolved_events"), late.alias("decided_at"),
    )


@query(
    "schema_change_events",
    f"""WITH {EVENTS_SQL} SELECT schema_change_event_id, resource_key, prior_schema_snapshot_id, new_schema_snapshot_id, field_name, change_type,
        prior_definition, new_definition, compatibility_outcome, justification FROM change_events""",
    EVENT_TABLES,
)
def schema_change_events(t: Tables) -> DataFrame:
    return recorded_events(t).drop("detected_at")


@query("change_event_states", f"WITH {EVENTS_SQL} SELECT schema_change_event_id, resource_key, resolution, resolved_by FROM states", EVENT_TABLES)
def change_event_states(t: Tables) -> DataFrame:
    rows = recorded_events(t)
    return events.event_states(rows, naming_decisions(rows)).select("schema_change_event_id", "resource_key", "resolution", "resolved_by")


@query(
    "promotion_by_ledgers",
    f"""WITH {EVENTS_SQL}, {RESULTS_SQL},
        per AS (SELECT ingestion_run_id, COUNT(*) FILTER (status = 'FAIL' AND severity = 'BLOCKING') AS n_blocking_failures,
            COUNT(*) FILTER (status = 'FAIL' AND severity <> 'BLOCKING') AS n_warnings FROM dq GROUP BY 1),
        m AS (SELECT c_custkey AS resource_key, CAST(c_custkey % 12 AS VARCHAR) AS ingestion_run_id, COALESCE(n_blocking_failures, 0) AS n_blocking_failures,
            COALESCE(n_warnings, 0) AS n_warnings, EXISTS (SELECT 1 FROM states s WHERE s.resource_key = c_custkey AND s.resolution = 'OPEN') AS has_material_change
            FROM customer LEFT JOIN per ON per.ingestion_run_id = CAST(c_custkey % 12 AS VARCHAR))
        SELECT *, CASE WHEN n_blocking_failures > 0 OR has_material_change THEN 'BLOCKED_REVIEW' ELSE 'PROMOTABLE' END AS promotion_status FROM m""",
    EVENT_TABLES,
)
def promotion_by_ledgers(t: Tables) -> DataFrame:
    """The verdict on every resource's run from recorded results and open events; one approval opens what it names, nothing more."""
    found = recorded_events(t)
    runs = t.customer.select(F.col("c_custkey").alias("resource_key"), (F.col("c_custkey") % 12).cast("string").alias("ingestion_run_id"))
    return gate.promotion_gate(runs, recorded_results(t), events.open_events(found, naming_decisions(found)))


@query(
    "registered_prerequisites",
    f"""WITH {FACTS_SQL}, n AS (SELECT COALESCE(f.resource_key, r.resource_key) AS resource_key, COALESCE(document_count, 0) AS document_count, COALESCE(schema_count, 0) AS schema_count,
          COALESCE(open_profile_count, 0) AS open_profile_count, COALESCE(blocking_count, 0) AS blocking_count, assessment_status, CAST(r.resource_key IS NOT NULL AS BIGINT) AS resource_count
          FROM facts f FULL OUTER JOIN (SELECT resource_key FROM resources WHERE is_active) r ON r.resource_key = f.resource_key)
        SELECT resource_key, resource_count, COALESCE(resource_count = 1 AND document_count > 0 AND schema_count > 0 AND open_profile_count = 1
          AND assessment_status = 'PENDING_REVIEW' AND blocking_count = 0, FALSE) AS ready FROM n""",
    ["resources", *FACTS_USES],
)
def registered_prerequisites(t: Tables) -> DataFrame:
    """Approval prerequisites that ask for the resource's entry in the register, too."""
    blocking = gate.unresolved_changes(t.changes, t.decisions)
    open_profiles = history.open_rows(profiles(t), "effective_to")
    rows = gate.evidence_facts(t.document_snapshots, t.schema_snapshots, open_profiles, assessments(t), blocking, t.resources)
    return rows.select("resource_key", "resource_count", gate.prerequisites_met(registered=True).alias("ready"))


# --- profiles, vintages, lineage, pages -------------------------------------------------------

PROFILED = ("o_totalprice", "o_custkey", "o_orderpriority")


@query(
    "merged_profiles",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, COUNT(*) AS row_count, COUNT(*) FILTER ({c} IS NULL) AS null_count, COUNT(DISTINCT {c}) AS exact_distinct,
            TRUE AS distinct_within_5_percent, {'TRUE' if c != 'o_orderpriority' else 'NULL::BOOLEAN'} AS median_within_2_percent_of_ranks,
            MIN(CAST({c if c != 'o_orderpriority' else 'NULL'} AS DOUBLE)) AS min_number, MAX(CAST({c if c != 'o_orderpriority' else 'NULL'} AS DOUBLE)) AS max_number FROM orders"""
        for c in PROFILED
    ),
)
def merged_profiles(t: Tables) -> DataFrame:
    """Profiles per year as the versions, merged from their sketches; estimates are held against exact values."""
    orders = t.orders.withColumn("version", F.year("o_orderdate"))
    root = scratch_path(t.spark, "profiles")
    ledger.append_ledger(root, "first", {"column_profiles": sketches.profile_versions(orders, "version", PROFILED)})
    merged = sketches.read_profiles(sketches.merge_profiles(ledger.read_ledger(t.spark, root, "column_profiles")), (0.5,))
    exact = sketches.exact_distincts(orders, PROFILED).withColumnRenamed("distinct_count", "exact_distinct")
    median = F.get("quantiles", F.lit(0))
    joined = merged.withColumn("__m", median).join(exact, "column_name")
    ranks = orders.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in PROFILED[:2]])))
    below = ranks.join(joined.select("column_name", "__m"), "column_name").groupBy("column_name").agg(
        (F.count_if(F.col("v") < F.col("__m")) / F.count(F.lit(1))).alias("under"), (F.count_if(F.col("v") <= F.col("__m")) / F.count(F.lit(1))).alias("upto")
    )
    near = F.abs(F.col("distinct_count") - F.col("exact_distinct")) <= F.col("exact_distinct") * 0.05
    return joined.join(below, "column_name", "left").select(
        "column_name", "row_count", "null_count", "exact_distinct", near.alias("distinct_within_5_percent"),
        ((F.col("under") <= 0.52) & (F.col("upto") >= 0.48)).alias("median_within_2_percent_of_ranks"), "min_number", "max_number",
    )


AS_OF = ("1994-01-01", "1996-07-01", "2000-01-01")


@query(
    "feature_vintages",
    f"""WITH r AS (SELECT *, CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS cents, 'v' || l_orderkey % 5 AS version, l_orderkey * 10 + l_linenumber AS tie FROM lineitem),
        k AS (SELECT *, LEAD(l_shipdate) OVER (PARTITION BY l_suppkey, l_partkey ORDER BY l_shipdate, tie) AS until FROM r),
        a AS (SELECT k.*, t.as_of FROM k, (SELECT unnest([{', '.join(f"TIMESTAMP '{d}'" for d in AS_OF)}]) AS as_of) t WHERE l_shipdate <= as_of AND (until IS NULL OR as_of < until)),
        v AS (SELECT as_of, l_suppkey, version, COUNT(*) AS n FROM a GROUP BY 1, 2, 3),
        l AS (SELECT as_of, l_suppkey, string_agg(version || ':' || n, ',' ORDER BY version) AS versions FROM v GROUP BY 1, 2)
        SELECT a.as_of, a.l_suppkey, COUNT(*) AS input_rows, MAX(l_shipdate) AS newest_vintage, CAST(SUM(cents) AS BIGINT) AS cents, MAX(versions) AS versions, 'run-1' AS run_id
        FROM a JOIN l ON l.as_of = a.as_of AND l.l_suppkey = a.l_suppkey GROUP BY 1, 2""",
)
def feature_vintages(t: Tables) -> DataFrame:
    """What was known of each supplier at three times: of every part its newest line then."""
    lines = t.lineitem.select(
        "l_suppkey", "l_partkey", "l_shipdate", F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("c"),
        F.concat(F.lit("v"), (F.col("l_orderkey") % 5).cast("string")).alias("version"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("tie"),
    )
    rows = vintages.snapshots(lines, ["l_suppkey"], ["l_suppkey", "l_partkey"], "l_shipdate", "tie", "version", {"cents": "c"}, "supplier-v1", AS_OF, F.lit("run-1"))
    listed = F.array_join(F.transform("versions", lambda v: F.concat_ws(":", v["version"], v["records"].cast("string"))), ",")
    return rows.select("as_of", "l_suppkey", "input_rows", "newest_vintage", "cents", listed.alias("versions"), "run_id")


UP_SQL = """up AS (SELECT DISTINCT output_object AS root, input_object AS ancestor, 1 AS depth FROM edges
         UNION ALL SELECT u.root, e.input_object, u.depth + 1 FROM up u JOIN edges e ON e.output_object = u.ancestor)"""


@query(
    "trace_from_roots",
    f"WITH RECURSIVE {UP_SQL} SELECT root, ancestor, MIN(depth) AS depth FROM up WHERE root LIKE 'order:%7' GROUP BY 1, 2",
    ["edges"],
)
def trace_from_roots(t: Tables) -> DataFrame:
    """Everything upstream of the assets asked for, and of no other."""
    asked = t.edges.select(F.col("output_object").alias("asset")).filter("asset LIKE 'order:%7'")
    return lineage.trace_lineage(t.edges, asked)


@query("extend_lineage", f"WITH RECURSIVE {UP_SQL} SELECT root, ancestor, MIN(depth) AS depth FROM up GROUP BY 1, 2", ["edges"])
def extend_lineage(t: Tables) -> DataFrame:
    """A reachability table of most edges, extended by the edges of one nation and of some customers."""
    late = F.col("output_object").rlike("^nation:1$|^customer:.*3$")
    old, new = t.edges.filter(~late), t.edges.filter(late)
    reach = cut_lineage(lineage.trace_lineage(old, old.select(F.col("output_object").alias("asset"))))
    return lineage.with_edges(reach, lineage.add_edges(reach, new))


@query(
    "paged_stream",
    """SELECT day(ts) AS page_sequence, event_id, event_type, COUNT(*) OVER (PARTITION BY day(ts)) AS page_rows FROM events""",
)
def paged_stream(t: Tables) -> DataFrame:
    """Events laid out as pages and streamed as they land, with a restart after the first half; each page arrives once."""
    root = scratch_path(t.spark, "page-stream").removeprefix("file:")
    rows = t.events.select(F.dayofmonth("ts").alias("page"), "event_id", "event_type").repartition("page")
    paged.register(t.spark)
    for last, part in enumerate((rows.filter("page <= 15"), rows.filter("page > 15"))):
        part.write.mode("append").partitionBy("page").json(f"{root}/pages")
        if last:
            paged.mark_complete(f"{root}/pages")
        stream = t.spark.readStream.format("paged_stream").option("firstPage", 1).load(f"{root}/pages")
        job = paged.page_records(stream).writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint").option("path", f"{root}/out").trigger(availableNow=True).start()
        job.awaitTermination()
    found = t.spark.read.parquet(f"{root}/out").withColumn("r", F.from_json("record", "event_id bigint, event_type string"))
    return found.select("page_sequence", "r.event_id", "r.event_type", "page_rows")


# --- sources ----------------------------------------------------------------------------------


@query(
    "search_plan_configured",
    """WITH brands AS (SELECT p_brand, list_sort(list(DISTINCT p_type)) AS terms FROM part GROUP BY 1),
        c AS (SELECT r_regionkey, r_name, [p_brand FOR p_brand IN (SELECT list_sort(list(p_brand)) FROM brands) IF CAST(substr(p_brand, 7) AS INT) % 5 <> r_regionkey] AS groups FROM region WHERE r_name <> 'AFRICA'),
        used AS (SELECT r_regionkey, r_name, g.g AS p_brand, g.i AS i FROM (SELECT r_regionkey, r_name, unnest([{'g': g, 'i': i} FOR g, i IN groups]) AS g FROM c) WHERE g.g <> 'Brand#2'),
        listed AS (SELECT r_regionkey, r_name, i, t.i AS j, t.t AS term FROM (SELECT r_regionkey, r_name, i, unnest([{'t': t, 'i': k} FOR t, k IN terms]) AS t FROM used JOIN brands USING (p_brand))
            UNION ALL SELECT r_regionkey, r_name, 2147483647, 1, r_name || ' records' FROM region WHERE r_name <> 'AFRICA'
            UNION ALL SELECT r_regionkey, r_name, 2147483647, 2, 'ticks' FROM region WHERE r_name <> 'AFRICA'),
        p AS (SELECT r_regionkey, r_name, lower(term) AS k, min((i, j)) AS place, arg_max(term, (i, j)) AS term FROM listed GROUP BY 1, 2, 3)
        SELECT ROW_NUMBER() OVER (ORDER BY r_regionkey, place, k) AS request_sequence, r_name AS catalog_id, term FROM p""",
)
def search_plan_configured(t: Tables) -> DataFrame:
    """Requests of a whole configuration document: group terms, then each catalog's own terms."""
    brands = t.part.groupBy("p_brand").agg(F.array_sort(F.collect_set("p_type")).alias("terms"))
    groups = brands.agg(F.array_sort(F.collect_list(F.struct(F.col("p_brand").alias("id"), "terms"))).alias("term_groups"))
    names = F.transform("term_groups", lambda g: g["id"])
    own = F.filter(names, lambda b: F.substring(b, 7, 9).cast("int") % 5 != F.col("r_regionkey"))
    catalog = F.struct(
        F.col("r_name").alias("catalog_id"), (F.col("r_name") != "AFRICA").alias("enabled"), F.lit("https://c.example.org").alias("search_endpoint"),
        F.lit("q").alias("search_parameter"), own.alias("search_term_group_ids"), F.array(F.concat("r_name", F.lit(" records")), F.lit("ticks")).alias("catalog_specific_terms"),
    )
    # The documents of one configuration: its few catalogs in their order.
    each = t.region.withColumn("term_groups", groups.scalar()).select("r_regionkey", "term_groups", catalog.alias("c"))
    parameters = F.create_map(F.lit("rows"), F.lit("100"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("r_regionkey", "c"))), lambda x: x["c"].withField("fixed_query_parameters", parameters))
    config = each.groupBy("term_groups").agg(listed.alias("catalogs")).select(
        F.lit(discovery.SEARCH_SCHEMA_VERSION).alias("$schema_version"),
        F.filter(F.transform("term_groups", lambda g: g["id"]), lambda b: b != "Brand#2").alias("initially_enabled_term_group_ids"), "catalogs", "term_groups",
    )
    return discovery.search_plan(config).select("request_sequence", "catalog_id", "term")


@query(
    "supplied_value_states",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '{"frequency":"withheld"}' WHEN o_orderpriority = '5-LOW' THEN '{"priority":"unknown"}' ELSE '{}' END AS source_value_status FROM orders""",
)
def supplied_value_states(t: Tables) -> DataFrame:
    """Markers that the source supplies win over those found in its fields."""
    supplied = F.when(F.col("o_orderstatus") == "P", F.create_map(F.lit("frequency"), F.lit("withheld")))
    found = F.when(F.col("o_orderpriority") == "5-LOW", "Unknown").otherwise(F.col("o_orderpriority"))
    return t.orders.select("o_orderkey", mark_value_states({"priority": found}, supplied).alias("source_value_status"))


@query(
    "raw_ledger_rows",
    """SELECT CAST(user_id AS STRING) AS data_source_version_id, CAST(event_id AS STRING) AS source_record_id, sha256(replace(props, ' ', '')) AS source_row_hash,
         replace(props, ' ', '') AS payload, 'run-' || event_type AS ingestion_run_id, 'artifact-' || event_type AS artifact_id, 'https://data.example.org/events' AS source_url,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS retrieved_at, '2024-03-01 00:00:00' AS loaded_at, 'load-1' AS raw_load_batch_id, 'load-1' AS batch_id FROM events""",
)
def raw_ledger_rows(t: Tables) -> DataFrame:
    """RAW rows as they lie in their ledger after an append, every column of them."""
    root = scratch_path(t.spark, "raw-rows")
    rows = ledger.raw_rows(
        t.events, "props", version=F.col("user_id").cast("string"), run=F.concat(F.lit("run-"), "event_type"), artifact=F.concat(F.lit("artifact-"), "event_type"),
        source_url=F.lit("https://data.example.org/events?secret=1"), record_id=F.col("event_id").cast("string"), retrieved_at=F.col("ts"),
        loaded_at=F.lit("2024-03-01").cast("timestamp_ntz"), batch_id="load-1",
    )
    ledger.append_ledger(root, "load-1", {"raw": rows})
    times = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("retrieved_at", "loaded_at")}
    return ledger.read_ledger(t.spark, root, "raw").withColumns({"payload": F.to_json("payload"), **times})


@query("direct_geojson", "SELECT n_nationkey, CAST(n_nationkey * 3 - 30 AS DOUBLE) AS min_x, CAST(n_nationkey * 3 - 28 AS DOUBLE) AS max_x, 2 AS n_rings FROM nation")
def direct_geojson(t: Tables) -> DataFrame:
    """Nations as a GeoJSON file of squares with a hole each, read as a direct file."""
    root = scratch_path(t.spark, "geojson")

    def ring(inset: float):
        x = F.col("n_nationkey") * 3 - 30
        corners = [(inset, inset), (2 - inset, inset), (2 - inset, 2 - inset), (inset, 2 - inset), (inset, inset)]
        return F.array(*[F.array((x + a).cast("double"), F.lit(float(b))) for a, b in corners])

    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(ring(0), ring(0.5)).alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct("n_nationkey").alias("properties"), geometry.alias("geometry"))
    # A reference set with one feature per nation is one document.
    t.nation.agg(F.collect_list(feature).alias("features")).select(F.lit("FeatureCollection").alias("type"), "features").write.json(f"{root}/geo")
    rows = files.read_direct_file(t.spark, f"{root}/geo", "geojson")
    return rows.select(
        F.get_json_object("feature", "$.properties.n_nationkey").cast("int").alias("n_nationkey"), "geometry.min_x", "geometry.max_x", F.size("geometry.rings").alias("n_rings")
    )


@query(
    "load_release",
    """SELECT lpad(CAST(n_nationkey AS STRING), 5, '0') AS fips, 'r2' AS release_id, 'r2' AS current_release, 1 AS n_releases, 1 AS n_sources FROM nation WHERE n_nationkey % 2 = 0""",
)
def load_release(t: Tables) -> DataFrame:
    """A release bundle as one gzip document, loaded; loaded again with fewer counties, and read back through the pointer."""
    from attestry.sources import acquire

    root = scratch_path(t.spark, "load")
    for n, part in enumerate((t.nation, t.nation.filter("n_nationkey % 2 = 0"))):
        fips = F.lpad(F.col("n_nationkey").cast("string"), 5, "0")
        properties = F.struct(
            fips.alias("fips"), F.col("n_name").alias("name"), F.lit("ST").alias("state"), F.struct(F.lit(50.0).alias("score")).alias("default"),
            F.lit("linked").alias("human_status"),
        )
        geometry = F.struct(F.lit("Point").alias("type"), F.array(F.lit(1.0), F.lit(2.0)).alias("coordinates"))
        feature = F.struct(F.lit("Feature").alias("type"), fips.alias("id"), properties.alias("properties"), geometry.alias("geometry"))
        source = F.struct(*[F.lit(k).alias(k) for k in ("key", "label", "vintage", "url", "note")])
        document = part.agg(F.collect_list(feature).alias("features")).select(
            F.lit("0.2.0").alias("schema_version"), F.lit("2026-01-01T00:00:00Z").alias("generated_at"), F.lit("s").alias("scope"),
            F.struct(F.lit(1).alias("w")).alias("score_defaults"), F.array(source).alias("sources"), F.struct("features").alias("feature_collection"),
        )
        document.write.option("compression", "gzip").json(f"{root}/bundle{n}")
        digest = files.content_digest(t.spark, f"{root}/bundle{n}").first().sha256
        acquire.load_release(t.spark, f"{root}/bundle{n}", f"{root}/ledger", "r2", digest, "m", "l", part.count())
    back = {name: ledger.read_release(t.spark, f"{root}/ledger", name) for name in ("county_facts", "dataset_release", "source_metadata")}
    counts = [F.lit(back[name].count()).alias(column) for name, column in (("dataset_release", "n_releases"), ("source_metadata", "n_sources"))]
    return back["county_facts"].select("fips", "release_id", F.lit(ledger.current_release(t.spark, f"{root}/ledger")).alias("current_release"), *counts)


@query(
    "transformation_runs",
    """WITH v AS (SELECT list_sort(list(DISTINCT CAST(data_source_version_id AS STRING))) AS versions FROM source_versions WHERE status IN ('APPROVED', 'CONDITIONAL') AND retired_at IS NULL)
        SELECT sha256('{"p0":"transformation","p1":"conform","p2":"facts","p3":"2024-01-01 00:00:00","p4":"' || array_to_string(versions, ',') || '"}') AS transformation_run_id,
          'conform' AS transformation_name, 'facts' AS target_relation, 'COMPLETED' AS status, len(versions) AS n_versions, sha256(array_to_string(versions, ',')) AS versions_sha256 FROM v""",
    ["source_versions"],
)
def transformation_runs(t: Tables) -> DataFrame:
    """The run that conforms facts from all approved versions, recorded twice as one batch."""
    root = scratch_path(t.spark, "transformations")
    start, end = F.lit("2024-01-01").cast("timestamp_ntz"), F.lit("2024-01-01 01:00:00").cast("timestamp_ntz")
    rows = lineage.transformation_runs("conform", "facts", lineage.dim_source_version(t.source_versions), F.lit("COMPLETED"), start, end)
    for _ in range(2):
        ledger.append_ledger(root, "first", {"transformation_runs": rows})
    back = ledger.read_ledger(t.spark, root, "transformation_runs")
    versions = F.col("input_source_versions")
    return back.select(
        "transformation_run_id", "transformation_name", "target_relation", "status", F.size(versions).cast("bigint").alias("n_versions"),
        F.sha2(F.array_join(versions, ","), 256).alias("versions_sha256"),
    )
