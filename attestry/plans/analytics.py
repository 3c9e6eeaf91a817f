"""Queries: eras, guarded joins, spatial matching, lineage and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.functions.geo import parse_geometry
from attestry.functions.values import tag_era
from attestry.operators import lineage, match
from attestry.plans.evidence import RAW_OUTPUT, RAW_SQL, _raw
from attestry.plans.registry import Tables, query
from attestry.session import scratch_path
from attestry.streaming import arrivals

# Reporting eras of the synthetic orders.
ORDER_ERAS = (("1995-1996", 1995, 1996), ("1997-1999", 1997, 1999), ("2000-current", 2000, None))
ERA_SQL = "CASE WHEN y BETWEEN 1995 AND 1996 THEN '1995-1996' WHEN y BETWEEN 1997 AND 1999 THEN '1997-1999' WHEN y >= 2000 THEN '2000-current' END"
ERAS_SQL = f"eras AS (SELECT *, {ERA_SQL} AS era FROM (SELECT *, EXTRACT(YEAR FROM o_orderdate) AS y FROM orders))"


def era_orders(t: Tables) -> DataFrame:
    return t.orders.withColumn("era", tag_era(F.year("o_orderdate"), ORDER_ERAS))


@query("era_tag", f"WITH {ERAS_SQL} SELECT o_orderkey, era FROM eras")
def era_tag(t: Tables) -> DataFrame:
    return era_orders(t).select("o_orderkey", "era")


@query(
    "era_union",
    f"WITH {ERAS_SQL} SELECT era, o_orderstatus AS data_source_version_id, COUNT(*) AS n, COUNT(*) FILTER (era = '1995-1996') AS n_old_priority FROM eras GROUP BY 1, 2",
)
def era_union(t: Tables) -> DataFrame:
    rows = era_orders(t).withColumnRenamed("o_orderstatus", "data_source_version_id")
    old = rows.filter("era = '1995-1996'").select("era", "data_source_version_id", "o_orderkey", "o_orderpriority")
    rest = [rows.filter(F.col("era") == e).select("era", "data_source_version_id", "o_orderkey") for e in ("1997-1999", "2000-current")]
    return match.era_union([old, *rest]).groupBy("era", "data_source_version_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("o_orderpriority").alias("n_old_priority")
    )


@query(
    "guarded_join",
    f"""WITH {ERAS_SQL}, c AS (SELECT o_custkey, arg_min(era, (o_orderdate, o_orderkey)) AS context_era, COUNT(*) AS context_orders FROM eras GROUP BY 1),
        j AS (SELECT e.o_orderkey, e.era, c.context_era, c.context_orders,
          CASE WHEN e.o_orderpriority = '4-NOT SPECIFIED' THEN 'NO_GEOGRAPHY'
               WHEN e.era <> c.context_era AND NOT (e.era = '2000-current' AND c.context_era = '1997-1999') THEN 'UNDECLARED_CROSS_ERA' END AS refusal
          FROM eras e LEFT JOIN c USING (o_custkey))
        SELECT o_orderkey, refusal, CASE WHEN refusal IS NULL THEN context_era END AS context_era, CASE WHEN refusal IS NULL THEN context_orders END AS context_orders FROM j""",
)
def guarded_join(t: Tables) -> DataFrame:
    orders = era_orders(t)
    context = orders.groupBy("o_custkey").agg(
        F.min_by("era", F.struct("o_orderdate", "o_orderkey")).alias("context_era"), F.count(F.lit(1)).alias("context_orders")
    )
    joined = match.guarded_join(
        orders, context, "o_custkey", F.col("o_orderpriority") != "4-NOT SPECIFIED", "era", "context_era",
        declared=[("2000-current", "1997-1999")],
    )
    return joined.select("o_orderkey", "refusal", "context_era", "context_orders")


# --- spatial ----------------------------------------------------------------------------------


@query(
    "nearest_station",
    """WITH d AS (SELECT point_id, station_id, pow(cos(radians(p.lat)) * cos(radians(p.lon)) - cos(radians(s.lat)) * cos(radians(s.lon)), 2)
            + pow(cos(radians(p.lat)) * sin(radians(p.lon)) - cos(radians(s.lat)) * sin(radians(s.lon)), 2) + pow(sin(radians(p.lat)) - sin(radians(s.lat)), 2) AS gap
          FROM places p, stations s)
       SELECT point_id, arg_min(station_id, (gap, station_id)) AS station_id, CAST(round(asin(least(sqrt(min(gap)) / 2, 1)) * 2 * 6371008.8 / 1000) AS BIGINT) AS distance_km
       FROM d GROUP BY point_id""",
    ["places", "stations"],
)
def nearest_station(t: Tables) -> DataFrame:
    found = match.nearest_station(t.places, t.stations, "point_id", "station_id")
    return found.select("point_id", "station_id", F.round(F.col("distance_m") / 1000).cast("bigint").alias("distance_km"))


def district_areas(t: Tables) -> DataFrame:
    """Districts as diamond polygons in GeoJSON, parsed."""

    def corner(dx: int, dy: int):
        return F.concat(
            F.lit("["), (F.col("cx") + F.col("half") * dx).cast("string"), F.lit(","), (F.col("cy") + F.col("half") * dy).cast("string"), F.lit("]")
        )

    ring = F.array_join(F.array(corner(1, 0), corner(0, 1), corner(-1, 0), corner(0, -1), corner(1, 0)), ",")
    text = F.concat(F.lit('{"type":"Polygon","coordinates":[['), ring, F.lit("]]}"))
    return t.districts.select("area_id", parse_geometry(text).alias("geometry"))


@query(
    "point_in_area",
    "SELECT point_id, area_id FROM places p, districts d WHERE abs(p.lon - d.cx) + abs(p.lat - d.cy) < d.half",
    ["places", "districts"],
)
def point_in_area(t: Tables) -> DataFrame:
    return match.match_contains(t.places, district_areas(t), "geometry").select("point_id", "area_id")


@query(
    "area_intersects",
    """SELECT a.area_id, b.area_id AS other_area_id FROM districts a, districts b WHERE abs(a.cx - b.cx) + abs(a.cy - b.cy) < a.half + b.half""",
    ["districts"],
)
def area_intersects(t: Tables) -> DataFrame:
    areas = district_areas(t)
    return match.match_intersects(areas, areas, "area_id", "area_id")


@query(
    "area_weighted",
    """SELECT n_regionkey, COUNT(*) FILTER (v IS NOT NULL) AS n_sources, COUNT(*) FILTER (v IS NULL) AS n_missing,
         SUM(v * w) / NULLIF(SUM(CASE WHEN v IS NOT NULL THEN w END), 0) AS amount
       FROM (SELECT c_nationkey, CASE WHEN c_acctbal >= 0 THEN CAST(ROUND(c_acctbal * 100) AS BIGINT) END AS v FROM customer)
       JOIN (SELECT n_nationkey, n_regionkey, n_nationkey + 1 AS w FROM nation) ON n_nationkey = c_nationkey GROUP BY 1""",
)
def area_weighted(t: Tables) -> DataFrame:
    values = t.customer.select(
        F.col("c_nationkey").alias("n_nationkey"), F.when(F.col("c_acctbal") >= 0, F.round(F.col("c_acctbal") * 100).cast("bigint")).alias("amount")
    )
    weights = t.nation.select("n_nationkey", "n_regionkey", (F.col("n_nationkey") + 1).alias("weight"))
    return match.match_area_weighted(values, weights, "n_nationkey", "n_regionkey", "amount")


@query("direct_key", "SELECT c_custkey, n_nationkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def direct_key(t: Tables) -> DataFrame:
    return match.match_direct(t.customer.withColumnRenamed("c_nationkey", "n_nationkey"), t.nation, "n_nationkey").select(
        "c_custkey", "n_nationkey", "n_name"
    )


# --- lineage ----------------------------------------------------------------------------------


@query(
    "trace_lineage",
    """WITH RECURSIVE up AS (SELECT DISTINCT output_object AS root, input_object AS ancestor, 1 AS depth FROM edges
         UNION ALL SELECT u.root, e.input_object, u.depth + 1 FROM up u JOIN edges e ON e.output_object = u.ancestor)
       SELECT root, ancestor, MIN(depth) AS depth FROM up GROUP BY 1, 2""",
    ["edges"],
)
def trace_lineage(t: Tables) -> DataFrame:
    """Everything upstream of every asset that has an upstream."""
    edges = t.edges
    return lineage.trace_lineage(edges, edges.select(F.col("output_object").alias("asset")))


EDGE_SQL = "SELECT DISTINCT l_returnflag || l_linestatus AS transformation_run_id, 'supplier:' || l_suppkey AS input_object, 'part:' || l_partkey AS output_object FROM lineitem"


@query(
    "lineage_edges",
    f"""SELECT *, 'AGGREGATE' AS relationship_type, 'SUM' AS aggregation_method,
          sha256('{{"p0":"' || transformation_run_id || '","p1":"' || input_object || '","p2":"' || output_object || '","p3":"AGGREGATE"}}') AS lineage_edge_id FROM ({EDGE_SQL})""",
)
def lineage_edges(t: Tables) -> DataFrame:
    steps = t.lineitem.select(
        F.concat("l_returnflag", "l_linestatus").alias("run"),
        F.concat(F.lit("supplier:"), F.col("l_suppkey").cast("string")).alias("input"),
        F.concat(F.lit("part:"), F.col("l_partkey").cast("string")).alias("output"),
    )
    return lineage.lineage_edges_for(F.col("run"), steps, "input", "output", "AGGREGATE", {"aggregation_method": "SUM"})


@query(
    "reconcile_edges",
    """WITH d AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem WHERE l_returnflag <> 'N'), o AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem WHERE l_linestatus = 'O' OR l_returnflag = 'N')
       SELECT l_suppkey, l_partkey, 'DECLARED_ONLY' AS side FROM (FROM d EXCEPT FROM o) UNION ALL SELECT l_suppkey, l_partkey, 'OBSERVED_ONLY' FROM (FROM o EXCEPT FROM d)""",
)
def reconcile_edges(t: Tables) -> DataFrame:
    declared, observed = t.lineitem.filter("l_returnflag <> 'N'"), t.lineitem.filter("l_linestatus = 'O' OR l_returnflag = 'N'")
    return lineage.reconcile_edges(declared, observed, ["l_suppkey", "l_partkey"])


@query(
    "dim_source_version",
    "SELECT data_source_version_id, resource_key, status FROM source_versions WHERE status IN ('APPROVED', 'CONDITIONAL') AND retired_at IS NULL",
    ["source_versions"],
)
def dim_source_version(t: Tables) -> DataFrame:
    return lineage.dim_source_version(t.source_versions).select("data_source_version_id", "resource_key", "status")


# --- streams ----------------------------------------------------------------------------------


def _event_stream(t: Tables) -> DataFrame:
    return arrivals.file_stream(t.spark, t.folder, t.events.schema, "events.parquet")


@query("stream_raw_append", RAW_SQL)
def stream_raw_append(t: Tables) -> DataFrame:
    """Events as a file stream into RAW; the stream is started a second time from nothing and adds no row."""
    from attestry.sources.ledger import read_ledger

    root = scratch_path(t.spark, "stream-raw")
    for attempt in ("a", "b"):
        job = arrivals.stream_raw_append(_event_stream(t), _raw, f"{root}/ledger", "raw", f"{root}/checkpoint-{attempt}")
        job.awaitTermination()
    return read_ledger(t.spark, f"{root}/ledger", "raw").select(*RAW_OUTPUT)


@query(
    "stream_freshness",
    """SELECT date_trunc('day', ts) AS window_start, event_type, COUNT(*) AS n, MIN(ts) AS first_at, MAX(ts) AS last_at FROM events GROUP BY 1, 2""",
)
def stream_freshness(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "stream-arrivals")
    job = arrivals.record_arrivals(_event_stream(t), "ts", "event_type", "1 day", f"{root}/ledger", "arrivals", f"{root}/checkpoint")
    job.awaitTermination()
    return arrivals.arrivals(t.spark, f"{root}/ledger", "arrivals", "event_type").drop("n_batches")
