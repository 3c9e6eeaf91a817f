"""Sketch profiles, bitemporal features, maintained lineage and streamed pages."""

from __future__ import annotations

import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from attestry.operators import gate, lineage, profiles, quality, vintages
from attestry.sources import paged


def day(n):
    return datetime(2026, 1, n)


# --- profiles ---------------------------------------------------------------------------------


def test_merged_profiles_estimate_within_their_error(spark):
    df = spark.range(60_000).select(
        (F.col("id") % 3).alias("v"), (F.col("id") % 20_000).alias("many"), F.when(F.col("id") % 4 > 0, F.col("id") % 7).alias("few"),
        F.lit(None).cast("double").alias("none"), F.concat(F.lit("k"), F.col("id") % 50).alias("text"),
    )
    per = profiles.profile_versions(df, "v", ["many", "few", "none", "text"])
    assert per.count() == 12
    got = {r.column_name: r for r in profiles.read_profiles(profiles.merge_profiles(per)).collect()}
    exact = {r.column_name: r.distinct_count for r in profiles.exact_distincts(df, ["many", "few", "none", "text"]).collect()}
    assert exact == {"many": 20_000, "few": 7, "none": 0, "text": 50}
    assert abs(got["many"].distinct_count - 20_000) < 0.049 * 20_000 and got["few"].distinct_count == 7 and got["text"].distinct_count == 50
    assert (got["few"].null_count, got["none"].null_count, got["none"].distinct_count, got["none"].quantiles) == (15_000, 60_000, 0, None)
    assert all(abs(q - p * 20_000) < 0.0133 * 20_000 for p, q in zip((0.25, 0.5, 0.75), got["many"].quantiles))
    assert (got["many"].min_number, got["many"].max_number, got["text"].quantiles, got["text"].max_text) == (0.0, 19_999.0, None, "k9")
    assert profiles.read_profiles(profiles.merge_profiles(per.limit(0))).collect() == []


def test_merging_reads_profiles_only(spark, tmp_path):
    path = str(tmp_path / "p")
    data = str(tmp_path / "d")
    spark.range(100).withColumn("v", F.lit(1)).write.parquet(data)
    profiles.profile_versions(spark.read.parquet(data), "v", ["id"]).write.parquet(path)
    plan = profiles.merge_profiles(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "/p]" in plan and "/d]" not in plan


def test_drift_sets_two_profiles_side_by_side(spark):
    one = spark.range(1000).select(F.lit(1).alias("v"), F.col("id").alias("x"))
    two = spark.range(1000).select(F.lit(2).alias("v"), F.when(F.col("id") % 2 == 0, F.col("id") + 1000).alias("x"))
    merged = [profiles.merge_profiles(profiles.profile_versions(df, "v", ["x"])) for df in (one, two)]
    row = profiles.drift(*merged).first()
    assert (row.null_share_before, row.null_share_after) == (0.0, 0.5) and abs(row.quantile_after - 1500) < 40 and abs(row.quantile_before - 500) < 20


# --- vintages ---------------------------------------------------------------------------------

RECORDS = "fips string, record string, at timestamp, tie int, version string, n long"


def features(spark, rows, as_of):
    df = spark.createDataFrame(rows, RECORDS)
    out = vintages.snapshots(df, ["fips"], ["fips", "record"], "at", "tie", "version", {"total": "n"}, "d1", [str(t) for t in as_of], F.lit("run-7"))
    return {(r.as_of.day, r.fips): r for r in out.collect()}


def test_a_later_correction_leaves_earlier_snapshots_alone(spark):
    rows = [("01", "a", day(1), 1, "v1", 10), ("01", "b", day(1), 2, "v1", 5), ("02", "a", day(3), 3, "v1", 1)]
    before = features(spark, rows, [day(2), day(4)])
    assert {k: (r.total, r.input_rows) for k, r in before.items()} == {(2, "01"): (15, 2), (4, "01"): (15, 2), (4, "02"): (1, 1)}
    corrected = [*rows, ("01", "a", day(5), 4, "v2", 100), ("01", "a", day(5), 5, "v3", 200)]
    after = features(spark, corrected, [day(2), day(4), day(6)])
    assert all(after[k] == r for k, r in before.items())
    last = after[6, "01"]
    assert (last.total, last.newest_vintage, last.run_id) == (205, day(5), "run-7")
    assert [(v.version, v.records) for v in last.versions] == [("v1", 1), ("v3", 1)]
    assert len({r.feature_snapshot_id for r in after.values()}) == 5
    assert features(spark, rows[:0], [day(2)]) == {}


def test_known_at_the_instant_of_a_correction(spark):
    df = spark.createDataFrame([("01", "a", day(1), 1, "v1", 1), ("01", "a", day(2), 2, "v2", 2)], RECORDS)
    got = vintages.known_at(df, ["fips", "record"], "at", "tie", [str(day(1)), str(day(2))])
    assert sorted((r.as_of.day, r.n) for r in got.collect()) == [(1, 1), (2, 2)]


# --- lineage ----------------------------------------------------------------------------------


def closure(pairs):
    out = {}
    for root in {a for a, _ in pairs}:
        level, depth, seen = {root}, 0, set()
        while level:
            depth += 1
            level = {b for a, b in pairs if a in level} - seen
            for b in level:
                seen.add(b)
                if b != root:
                    out[root, b] = depth
    return out


@pytest.mark.parametrize("seed", range(4))
def test_added_edges_give_the_closure_of_all(spark, seed):
    """Random graphs with cycles and shortcuts, extended twice."""
    rng = random.Random(seed)
    pairs = list({(f"a{rng.randrange(14)}", f"a{rng.randrange(14)}") for _ in range(18)} - {(f"a{i}", f"a{i}") for i in range(14)})
    schema = "output_object string, input_object string"
    first, second, third = pairs[:8], pairs[8:13], pairs[13:]
    edges = spark.createDataFrame(first, schema)
    reach = lineage.trace_lineage(edges, edges.select(F.col("output_object").alias("asset"))).filter("root <> ancestor")
    for more in (second, third):
        reach = lineage.cut_lineage(lineage.with_edges(reach, lineage.add_edges(reach, spark.createDataFrame(more, schema))))
    assert {(r.root, r.ancestor): r.depth for r in reach.collect()} == closure(pairs)


def test_only_what_changes_is_added(spark):
    schema = "output_object string, input_object string"
    edges = spark.createDataFrame([("c", "b"), ("b", "a"), ("z", "y")], schema)
    reach = lineage.cut_lineage(lineage.trace_lineage(edges, edges.select(F.col("output_object").alias("asset"))))
    got = lambda new: {(r.root, r.ancestor): r.depth for r in lineage.add_edges(reach, spark.createDataFrame(new, schema)).collect()}
    assert got([("c", "b")]) == {}
    assert got([("c", "a")]) == {("c", "a"): 1}
    assert got([("a", "z")]) == {("a", "z"): 1, ("a", "y"): 2, ("b", "z"): 2, ("b", "y"): 3, ("c", "z"): 3, ("c", "y"): 4}
    assert got([("a", "z"), ("y", "x")]) == got([("a", "z")]) | {("y", "x"): 1, ("z", "x"): 2, ("a", "x"): 3, ("b", "x"): 4, ("c", "x"): 5}


# --- pages ------------------------------------------------------------------------------------


def test_page_stream_goes_on_after_the_last_complete_page(spark, tmp_path):
    pages = tmp_path / "pages"
    paged.register(spark)

    def land(page, n):
        (pages / f"page={page:05d}").mkdir(parents=True)
        (pages / f"page={page:05d}" / "data.json").write_text("\n".join(json.dumps({"page": page, "i": i}) for i in range(n)) + "\n \n")

    def run():
        stream = spark.readStream.format("paged_stream").option("pagesPerTask", 2).load(str(pages))
        job = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start()
        job.awaitTermination()
        return sorted(r.page_sequence for r in spark.read.schema(paged.PAGE_SCHEMA).parquet(str(tmp_path / "out")).collect())

    for page in (0, 1, 2, 4):
        land(page, page + 1)
    # The third page is missing, so the fourth waits; nothing is read twice.
    assert run() == [0, 1, 2]
    assert run() == [0, 1, 2]
    land(3, 4)
    land(5, 6)
    assert run() == [0, 1, 2, 3, 4]
    paged.mark_complete(str(pages))
    assert run() == [0, 1, 2, 3, 4, 5]
    out = paged.page_records(spark.read.parquet(str(tmp_path / "out")))
    assert out.count() == 21 and out.filter("page_rows <> page_sequence + 1").isEmpty()


# --- small ones -------------------------------------------------------------------------------


def test_an_empty_sample_is_an_error(spark):
    with pytest.raises(ValueError, match="empty"):
        quality.ordered_sample(spark.range(0), "id")


def test_all_methods_share_one_aggregate(spark):
    df = spark.createDataFrame([("k", 2, "VALUE", 1), ("k", 4, "VALUE", 3), ("k", None, "SUPPRESSED", 9), ("e", None, "UNKNOWN", 1)], "k string, m int, state string, w int")
    out = quality.conform_aggregate(df, ["k"], "m", "state", ("SUM", "MEAN", "RATE", "AREA_WEIGHTED_MEAN"), "w")
    got = {(r.k, r.aggregation_method): r.measure for r in out.collect()}
    assert got == {("k", "SUM"): 6, ("k", "MEAN"): 3, ("k", "RATE"): 1.5, ("k", "AREA_WEIGHTED_MEAN"): 3.5, **{("e", m): None for m in ("SUM", "MEAN", "RATE", "AREA_WEIGHTED_MEAN")}}
    assert out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning") == 1


def test_an_unregistered_resource_is_not_ready(spark):
    keyed = spark.createDataFrame([("a",), ("b",), ("c",)], "resource_key string")
    assessed = keyed.select("resource_key", F.lit("x").alias("dataset_quality_assessment_id"), F.lit(day(1)).alias("assessed_at"), F.lit("PENDING_REVIEW").alias("assessment_status"))
    register = spark.createDataFrame([("a", True), ("b", False)], "resource_key string, is_active boolean")
    facts = gate.evidence_facts(keyed, keyed, keyed, assessed, keyed.limit(0), register)
    assert {r.resource_key: r.ok for r in facts.select("resource_key", gate.prerequisites_met(True).alias("ok")).collect()} == {"a": True, "b": False, "c": False}
    plain = gate.evidence_facts(keyed, keyed, keyed, assessed, keyed.limit(0))
    assert plain.filter(gate.prerequisites_met()).count() == 3
