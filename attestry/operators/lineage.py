"""Lineage edges, upstream tracing, provenance attachment and the source-version dimension."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.functions.digest import content_id
from attestry.operators.gate import is_eligible
from attestry.operators.segments import join_on_key
from attestry.schemas import LEDGERS, shape
from attestry.session import cut_lineage

RELATIONSHIPS = ("DIRECT_COPY", "PARSE", "FILTER", "JOIN", "AGGREGATE", "SPATIAL_MATCH", "TEMPORAL_WINDOW", "DERIVATION")


def dim_source_version(versions: DataFrame) -> DataFrame:
    """Approved, unretired versions as a dimension: a view over the ledger, not a second registry."""
    return versions.filter(is_eligible(F.col("status"), F.col("retired_at")))


def attach_provenance(facts: DataFrame, versions: DataFrame, runs: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Facts with their version, run and artifact columns; facts without one keep nulls."""
    out = join_on_key(facts, versions, ["data_source_version_id"], "left")
    out = join_on_key(out, runs, ["ingestion_run_id"], "left")
    return join_on_key(out, artifacts, ["artifact_id"], "left")


def lineage_edges_for(
    run_id: Column, steps: DataFrame, inputs: str, output: str, relationship: str, details: Mapping[str, str] | None = None
) -> DataFrame:
    """One edge per distinct input object and output object of a transformation step.

    Identifiers are derived from the edge, so recording a step twice appends nothing new.
    """
    if relationship not in RELATIONSHIPS:
        raise ValueError(f"unknown relationship: {relationship}")
    edges = steps.select(
        run_id.alias("transformation_run_id"), F.col(inputs).alias("input_object"), F.col(output).alias("output_object")
    ).distinct()
    return edges.withColumns(
        {
            "relationship_type": F.lit(relationship),
            "lineage_edge_id": content_id(
                F.col("transformation_run_id"), F.col("input_object"), F.col("output_object"), F.lit(relationship)
            ),
            **{name: F.lit(text) for name, text in (details or {}).items()},
        }
    )


def transformation_runs(
    name: str, target: str, versions: DataFrame, status: Column, started_at: Column, completed_at: Column, code_version: str | None = None
) -> DataFrame:
    """One row of ``transformation_runs``: what was built from which approved source versions.

    The id comes from name, target, start and versions, so a rerun of the same work is the same run. ``versions`` is a register, not facts:
    its list is bounded by the number of sources.
    """
    listed = versions.agg(F.array_sort(F.collect_set(F.col("data_source_version_id").cast("string"))).alias("input_source_versions"))
    rows = listed.select(
        content_id(F.lit("transformation"), F.lit(name), F.lit(target), started_at, F.array_join("input_source_versions", ",")).alias("transformation_run_id"),
        F.lit(name).alias("transformation_name"), F.lit(code_version).alias("code_version"), "input_source_versions", F.lit(target).alias("target_relation"),
        status.alias("status"), started_at.alias("started_at"), completed_at.alias("completed_at"),
    )
    return shape(rows, LEDGERS["transformation_runs"])


def reconcile_edges(declared: DataFrame, observed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Edges found on one side only, tagged DECLARED_ONLY or OBSERVED_ONLY; one aggregate over both sides."""
    both = declared.select(*columns, F.lit(1).alias("__d"), F.lit(0).alias("__o")).unionByName(
        observed.select(*columns, F.lit(0).alias("__d"), F.lit(1).alias("__o"))
    )
    sides = both.groupBy(*columns).agg(F.max("__d").alias("__d"), F.max("__o").alias("__o"))
    return sides.filter(F.col("__d") != F.col("__o")).select(
        *columns, F.when(F.col("__d") == 1, "DECLARED_ONLY").otherwise("OBSERVED_ONLY").alias("side")
    )


def add_edges(reach: DataFrame, new_edges: DataFrame) -> DataFrame:
    """Pairs (root, ancestor, depth) that new edges add to a reachability table, or bring nearer; the table itself is left as it is.

    Semi-naive: a new pair goes from what reaches the edge's output to what its input reaches, so only pairs of these two
    assets are read (a join by them, not a search from all roots). Pairs found in one round meet the new edges again in the next, until none is
    new; a round costs what the last one found.
    """
    links = new_edges.select("output_object", "input_object").distinct()
    known = reach.select("root", "ancestor", "depth")
    # What lies above each new input, itself included, and below each new output.
    inputs, outputs = links.select(F.col("input_object").alias("root")).distinct(), links.select(F.col("output_object").alias("ancestor")).distinct()
    above = join_on_key(known, inputs, ["root"], "inner").unionByName(inputs.select("root", F.col("root").alias("ancestor"), F.lit(0).alias("depth")))
    below = join_on_key(known, outputs, ["ancestor"], "inner").unionByName(outputs.select(F.col("ancestor").alias("root"), "ancestor", F.lit(0).alias("depth")))
    spans = cut_lineage(
        links.join(above.select(F.col("root").alias("input_object"), F.col("ancestor").alias("top"), F.col("depth").alias("up")), "input_object").groupBy("output_object", "top").agg(F.min("up").alias("up"))
    )
    found = delta = None
    frontier = cut_lineage(below)
    while True:
        steps = frontier.select("root", F.col("ancestor").alias("output_object"), "depth").join(spans, "output_object")
        # Going round a cycle back to the root is a pair like any other; the root's own empty path is not.
        step = steps.groupBy("root", F.col("top").alias("ancestor")).agg(F.min(F.col("depth") + 1 + F.col("up")).cast("int").alias("depth"))
        before = known if found is None else known.unionByName(found)
        best = before.join(step.select("root", "ancestor").distinct(), ["root", "ancestor"], "left_semi").groupBy("root", "ancestor").agg(F.min("depth").alias("__best"))
        delta = cut_lineage(step.join(best, ["root", "ancestor"], "left").filter(F.col("__best").isNull() | (F.col("depth") < F.col("__best"))).drop("__best"))
        if delta.isEmpty():
            break
        found = delta if found is None else cut_lineage(found.unionByName(delta).groupBy("root", "ancestor").agg(F.min("depth").alias("depth")))
        frontier = delta.join(outputs, "ancestor", "left_semi")
    return (known.limit(0) if found is None else found).filter("root <> ancestor")


def with_edges(reach: DataFrame, added: DataFrame) -> DataFrame:
    """A reachability table with what ``add_edges`` found: one row per pair, the smallest depth."""
    return reach.select("root", "ancestor", "depth").unionByName(added).groupBy("root", "ancestor").agg(F.min("depth").alias("depth"))


def trace_lineage(edges: DataFrame, roots: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Every asset upstream of each root, with the smallest number of steps to it.

    Breadth-first by levels: each level joins only the assets found in the level before, and pairs
    seen earlier are dropped, so diamonds do not multiply and cycles end. Levels are checkpointed,
    which keeps the plan short and lets a lost executor restart from the last level.
    A caller may set ``max_depth``; more levels than that raise an error.
    """
    links = edges.select(F.col("output_object").alias("asset"), F.col("input_object").alias("__up")).distinct()
    frontier = roots.select(F.col("asset").alias("root"), "asset").distinct()
    seen = frontier.select("root", F.col("asset").alias("ancestor"), F.lit(0).alias("depth"))
    for depth in count(1):
        if max_depth is not None and depth > max_depth:
            raise ValueError(f"lineage is deeper than {max_depth} levels")
        step = join_on_key(frontier, links, ["asset"], "inner").select("root", F.col("__up").alias("ancestor")).distinct()
        fresh = cut_lineage(step.join(seen.select("root", "ancestor"), ["root", "ancestor"], "left_anti"))
        if fresh.isEmpty():
            return seen.filter("depth > 0")
        seen = seen.unionByName(fresh.withColumn("depth", F.lit(depth)))
        frontier = fresh.withColumnRenamed("ancestor", "asset")
