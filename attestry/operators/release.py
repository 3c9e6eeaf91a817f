"""Release bundles: flattening, acceptance checks and the current-release views."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.functions.geo import parse_geometry

# Bundle contract.
SCHEMA_VERSION = "0.2.0"
EXPECTED_COUNTIES = 3144
NO_RECORD_STATUS = "no_county_linked_record"
FIPS_PATTERN = "^[0-9]{5}$"

COUNTY_FIELDS = {
    "fips": "string",
    "county": "string",
    "state": "string",
    "state_name": "string",
    "population": "bigint",
    "in_contiguous_tick_scope": "boolean",
    "human_status": "string",
    "case_count_floor_2023": "bigint",
    "incidence_floor_2023": "double",
    "state_unallocated_records_2023": "bigint",
    "tick_status": "string",
    "scapularis_status": "string",
    "pacificus_status": "string",
    "burgdorferi_status": "string",
    "svi_percentile": "double",
    "uninsured_percentile": "double",
    "uninsured_percent": "double",
    "rucc_2023": "bigint",
    "evidence_completeness": "bigint",
}


def flatten_features(features: DataFrame) -> DataFrame:
    """Feature text column ``feature`` to typed county columns plus score and geometry as JSON text.

    One variant parse per feature; every later column reads from it.
    """
    parsed = features.withColumn("__f", F.try_parse_json("feature"))
    columns = [
        F.try_variant_get("__f", f"$.properties.{name}", kind).alias(name) for name, kind in COUNTY_FIELDS.items()
    ]
    return parsed.select(
        *[c for c in features.columns if c != "feature"],
        *columns,
        F.to_json(F.try_variant_get("__f", "$.properties.default", "variant")).alias("default_score_text"),
        F.to_json(F.try_variant_get("__f", "$.geometry", "variant")).alias("geometry_json_text"),
    )


def finalize_counties(staged: DataFrame) -> DataFrame:
    """Staged text columns to typed ones: variants for score and geometry, a parsed shape beside them."""
    return staged.withColumns(
        {
            "default_score": F.try_parse_json("default_score_text"),
            "geometry_json": F.try_parse_json("geometry_json_text"),
            "geography": parse_geometry(F.col("geometry_json_text")),
        }
    ).drop("default_score_text", "geometry_json_text")


def current_release(releases: DataFrame) -> DataFrame:
    return releases.filter("is_current").drop("is_current")


def current_rows(rows: DataFrame, releases: DataFrame) -> DataFrame:
    """Rows of the current release. With rows partitioned by release this prunes to one partition."""
    return rows.join(releases.filter("is_current").select("release_id"), "release_id")


def release_status(releases: DataFrame) -> DataFrame:
    return releases.orderBy(F.desc_nulls_last("loaded_at"), F.desc("release_id"))


def validate_release(rows: DataFrame, key: str, expected: int | None = None, bad_key: Column | None = None) -> DataFrame:
    """Count, distinct keys, malformed keys and missing geometry per release, and a verdict.

    Keys are counted per (release, key) first; both steps combine map-side.
    """
    malformed = F.length(key) != 5 if bad_key is None else bad_key
    per_key = rows.groupBy("release_id", key).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(malformed).alias("bad"),
        F.count_if(F.col("geometry_json").isNull()).alias("no_geometry"),
    )
    totals = per_key.groupBy("release_id").agg(
        F.sum("n").alias("row_count"),
        F.count(key).alias("distinct_keys"),
        F.sum("bad").alias("invalid_keys"),
        F.sum("no_geometry").alias("missing_geometry"),
    )
    sound = (F.col("distinct_keys") == F.col("row_count")) & (F.col("invalid_keys") == 0) & (F.col("missing_geometry") == 0)
    if expected is not None:
        sound = sound & (F.col("row_count") == expected)
    return totals.withColumn("is_valid", sound)


def unique_key_offenders(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def unique_key_check(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows, distinct keys, and whether they agree."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("row_count"), F.count(F.lit(1)).alias("distinct_keys")
    ).withColumn("is_unique", F.col("row_count") == F.col("distinct_keys"))


def missing_not_zero(rows: DataFrame, status: Column, measures: list[str]) -> DataFrame:
    """Offenders: rows declared to have no record that still carry a count (a zero is an offence too)."""
    carried = reduce(lambda a, b: a | b, [F.col(m).isNotNull() for m in measures])
    return rows.filter(status & carried)


def bundle_checks(counties: DataFrame, schema_version: str, expected: int = EXPECTED_COUNTIES) -> DataFrame:
    """One row per acceptance rule of a bundle: number of offences and whether it passed."""
    per_key = counties.groupBy("fips").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~F.coalesce(F.col("fips").rlike(FIPS_PATTERN), F.lit(False))).alias("bad_key"),
        F.count_if(
            (F.col("human_status") == NO_RECORD_STATUS)
            & (F.col("case_count_floor_2023").isNotNull() | F.col("incidence_floor_2023").isNotNull())
        ).alias("filled_missing"),
        F.count_if(~F.coalesce(F.col("default_score").between(0, 100), F.lit(False))).alias("bad_score"),
    )
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeated"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("bad_key", "filled_missing", "bad_score")],
    )
    rules = {
        "schema_version": F.lit(int(schema_version != SCHEMA_VERSION)),
        "county_count": F.abs(F.col("rows") - expected),
        "unique_fips": F.col("repeated"),
        "fips_format": F.col("bad_key"),
        "missing_not_zero": F.col("filled_missing"),
        "score_range": F.col("bad_score"),
    }
    rows = F.array(*[F.struct(F.lit(k).alias("rule_id"), v.cast("bigint").alias("offences")) for k, v in rules.items()])
    return totals.select(F.explode(rows).alias("r")).select("r.*", (F.col("r.offences") == 0).alias("passed"))
