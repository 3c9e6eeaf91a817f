"""Units of work that write several ledgers at once: discovery, evidence collection, release loading."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attestry.functions.digest import canonical_json, catalog_resource_key, content_id, schema_fingerprint, sha256_hex
from attestry.functions.redact import redact_map, redact_values, strip_query
from attestry.functions.values import WEIGHTS, score_sources
from attestry.operators import release
from attestry.operators.discovery import number_requests
from attestry.schemas import LEDGERS, shape
from attestry.session import cut_lineage
from attestry.sources import files, ledger
from attestry.sources.commits import Log

# Fields a surveillance sample must show, and the sample limits.
DOCUMENT_TYPE = "METADATA_AND_LICENSE"
REQUIRED_FIELDS = ("fips", "year", "case_status", "frequency")
SAMPLE_DEFAULT, SAMPLE_MAX = 25, 100


def discovery_tables(
    responses: DataFrame, run_id: str, config_sha256: str, environment: str, started_at: Column, completed_at: Column
) -> dict[str, DataFrame]:
    """Run, request and artifact rows of one discovery run.

    ``responses``: a search plan with ``url``, ``headers`` (string map), ``status_code`` and
    ``response`` (text or null). Failed requests keep their evidence; a run without a single
    success is FAILED, with some it is PARTIAL.
    """
    run = F.lit(run_id)
    numbered = number_requests(responses).withColumns(
        {
            "ingestion_request_id": content_id(run, F.col("request_sequence")),
            "payload": F.coalesce(canonical_json(F.col("response")), F.col("response")),
        }
    )
    described = F.map_concat(
        F.create_map(F.lit("catalog_id"), "catalog_id", F.lit("term"), "term"),
        F.coalesce("headers", F.create_map().cast("map<string,string>")),
    )
    requests = numbered.select(
        "ingestion_request_id",
        run.alias("ingestion_run_id"),
        "request_sequence",
        F.lit("CATALOG_DISCOVERY").alias("request_purpose"),
        strip_query(F.col("url")).alias("endpoint"),
        F.parse_json(F.to_json(redact_values(redact_map(described)))).alias("redacted_request"),
        F.col("status_code").cast("bigint").alias("status_code"),
        sha256_hex(F.col("payload")).alias("response_sha256"),
        completed_at.alias("created_at"),
    )
    stored = numbered.filter(F.col("payload").isNotNull()).select(
        "ingestion_request_id", catalog_resource_key(F.col("catalog_id"), F.col("term")).alias("resource_key"), "payload"
    )
    artifacts = ledger.register_artifacts(
        stored, "payload", environment=F.lit(environment), resource_key=F.col("resource_key"), run=run,
        kind="CATALOG_METADATA", media_type="application/json",
    ).select(
        content_id(F.lit("artifact"), F.col("ingestion_request_id")).alias("artifact_id"),
        run.alias("ingestion_run_id"),
        "ingestion_request_id", "artifact_uri", "artifact_type", "media_type", "byte_count", "sha256", "retention_class",
        completed_at.alias("created_at"),
    )
    counted = responses.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status_code").between(200, 299)).alias("ok"))
    status = F.when(F.col("ok") == F.col("n"), "COMPLETED").when(F.col("ok") == 0, "FAILED").otherwise("PARTIAL")
    steps = F.array(
        F.struct(F.lit("RUNNING").alias("status"), F.lit(0).alias("step"), F.lit(None).cast("timestamp").alias("completed_at")),
        F.struct(status.alias("status"), F.lit(1).alias("step"), completed_at.cast("timestamp").alias("completed_at")),
    )
    runs = counted.select(F.explode(steps).alias("s")).select(
        run.alias("ingestion_run_id"),
        F.lit("catalog_discovery").alias("resource_key"),
        F.lit("DISCOVERY").alias("run_mode"),
        F.lit("SCHEDULED").alias("trigger_type"),
        "s.status", "s.step",
        F.lit(config_sha256).alias("config_sha256"),
        started_at.alias("started_at"),
        "s.completed_at",
    )
    return {"ingestion_runs": runs, "ingestion_requests": requests, "raw_artifacts": artifacts}


def ordered_samples(records: DataFrame, key: str, record_id: str, record: str, size: int = SAMPLE_DEFAULT) -> DataFrame:
    """First ``size`` records of every resource by record id, as one canonical JSON array with its digest.

    The rank is limited before the shuffle, so a large resource sends only ``size`` rows per task.
    """
    if not 1 <= size <= SAMPLE_MAX:
        raise ValueError(f"sample size must be between 1 and {SAMPLE_MAX}")
    order = Window.partitionBy(key).orderBy(F.asc_nulls_last(record_id))
    first = records.select(key, record_id, record).withColumn("__n", F.row_number().over(order)).filter(F.col("__n") <= size)
    rows = first.withColumn("__json", canonical_json(F.col(record)))
    names = F.map_keys(F.try_parse_json("__json").cast("map<string,variant>"))
    listed = rows.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("__n", "__json"))).alias("__rows"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(names)))).alias("observed_fields"),
        F.count(F.lit(1)).alias("sample_rows"),
    )
    text = F.concat(F.lit("["), F.array_join(F.transform("__rows", lambda r: r["__json"]), ","), F.lit("]"))
    return listed.select(key, "sample_rows", "observed_fields", text.alias("sample_payload")).withColumn(
        "sample_sha256", sha256_hex(F.col("sample_payload"))
    )


def evidence_tables(
    metadata: DataFrame,
    records: DataFrame,
    profiles: DataFrame,
    scores: Mapping[str, Column],
    environment: str,
    at: Column,
    required: Sequence[str] = REQUIRED_FIELDS,
    size: int = SAMPLE_DEFAULT,
    known_documents: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All ledger rows of an evidence collection over any number of resources, and the refused ones.

    ``metadata``: ``resource_key, document`` (JSON); ``records``: ``resource_key, record_id,
    record`` (JSON); ``profiles``: ``resource_key, profile_version, connector_name,
    endpoint_template, metadata_endpoint_template, deterministic_order_clause,
    incremental_strategy``. ``known_documents``: rows of ``source_document_snapshots`` taken before; a document whose digest differs from the newest of
    its resource and type is a material change. Resources without metadata, sample, required fields or a
    deterministic order go to ``refused`` with the reason.
    """
    samples = ordered_samples(records, "resource_key", "record_id", "record", size)
    joined = profiles.join(metadata, "resource_key", "left").join(samples, "resource_key", "left")
    lacking = F.array_except(F.array(*[F.lit(r) for r in required]), F.col("observed_fields"))
    document = canonical_json(F.col("document"))
    judged = joined.withColumns(
        {
            "metadata_payload_text": document,
            "refusal": F.when(~F.col("deterministic_order_clause").eqNullSafe(F.lit(":id ASC")), "NO_DETERMINISTIC_ORDER")
            .when(document.isNull(), "METADATA_MISSING")
            .when(F.col("sample_rows").isNull(), "SAMPLE_EMPTY")
            .when(F.size(lacking) > 0, "REQUIRED_FIELDS_MISSING"),
            "columns_text": F.coalesce(F.get_json_object("document", "$.columns"), F.lit("[]")),
        }
    )
    if known_documents is not None:
        kind = known_documents.filter(F.col("document_type") == DOCUMENT_TYPE)
        newest = kind.groupBy("resource_key").agg(F.max_by("content_sha256", F.struct("retrieved_at", "source_document_snapshot_id")).alias("known_sha256"))
        judged = judged.join(newest, "resource_key", "left")
    else:
        judged = judged.withColumn("known_sha256", F.lit(None).cast("string"))
    # One row per resource feeds ten tables: it is computed once and kept in the shared folder.
    judged = cut_lineage(judged)
    good = judged.filter(F.col("refusal").isNull()).withColumns(
        {
            "run_id": content_id(F.lit("run"), F.col("resource_key"), at),
            "metadata_sha256": sha256_hex(F.col("metadata_payload_text")),
            "configuration_sha256": sha256_hex(F.to_json(F.struct(*[F.col(c) for c in sorted(profiles.columns)]))),
        }
    )
    purposes = F.array(
        F.struct(
            F.lit(1).cast("bigint").alias("request_sequence"), F.lit("SOURCE_METADATA").alias("request_purpose"),
            F.col("metadata_endpoint_template").alias("endpoint"), F.col("metadata_payload_text").alias("payload"),
            F.lit(1).cast("bigint").alias("retrieved_row_count"),
        ),
        F.struct(
            F.lit(2).cast("bigint").alias("request_sequence"), F.lit("ORDERED_SOURCE_SAMPLE").alias("request_purpose"),
            F.col("endpoint_template").alias("endpoint"), F.col("sample_payload").alias("payload"),
            F.col("sample_rows").alias("retrieved_row_count"),
        ),
    )
    fetched = good.select("resource_key", "run_id", F.explode(purposes).alias("r")).select("resource_key", "run_id", "r.*")
    fetched = fetched.withColumn("ingestion_request_id", content_id(F.col("run_id"), F.col("request_sequence")))
    stored = ledger.register_artifacts(
        fetched, "payload", environment=F.lit(environment), resource_key=F.col("resource_key"), run=F.col("run_id"),
        kind="SOURCE", media_type="application/json",
    )
    assessed = score_sources(good.withColumns({f"{n}_score": scores[n].cast("decimal(5,2)") for n in WEIGHTS}))

    def rows(df: DataFrame, ident: str, kind: str, **columns: Column) -> DataFrame:
        return df.select(
            content_id(F.lit(kind), F.col("run_id")).alias(ident), "resource_key", *[c.alias(n) for n, c in columns.items()]
        )

    tables = {
        "ingestion_runs": good.select(
            F.col("run_id").alias("ingestion_run_id"), "resource_key", F.lit("EVIDENCE_ONLY").alias("run_mode"),
            F.lit("MANUAL").alias("trigger_type"), F.lit("COMPLETED").alias("status"),
            F.col("configuration_sha256").alias("config_sha256"), at.alias("started_at"), at.alias("completed_at"),
        ),
        "ingestion_requests": fetched.select(
            "ingestion_request_id", F.col("run_id").alias("ingestion_run_id"), "request_sequence", "request_purpose",
            strip_query(F.col("endpoint")).alias("endpoint"), F.lit(200).cast("bigint").alias("status_code"),
            sha256_hex(F.col("payload")).alias("response_sha256"), "retrieved_row_count", at.alias("created_at"),
        ),
        "raw_artifacts": stored.select(
            content_id(F.lit("artifact"), F.col("ingestion_request_id")).alias("artifact_id"),
            F.col("run_id").alias("ingestion_run_id"), "ingestion_request_id", "artifact_uri",
            F.col("request_purpose").alias("artifact_type"), "media_type", "byte_count", "sha256", "retention_class",
            at.alias("created_at"),
        ),
        "catalog_datasets": rows(
            good, "catalog_dataset_id", "dataset", dataset_key=F.col("resource_key"), catalog_name=F.col("connector_name"),
            metadata_payload=F.parse_json("metadata_payload_text"), metadata_sha256=F.col("metadata_sha256"), discovered_at=at,
            is_current=F.lit(True),
        ),
        "catalog_resources": rows(
            good, "catalog_resource_id", "resource", catalog_dataset_id=content_id(F.lit("dataset"), F.col("run_id")),
            resource_type=F.lit("API"), canonical_source_url=strip_query(F.col("endpoint_template")), registered_at=at,
            is_active=F.lit(True),
        ),
        "source_access_profiles": rows(
            good, "source_access_profile_id", "profile", profile_version=F.col("profile_version").cast("bigint"),
            connector_name=F.col("connector_name"), endpoint_template=F.col("endpoint_template"),
            deterministic_order_clause=F.col("deterministic_order_clause"), incremental_strategy=F.col("incremental_strategy"),
            configuration_sha256=F.col("configuration_sha256"), effective_from=at,
        ),
        "source_document_snapshots": rows(
            good, "source_document_snapshot_id", "document", document_type=F.lit(DOCUMENT_TYPE),
            document_url=F.col("metadata_endpoint_template"), content_sha256=F.col("metadata_sha256"), retrieved_at=at,
            is_material_change=F.col("known_sha256").isNotNull() & (F.col("known_sha256") != F.col("metadata_sha256")),
        ),
        "schema_snapshots": rows(
            good, "schema_snapshot_id", "schema",
            schema_fingerprint=schema_fingerprint(F.from_json("columns_text", "array<struct<name:string,dataTypeName:string,description:string>>")),
            schema_payload=F.try_parse_json("columns_text"), retrieved_at=at,
        ),
        "dataset_quality_assessments": rows(
            assessed, "dataset_quality_assessment_id", "assessment", assessment_status=F.lit("PENDING_REVIEW"),
            **{f"{n}_score": F.col(f"{n}_score") for n in WEIGHTS}, overall_score=F.col("overall_score"),
            recommendation=F.col("recommendation"), assessed_at=at,
        ),
    }
    # Every table as its ledger has it; a required column that is missing is an error here.
    shaped = {name: shape(rows, LEDGERS[name]) for name, rows in tables.items()}
    return shaped | {"refused": judged.filter(F.col("refusal").isNotNull()).select("resource_key", "refusal")}


def load_release(
    spark: SparkSession, bundle_path: str, root: str, release_id: str, expected_sha256: str, methodology: str, limitations: str,
    expected_rows: int = release.EXPECTED_COUNTIES,
) -> DataFrame:
    """Check, flatten and write a release, then move the pointer. Returns the check results.

    Nothing is written unless the digest of the uncompressed text and all acceptance rules hold. Counties, sources, registry and
    pointer change in one commit, which replaces the release as a whole or does nothing.
    """
    seen = Log(spark, root).head()
    found = files.content_digest(spark, bundle_path).select("sha256").first()
    if found is None or found.sha256 != expected_sha256:
        raise ValueError("release bundle checksum mismatch")
    bundle = files.read_release_bundle(spark, bundle_path)
    registry = files.bundle_release(bundle, release_id, expected_sha256, methodology, limitations)
    version = registry.select("schema_version").first().schema_version
    staged = release.flatten_features(files.bundle_features(bundle, release_id))
    scored = staged.withColumn("default_score", F.get_json_object("default_score_text", "$.score").cast("double"))
    results = release.bundle_checks(scored, version, expected_rows)
    broken = [r.rule_id for r in results.filter("NOT passed").collect()]
    if broken:
        raise ValueError(f"release bundle breaks rules: {', '.join(sorted(broken))}")
    tables = {"county_facts": release.finalize_counties(staged), "source_metadata": files.bundle_sources(bundle, release_id), "dataset_release": registry}
    ledger.replace_release(root, release_id, tables, current=True, seen=seen)
    return results
