"""Direct files and release bundles, each row with the file it came from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attestry.functions.geo import parse_geometry

MALFORMED = "malformed_record"


def _with_origin(df: DataFrame) -> DataFrame:
    return df.select(
        "*", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_size").alias("source_file_bytes")
    )


def read_direct_file(spark: SparkSession, path: str, kind: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV, JSON lines, GeoJSON or Parquet with ``source_file`` and ``source_file_bytes``.

    CSV and JSON need a schema: inferring one would read everything twice. Their records that do not fit it keep
    their text in ``MALFORMED``, which is null for sound ones; ``malformed_records`` are the former.
    """
    reader = spark.read
    if kind == "parquet":
        return _with_origin(reader.parquet(path))
    if kind == "geojson":
        features = _with_origin(reader.schema("features array<string>").option("multiLine", True).json(path))
        each = features.select("source_file", "source_file_bytes", F.explode("features").alias("feature"))
        return each.withColumn("geometry", parse_geometry(F.get_json_object("feature", "$.geometry")))
    if schema is None:
        raise ValueError(f"{kind} files need a schema")
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    marked = T.StructType([*fields.fields, T.StructField(MALFORMED, T.StringType())])
    reader = reader.schema(marked).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", MALFORMED)
    if kind == "csv":
        # Without pruning a record is judged by all its columns, whatever the query reads.
        return _with_origin(reader.option("header", True).option("columnPruning", False).csv(path))
    if kind == "json":
        return _with_origin(reader.json(path))
    raise ValueError(f"unsupported file kind: {kind}")


def malformed_records(df: DataFrame) -> DataFrame:
    """Records of ``read_direct_file`` that do not fit the schema: file, text and what could be read of them."""
    read = F.struct(*[f"`{c}`" for c in df.columns if c not in (MALFORMED, "source_file", "source_file_bytes")])
    return df.filter(F.col(MALFORMED).isNotNull()).select("source_file", F.col(MALFORMED).alias("record"), read.alias("read"))


BUNDLE_SCHEMA = """
schema_version string, generated_at string, scope string, score_defaults string,
sources array<struct<key: string, label: string, vintage: string, url: string, note: string>>,
feature_collection struct<features: array<string>>
"""


def read_release_bundle(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Bundle documents, plain or gzip. A single document is one JSON text; ``lines`` reads one per line.

    Features are kept as text here, so one parse later serves every column.
    """
    return spark.read.schema(BUNDLE_SCHEMA).option("multiLine", not lines).json(path)


def bundle_features(bundle: DataFrame, release_id: str) -> DataFrame:
    """One row per feature, spread over the cluster before the parsing starts."""
    features = bundle.select(F.explode("feature_collection.features").alias("feature"))
    return features.repartition(F.xxhash64("feature")).select(F.lit(release_id).alias("release_id"), "feature")


def bundle_sources(bundle: DataFrame, release_id: str) -> DataFrame:
    return bundle.select(F.explode("sources").alias("s")).select(
        F.lit(release_id).alias("release_id"),
        F.col("s.key").alias("source_key"),
        "s.label",
        "s.vintage",
        F.col("s.url").alias("source_url"),
        "s.note",
    )


def bundle_release(bundle: DataFrame, release_id: str, sha256: str, methodology: str, limitations: str) -> DataFrame:
    return bundle.select(
        F.lit(release_id).alias("release_id"),
        "schema_version",
        F.to_timestamp("generated_at").alias("generated_at"),
        F.current_timestamp().alias("loaded_at"),
        "scope",
        F.lit(sha256).alias("bundle_sha256"),
        F.try_parse_json("score_defaults").alias("score_defaults"),
        F.lit(methodology).alias("methodology_version"),
        F.lit(limitations).alias("limitations"),
    )


def content_digest(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 of the uncompressed text of whole files."""
    texts = spark.read.text(path, wholetext=True)
    return texts.select(F.col("_metadata.file_path").alias("path"), F.sha2("value", 256).alias("sha256"))


def file_digest(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 and size of whole files as stored, unread by any parser."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.col("length").alias("byte_count"), F.sha2("content", 256).alias("sha256"))
