"""Digests, canonical JSON and deterministic identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_json(text: Column) -> Column:
    """JSON text with sorted keys and no spaces; null where the text is not JSON."""
    return F.to_json(F.try_parse_json(text))


def sha256_hex(value: Column) -> Column:
    return F.sha2(value, 256)


def row_hash(payload: Column) -> Column:
    """Digest of a VARIANT record, independent of the key order it arrived in."""
    return sha256_hex(F.to_json(payload))


def content_id(*parts: Column) -> Column:
    """Identifier derived from content, so that a repeated job writes the same identifier."""
    return sha256_hex(F.to_json(F.struct(*[p.cast("string").alias(f"p{i}") for i, p in enumerate(parts)])))


def fold_case(text: Column) -> Column:
    """Full case folding: upper-casing expands letters such as sharp s before lower-casing."""
    return F.translate(F.lower(F.upper(text)), "ς", "σ")


def catalog_resource_key(catalog: Column, term: Column) -> Column:
    """Stable key of a catalog search that does not reveal the term."""
    return F.concat(F.lit("catalog:"), F.lower(catalog), F.lit(":"), F.left(sha256_hex(fold_case(term)), F.lit(16)))


def artifact_key(environment: Column, resource_key: Column, run_id: Column, digest: Column) -> Column:
    """Object key of an immutable artifact: environment, resource, run, digest."""
    return F.concat(
        F.concat_ws("/", environment, resource_key.cast("string"), run_id.cast("string"), digest), F.lit(".bin")
    )


def form_encode(text: Column) -> Column:
    """Query-string encoding (space becomes ``+``; letters, digits and ``_.-~`` stay)."""
    encoded = F.url_encode(text)
    return F.replace(F.replace(encoded, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def schema_fingerprint(fields: Column) -> Column:
    """Digest of an array of field structs in source order."""
    return sha256_hex(F.to_json(fields))
