"""Catalog discovery: search plans, resource registration, routing, mirrors and relevance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.functions.digest import fold_case, form_encode
from attestry.operators.history import dedupe_keep_observations
from attestry.operators.segments import broadcast_if_small, join_on_key, numbered

# Fixed value: the supported version of search configurations.
SEARCH_SCHEMA_VERSION = "1.0"

SEARCH_CONFIG_SCHEMA = """
`$schema_version` string,
initially_enabled_term_group_ids array<string>,
catalogs array<struct<
  catalog_id: string, enabled: boolean, search_endpoint: string, search_parameter: string,
  fixed_query_parameters: map<string, string>,
  search_term_group_ids: array<string>, catalog_specific_terms: array<string>>>,
term_groups array<struct<id: string, terms: array<string>>>
"""


def config_relations(config: DataFrame) -> dict[str, DataFrame]:
    """Split configuration documents into relations: catalogs, references, terms, specific terms."""
    catalogs = config.select(
        F.col("initially_enabled_term_group_ids").alias("enabled_groups"),
        F.posexplode("catalogs").alias("catalog_order", "c"),
    )
    header = [
        F.col("c.catalog_id").alias("catalog_id"),
        "catalog_order",
        F.col("c.enabled").alias("enabled"),
        F.col("c.search_endpoint").alias("search_endpoint"),
        F.col("c.search_parameter").alias("search_parameter"),
        F.col("c.fixed_query_parameters").alias("fixed_query_parameters"),
    ]
    references = catalogs.select(
        *header, "enabled_groups", F.posexplode("c.search_term_group_ids").alias("group_order", "group_id")
    ).withColumn("group_enabled", F.array_contains("enabled_groups", F.col("group_id"))).drop("enabled_groups")
    groups = config.select(F.explode("term_groups").alias("g")).select(F.col("g.id").alias("group_id"), F.col("g.terms").alias("terms"))
    specific = catalogs.select(*header, F.posexplode("c.catalog_specific_terms").alias("term_order", "term"))
    return {"catalogs": catalogs.select(*header), "references": references, "groups": groups, "specific": specific}


def enabled_catalog_groups(enabled: Column, groups: Column) -> Column:
    """Groups a catalog lists that are also enabled, in the catalog's order."""
    return F.array_intersect(groups, enabled)


def expand_search_plan(
    references: DataFrame, terms: DataFrame, specific: DataFrame | None = None
) -> DataFrame:
    """One row per catalog and distinct term (letter case ignored), with its position in the catalog.

    ``references``: catalog rows by group (``catalog_order, group_order, group_id, enabled,
    group_enabled``); ``terms``: ``group_id, term_order, term``. A repeated term keeps its first
    position and its last spelling. ``specific`` adds catalog-specific terms after the groups.
    """
    used = references.filter(F.col("enabled") & F.col("group_enabled"))
    listed = join_on_key(used, terms, ["group_id"], "inner").select(
        "catalog_id", "catalog_order", "group_order", "term_order", "term"
    )
    if specific is not None:
        extra = specific.filter("enabled").select(
            "catalog_id", "catalog_order", F.lit(2**31 - 1).alias("group_order"), "term_order", "term"
        )
        listed = listed.unionByName(extra)
    place = F.struct("group_order", "term_order")
    return listed.groupBy("catalog_id", "catalog_order", fold_case(F.col("term")).alias("term_key")).agg(
        F.min(place).alias("__first"), F.max_by("term", place).alias("term")
    ).select("catalog_id", "catalog_order", "__first.group_order", "__first.term_order", "term_key", "term")


def search_plan(config: DataFrame) -> DataFrame:
    """Numbered requests of a whole search configuration: group terms and, after them, each catalog's own."""
    parts = config_relations(config)
    terms = parts["groups"].select("group_id", F.posexplode("terms").alias("term_order", "term"))
    return number_requests(expand_search_plan(parts["references"], terms, parts["specific"]))


def number_requests(plan: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Deterministic ``request_sequence`` 1..n by catalog, group and term position."""
    return numbered(
        plan,
        list(keys),
        ["catalog_order", "group_order", "term_order", "term_key"],
        "request_sequence",
    )


def first_requests(plan: DataFrame, maximum: int) -> DataFrame:
    if maximum < 1:
        raise ValueError("maximum must be at least 1")
    return plan.filter(F.col("request_sequence") <= maximum)


def request_url(endpoint: Column, fixed: Column, parameter: Column, term: Column) -> Column:
    """Search URL: fixed parameters in their order, then the term; a fixed one of the same name is replaced."""

    def pair(key: Column, value: Column) -> Column:
        return F.concat(form_encode(key), F.lit("="), form_encode(value))

    entries = F.coalesce(F.map_entries(fixed), F.array().cast("array<struct<key:string,value:string>>"))
    own = F.exists(entries, lambda e: e["key"] == parameter)
    pairs = F.transform(entries, lambda e: pair(e["key"], F.when(e["key"] == parameter, term).otherwise(e["value"])))
    pairs = F.when(own, pairs).otherwise(F.concat(pairs, F.array(pair(parameter, term))))
    return F.concat(endpoint, F.lit("?"), F.array_join(pairs, "&"))


def search_config_checks(versions: DataFrame, references: DataFrame, terms: DataFrame) -> DataFrame:
    """Violations: unsupported version, references to groups that are missing or have no terms."""
    bad_version = versions.filter(~F.col("schema_version").eqNullSafe(F.lit(SEARCH_SCHEMA_VERSION))).select(
        F.lit("unsupported_schema_version").alias("violation"),
        F.lit(None).cast("string").alias("catalog_id"),
        F.lit(None).cast("string").alias("group_id"),
    )
    filled = terms.filter(F.col("term").isNotNull()).select("group_id")
    bad_group = (
        references.select("catalog_id", "group_id")
        .join(filled, "group_id", "left_anti")
        .distinct()
        .select(F.lit("missing_or_empty_group").alias("violation"), "catalog_id", "group_id")
    )
    return bad_version.unionByName(bad_group)


# Routing by observed kind of resource.
DATA_FORMATS = ("csv", "json", "geojson", "parquet", "xlsx", "zip")
ROUTES = {
    "CONTROLLED_ACCESS": "RECORD_LIMITATION",
    "API": "CAPTURE_METADATA_AND_SAMPLE",
    "DATA": "CAPTURE_HEADERS_AND_SAMPLE",
    "DATA_DICTIONARY": "STORE_DOCUMENT",
    "DOCUMENTATION": "STORE_DOCUMENT",
    "LANDING_PAGE": "RECORD_RESEARCH_LEAD",
}


def resource_class(url: Column, access: Column | None = None, media_type: Column | None = None) -> Column:
    """Class of a resource by access, URL path, extension and media type."""
    path = F.lower(F.substring_index(F.substring_index(url, "?", 1), "#", 1))
    kind = F.when(F.lower(access).isin("restricted", "controlled", "manual"), "CONTROLLED_ACCESS") if access is not None else F.when(F.lit(False), "")
    kind = kind.when(path.rlike(r"/(api|resource|resources|rest|odata)(/|$)"), "API")
    data = path.rlike(r"\.(" + "|".join(DATA_FORMATS) + r")$")
    if media_type is not None:
        data = data | F.lower(media_type).rlike(r"(csv|json|parquet|zip|spreadsheet)")
    kind = kind.when(data, "DATA")
    kind = kind.when(path.rlike(r"dictionar"), "DATA_DICTIONARY")
    return kind.when(path.rlike(r"(\.pdf$|methodolog|license|terms|release-?note|/docs?(/|$))"), "DOCUMENTATION").otherwise(
        "LANDING_PAGE"
    )


def route_resource(df: DataFrame, url: str, access: str | None = None, media_type: str | None = None) -> DataFrame:
    """Add ``resource_class`` and ``next_action``."""
    kind = resource_class(
        F.col(url), F.col(access) if access else None, F.col(media_type) if media_type else None
    )
    action = F.create_map(*[F.lit(x) for pair in ROUTES.items() for x in pair])
    return df.withColumn("resource_class", kind).withColumn("next_action", F.element_at(action, F.col("resource_class")))


def register_resources(datasets: DataFrame, dataset_id: str, distributions: str) -> DataFrame:
    """One row per distribution of a dataset record, in record order."""
    exploded = datasets.select(dataset_id, F.posexplode(distributions).alias("position", "resource_url"))
    return route_resource(exploded, "resource_url")


TRACKING = r"^(utm_[a-z]+|gclid|fbclid|msclkid|ref)(=|$)"


def canonical_url(url: Column) -> Column:
    """URL without scheme, ``www``/``m`` prefix, fragment, trailing slash and page suffix, host lower-cased.

    Of the query only tracking parameters go; the others stay, in order of their text.
    """
    whole = F.substring_index(url, "#", 1)
    address = F.substring_index(whole, "?", 1)
    asked = F.split(F.substr(whole, F.length(address) + 2), "&")
    asked = F.array_sort(F.filter(asked, lambda p: (p != "") & ~p.rlike(TRACKING)))
    query = F.when(F.size(asked) > 0, F.concat(F.lit("?"), F.array_join(asked, "&"))).otherwise("")
    bare = F.regexp_replace(address, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.substring_index(bare, "/", 1)), r"^(www|m)\.", "")
    path = F.regexp_replace(F.substr(bare, F.length(F.substring_index(bare, "/", 1)) + 1), r"(/|\.html?)+$", "")
    return F.concat(host, path, query)


def resolve_mirrors(resources: DataFrame, key: Column, id_column: str) -> DataFrame:
    """All observations with their ``canonical_key`` and the first observation of that key."""
    return dedupe_keep_observations(resources.withColumn("canonical_key", key), ["canonical_key"], [id_column], id_column)


def tokens(text: Column) -> Column:
    """Lower-case words: maximal runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def phrases(words: Column, size: int) -> Column:
    """Distinct runs of ``size`` consecutive words.

    Built by zipping the word list with itself shifted, so the text is split a fixed number of
    times and never once per word.
    """
    runs = words
    for shift in range(1, size):
        # The shifted list is shorter: its missing tail makes the last runs null.
        runs = F.zip_with(runs, F.slice(words, shift + 1, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(F.array_compact(runs))


def relevance_match(resources: DataFrame, id_column: str, fields: Sequence[str], terms: DataFrame) -> DataFrame:
    """Number of distinct search terms found in each resource's text fields.

    Terms and texts meet by equality on word runs, never by scanning every text for every term.
    The lengths of the word runs are those of the terms, whatever they are; only these few numbers come to the driver.
    A list of terms counted as small is broadcast, so the word runs of the texts are not shuffled.
    """
    wanted = terms.select(F.array_join(tokens(F.col("term")), " ").alias("phrase")).filter("phrase <> ''").distinct()
    sizes = sorted(r[0] for r in wanted.select(F.size(F.split("phrase", " ")).alias("n")).distinct().collect())
    if not sizes:
        return resources.select(id_column, F.lit(0).cast("bigint").alias("term_hits"))
    found = F.array_distinct(F.flatten(F.array(*[phrases(tokens(F.col(f)), n) for f in fields for n in sizes])))
    said = resources.select(id_column, F.explode(found).alias("phrase"))
    hits = said.join(broadcast_if_small(wanted), "phrase").groupBy(id_column).agg(F.count(F.lit(1)).alias("term_hits"))
    return resources.select(id_column).join(hits, id_column, "left").withColumn(
        "term_hits", F.coalesce(F.col("term_hits"), F.lit(0)).cast("bigint")
    )


def distinct_catalogs(resources: DataFrame, column: str) -> DataFrame:
    return resources.select(column).distinct()
