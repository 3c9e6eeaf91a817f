"""Queries: releases, discovery, artifacts, redaction, ledgers and sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.functions import digest, redact
from attestry.operators import console, discovery, history, quality, release
from attestry.operators.segments import spread
from attestry.plans.registry import Tables, query
from attestry.plans.review import queue
from attestry.sources import files, ledger, paged

# --- releases ---------------------------------------------------------------------------------

RELEASES_SQL = """
    releases AS (SELECT release_id, MAX(generated_at) AS loaded_at, COUNT(*) AS row_count FROM release_rows GROUP BY release_id),
    flagged AS (SELECT *, release_id = (SELECT MAX(release_id) FROM releases) AS is_current FROM releases)"""


def releases(t: Tables) -> DataFrame:
    registry = t.release_rows.groupBy("release_id").agg(
        F.max("generated_at").alias("loaded_at"), F.count(F.lit(1)).alias("row_count")
    )
    return ledger.newest_release(registry, "loaded_at")


@query(
    "current_release",
    f"WITH {RELEASES_SQL} SELECT r.release_id, record_key, generated_at FROM release_rows r JOIN flagged f ON f.release_id = r.release_id AND f.is_current",
    ["release_rows"],
)
def current_release(t: Tables) -> DataFrame:
    return release.current_rows(t.release_rows, releases(t)).select("release_id", "record_key", "generated_at")


@query(
    "current_source_metadata",
    f"""WITH {RELEASES_SQL} SELECT DISTINCT r.release_id, r.geometry_json AS source_key FROM release_rows r
        JOIN flagged f ON f.release_id = r.release_id AND f.is_current WHERE r.geometry_json IS NOT NULL""",
    ["release_rows"],
)
def current_source_metadata(t: Tables) -> DataFrame:
    sources = t.release_rows.filter("geometry_json IS NOT NULL").select("release_id", F.col("geometry_json").alias("source_key")).distinct()
    return release.current_rows(sources, releases(t))


@query("release_status", f"WITH {RELEASES_SQL} SELECT release_id, loaded_at, row_count, is_current FROM flagged", ["release_rows"])
def release_status(t: Tables) -> DataFrame:
    return release.release_status(releases(t)).select("release_id", "loaded_at", "row_count", "is_current")


@query(
    "validate_release",
    """WITH c AS (SELECT release_id, COUNT(*) AS row_count, COUNT(DISTINCT record_key) AS distinct_keys,
         COUNT(*) FILTER (length(CAST(record_key AS STRING)) > 5) AS invalid_keys,
         COUNT(*) FILTER (geometry_json IS NULL) AS missing_geometry FROM release_rows GROUP BY release_id)
       SELECT *, distinct_keys = row_count AND invalid_keys = 0 AND missing_geometry = 0 AS is_valid FROM c""",
    ["release_rows"],
)
def validate_release(t: Tables) -> DataFrame:
    return release.validate_release(
        t.release_rows, "record_key", bad_key=F.length(F.col("record_key").cast("string")) > 5
    )


@query(
    "replace_release",
    """SELECT CAST(EXTRACT(YEAR FROM o_orderdate) AS STRING) AS release_id, COUNT(*) AS row_count,
         COUNT(*) FILTER (o_orderstatus = 'F') AS finished,
         EXTRACT(YEAR FROM o_orderdate) = 1998 AS is_current
       FROM orders WHERE o_orderstatus = 'F' OR EXTRACT(YEAR FROM o_orderdate) <> 1997
       GROUP BY 1, EXTRACT(YEAR FROM o_orderdate) = 1998""",
)
def replace_release(t: Tables) -> DataFrame:
    """Load every release, load one of them again with other rows, move the pointer twice, read back."""
    from attestry.session import scratch_path

    root = scratch_path(t.spark, "release")
    rows = t.orders.select(F.year("o_orderdate").cast("string").alias("release_id"), "o_orderkey", "o_orderstatus")
    names = [r.release_id for r in rows.select("release_id").distinct().collect()]
    ledger.replace_releases(root, {"facts": rows}, names, current="1997")
    ledger.replace_release(root, "1997", {"facts": rows.filter("release_id = '1997' AND o_orderstatus = 'F'")})
    ledger.set_current(t.spark, root, "1998")
    loaded = ledger.read_release(t.spark, root, "facts")
    registry = loaded.groupBy("release_id").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("o_orderstatus") == "F").alias("finished")
    )
    return ledger.with_current_flag(registry, root)


COUNTIES_SQL = """
    counties AS (
      SELECT lpad(CAST(c_custkey AS STRING), 5, '0') AS fips, CASE WHEN c_acctbal < 500 THEN 'no_county_linked_record' ELSE 'linked' END AS human_status,
        CASE WHEN c_acctbal < 400 THEN NULL ELSE CAST(c_nationkey AS BIGINT) END AS case_count_floor_2023,
        CASE WHEN c_acctbal < 450 THEN NULL ELSE c_acctbal END AS incidence_floor_2023,
        c_acctbal / 95.0 AS default_score FROM customer
      UNION ALL SELECT 'S' || CAST(s_suppkey AS STRING), 'linked', NULL, NULL, s_acctbal / 95.0 FROM supplier
      UNION ALL SELECT lpad(CAST(n_nationkey AS STRING), 5, '0'), 'linked', 1, 1.0, 50.0 FROM nation)"""


def counties(t: Tables) -> DataFrame:
    body = COUNTIES_SQL.strip().removeprefix("counties AS (").removesuffix(")")
    return t.spark.sql(
        body.replace("FROM customer", "FROM {customer}").replace("FROM supplier", "FROM {supplier}").replace("FROM nation", "FROM {nation}"),
        customer=t.customer, supplier=t.supplier, nation=t.nation,
    )


@query(
    "bundle_checks",
    f"""WITH {COUNTIES_SQL}, m AS (SELECT COUNT(*) AS n, COUNT(DISTINCT fips) AS d,
          COUNT(*) FILTER (NOT regexp_full_match(fips, '[0-9]{{5}}')) AS bad,
          COUNT(*) FILTER (human_status = 'no_county_linked_record' AND (case_count_floor_2023 IS NOT NULL OR incidence_floor_2023 IS NOT NULL)) AS filled,
          COUNT(*) FILTER (NOT COALESCE(default_score BETWEEN 0 AND 100, FALSE)) AS score FROM counties),
        r AS (SELECT 'schema_version' AS rule_id, CAST(0 AS BIGINT) AS offences FROM m UNION ALL SELECT 'county_count', abs(n - 3144) FROM m
          UNION ALL SELECT 'unique_fips', n - d FROM m UNION ALL SELECT 'fips_format', bad FROM m
          UNION ALL SELECT 'missing_not_zero', filled FROM m UNION ALL SELECT 'score_range', score FROM m)
        SELECT rule_id, offences, offences = 0 AS passed FROM r""",
)
def bundle_checks(t: Tables) -> DataFrame:
    return release.bundle_checks(counties(t), "0.2.0")


@query(
    "missing_not_zero",
    f"""WITH {COUNTIES_SQL} SELECT fips, case_count_floor_2023, incidence_floor_2023 FROM counties
        WHERE human_status = 'no_county_linked_record' AND (case_count_floor_2023 IS NOT NULL OR incidence_floor_2023 IS NOT NULL)""",
)
def missing_not_zero(t: Tables) -> DataFrame:
    declared = F.col("human_status") == release.NO_RECORD_STATUS
    found = release.missing_not_zero(counties(t), declared, ["case_count_floor_2023", "incidence_floor_2023"])
    return found.select("fips", "case_count_floor_2023", "incidence_floor_2023")


@query("unique_key_offenders", "SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1")
def unique_key_offenders(t: Tables) -> DataFrame:
    return release.unique_key_offenders(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "unique_key_check",
    "SELECT COUNT(*) AS row_count, COUNT(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys, COUNT(*) = COUNT(DISTINCT (l_orderkey, l_linenumber)) AS is_unique FROM lineitem",
)
def unique_key_check(t: Tables) -> DataFrame:
    return release.unique_key_check(t.lineitem, ["l_orderkey", "l_linenumber"])


BUNDLE_FEATURES = """
    SELECT '{{"properties":{{"fips":"' || lpad(CAST(c_custkey AS STRING), 5, '0') || '","county":"' || c_name || '","state":"' || CAST(c_nationkey AS STRING)
        || '","population":' || CASE WHEN c_acctbal < 0 THEN 'null' ELSE CAST(CAST(FLOOR(c_acctbal) AS BIGINT) AS STRING) END
        || ',"in_contiguous_tick_scope":' || CASE WHEN c_acctbal > 5000 THEN 'true' ELSE 'false' END
        || ',"human_status":"' || c_mktsegment || '","evidence_completeness":' || CAST(c_nationkey AS STRING)
        || ',"default":{{"score":' || CAST(c_nationkey AS STRING) || ',"band":"b"}}}},"geometry":'
        || CASE WHEN c_mktsegment = 'MACHINERY' THEN '{{"type":"Polygon","coordinates":"broken"}}'
             WHEN c_mktsegment = 'BUILDING' THEN '{{"type":"Point","coordinates":[' || CAST(c_nationkey AS STRING) || ',2]}}'
             ELSE '{{"type":"Polygon","coordinates":[[[' || CAST(c_nationkey AS STRING) || ',0],[' || CAST(c_nationkey + 5 AS STRING) || ',0],['
                  || CAST(c_nationkey + 5 AS STRING) || ',7],[' || CAST(c_nationkey AS STRING) || ',0]]]}}' END || '}}' AS feature
    FROM {customer}"""


@query(
    "flatten_feature",
    """SELECT 'r1' AS release_id, lpad(CAST(c_custkey AS STRING), 5, '0') AS fips, c_name AS county,
         CASE WHEN c_acctbal >= 0 THEN CAST(FLOOR(c_acctbal) AS BIGINT) END AS population, c_acctbal > 5000 AS in_contiguous_tick_scope,
         c_mktsegment AS human_status, CAST(c_nationkey AS BIGINT) AS evidence_completeness,
         '{"band":"b","score":' || c_nationkey || '}' AS default_score,
         CASE c_mktsegment WHEN 'MACHINERY' THEN NULL WHEN 'BUILDING' THEN 'Point' ELSE 'Polygon' END AS geometry_type,
         CASE c_mktsegment WHEN 'MACHINERY' THEN NULL ELSE CAST(c_nationkey AS DOUBLE) END AS min_x,
         CASE c_mktsegment WHEN 'MACHINERY' THEN NULL WHEN 'BUILDING' THEN CAST(c_nationkey AS DOUBLE) ELSE c_nationkey + 5.0 END AS max_x,
         CASE c_mktsegment WHEN 'MACHINERY' THEN NULL WHEN 'BUILDING' THEN 2.0 ELSE 7.0 END AS max_y
       FROM customer""",
)
def flatten_feature(t: Tables) -> DataFrame:
    """Write the customers as a bundle of one feature per line, read it back, flatten and finalize it."""
    from attestry.session import scratch_path

    path = scratch_path(t.spark, "bundle")
    features = t.spark.sql(BUNDLE_FEATURES, customer=t.customer)
    documents = features.select(
        F.concat(F.lit('{"schema_version":"0.2.0","feature_collection":{"features":['), "feature", F.lit("]}}")).alias("value")
    )
    documents.write.text(path, compression="gzip")
    bundle = files.read_release_bundle(t.spark, path, lines=True)
    staged = release.flatten_features(files.bundle_features(bundle, "r1"))
    final = release.finalize_counties(staged)
    return final.select(
        "release_id", "fips", "county", "population", "in_contiguous_tick_scope", "human_status", "evidence_completeness",
        F.to_json("default_score").alias("default_score"),
        F.col("geography.type").alias("geometry_type"), "geography.min_x", "geography.max_x", "geography.max_y",
    )


# --- discovery --------------------------------------------------------------------------------

# Catalogs are regions, groups are brands, terms are part names (with and without capitals).
TERMS = """
    SELECT p_brand AS group_id, p_partkey AS term_order, CASE WHEN p_size < 25 THEN UPPER(p_name) ELSE p_name END AS term FROM {part}"""
REFERENCES = """
    SELECT r_name AS catalog_id, r_regionkey AS catalog_order, r_name <> 'AFRICA' AS enabled,
           CAST(SUBSTR(p_brand, 7) AS INT) AS group_order, p_brand AS group_id,
           LENGTH(p_brand) = 8 OR r_name IN ('AMERICA', 'EUROPE') AS group_enabled
    FROM {nation} n JOIN {region} r ON n.n_regionkey = r.r_regionkey
         JOIN (SELECT DISTINCT p_brand FROM {part}) b ON CAST(SUBSTR(p_brand, 7) AS INT) = n.n_nationkey + 1"""
PLAN_SQL = (
    "terms AS (" + TERMS.replace("{part}", "part") + "), refs AS ("
    + REFERENCES.replace("{nation}", "nation").replace("{region}", "region").replace("{part}", "part")
    + """), listed AS (
      SELECT catalog_id, catalog_order, group_order, term_order, lower(term) AS term_key, term
      FROM refs JOIN terms USING (group_id) WHERE enabled AND group_enabled),
    plan AS (
      SELECT catalog_id, catalog_order, term_key, arg_max(term, (group_order, term_order)) AS term,
             min((group_order, term_order)) AS place FROM listed GROUP BY ALL),
    numbered AS (SELECT *, ROW_NUMBER() OVER (ORDER BY catalog_order, place, term_key) AS request_sequence FROM plan)"""
)


def search_references(t: Tables) -> DataFrame:
    return t.spark.sql(REFERENCES, nation=t.nation, region=t.region, part=t.part)


def search_terms(t: Tables) -> DataFrame:
    return t.spark.sql(TERMS, part=t.part)


def search_plan_rows(t: Tables) -> DataFrame:
    return discovery.number_requests(discovery.expand_search_plan(search_references(t), search_terms(t)))


@query(
    "search_plan",
    f"""WITH {PLAN_SQL} SELECT request_sequence, catalog_id, term,
          'catalog:' || lower(catalog_id) || ':' || left(sha256(term_key), 16) AS resource_key,
          'https://catalog.example.org/' || lower(catalog_id) || '?rows=100&q=' || replace(term, ' ', '+') AS url FROM numbered""",
)
def search_plan(t: Tables) -> DataFrame:
    endpoint = F.concat(F.lit("https://catalog.example.org/"), F.lower("catalog_id"))
    fixed = F.create_map(F.lit("rows"), F.lit("100"))
    return search_plan_rows(t).select(
        "request_sequence",
        "catalog_id",
        "term",
        digest.catalog_resource_key(F.col("catalog_id"), F.col("term")).alias("resource_key"),
        discovery.request_url(endpoint, fixed, F.lit("q"), F.col("term")).alias("url"),
    )


@query("search_plan_first", f"WITH {PLAN_SQL} SELECT request_sequence, catalog_id, term FROM numbered WHERE request_sequence <= 40")
def search_plan_first(t: Tables) -> DataFrame:
    return discovery.first_requests(search_plan_rows(t), 40).select("request_sequence", "catalog_id", "term")


@query(
    "search_config_checks",
    f"""WITH {PLAN_SQL} SELECT DISTINCT 'missing_or_empty_group' AS violation, catalog_id, group_id FROM refs
        WHERE group_id NOT IN (SELECT p_brand FROM part WHERE p_size > 49 AND p_name IS NOT NULL)
        UNION ALL SELECT 'unsupported_schema_version', NULL, NULL FROM region WHERE r_name <> 'ASIA'""",
)
def search_config_checks(t: Tables) -> DataFrame:
    versions = t.region.select(F.when(F.col("r_name") == "ASIA", "1.0").otherwise("0.9").alias("schema_version"))
    # Every part is a row of its group; only large ones carry a term, so some groups have rows and no term.
    terms = t.part.select(F.col("p_brand").alias("group_id"), F.when(F.col("p_size") > 49, F.col("p_name")).alias("term"))
    return discovery.search_config_checks(versions, search_references(t), terms)


@query(
    "enabled_groups",
    """SELECT s_suppkey, list_sort(list(DISTINCT p_brand)) AS brands, list_filter(list_sort(list(DISTINCT p_brand)), lambda b: b IN ('Brand#1', 'Brand#3', 'Brand#7')) AS enabled
       FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey GROUP BY s_suppkey""",
)
def enabled_groups(t: Tables) -> DataFrame:
    # The list per supplier is bounded by the number of brands, not by the lines.
    pairs = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).join(
        t.supplier, F.col("s_suppkey") == F.col("l_suppkey")
    ).select("s_suppkey", "p_brand").distinct()
    listed = pairs.groupBy("s_suppkey").agg(F.sort_array(F.collect_list("p_brand")).alias("brands"))
    wanted = F.array(*[F.lit(b) for b in ("Brand#1", "Brand#3", "Brand#7")])
    return listed.withColumn("enabled", discovery.enabled_catalog_groups(wanted, F.col("brands")))


@query("distinct_catalogs", "SELECT DISTINCT source FROM documents")
def distinct_catalogs(t: Tables) -> DataFrame:
    return discovery.distinct_catalogs(t.documents, "source")


CANONICAL = r"regexp_replace(lower(split_part(bare, '/', 1)), '^(www|m)\.', '') || regexp_replace(substr(bare, length(split_part(bare, '/', 1)) + 1), '(/|\.html?)+$', '')"
MIRROR_KEY = r"regexp_replace(regexp_replace(canonical, '^[^/]*?([^./]+\.[^./]+)/', '\1/'), '/[0-9]+($|\?)', '\1')"


@query(
    "mirrors",
    f"""WITH u AS (SELECT page_id, split_part(url, '#', 1) AS whole, split_part(split_part(url, '#', 1), '?', 1) AS address FROM pages),
        b AS (SELECT page_id, regexp_replace(address, '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare,
                list_sort(list_filter(string_split(substr(whole, length(address) + 2), '&'),
                  lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|gclid|fbclid|msclkid|ref)(=|$)'))) AS asked FROM u),
        c AS (SELECT page_id, {CANONICAL} || CASE WHEN len(asked) > 0 THEN '?' || array_to_string(asked, '&') ELSE '' END AS canonical FROM b), k AS (SELECT page_id, {MIRROR_KEY} AS canonical_key FROM c)
        SELECT page_id, canonical_key, MIN(page_id) OVER (PARTITION BY canonical_key) AS canonical_id,
               COUNT(*) OVER (PARTITION BY canonical_key) AS n_observations,
               page_id = MIN(page_id) OVER (PARTITION BY canonical_key) AS is_canonical FROM k""",
)
def mirrors(t: Tables) -> DataFrame:
    canonical = discovery.canonical_url(F.col("url"))
    key = F.regexp_replace(F.regexp_replace(canonical, r"^[^/]*?([^./]+\.[^./]+)/", "$1/"), r"/[0-9]+($|\?)", "$1")
    return discovery.resolve_mirrors(t.pages.select("page_id", "url"), key, "page_id").drop("url")


ROUTE_SQL = r"""
    CASE WHEN regexp_matches(path, '/(api|resource|resources|rest|odata)(/|$)') THEN 'API'
      WHEN regexp_matches(path, '\.(csv|json|geojson|parquet|xlsx|zip)$') THEN 'DATA' WHEN regexp_matches(path, 'dictionar') THEN 'DATA_DICTIONARY'
      WHEN regexp_matches(path, '(\.pdf$|methodolog|license|terms|release-?note|/docs?(/|$))') THEN 'DOCUMENTATION' ELSE 'LANDING_PAGE' END"""
ACTION_SQL = """CASE resource_class WHEN 'API' THEN 'CAPTURE_METADATA_AND_SAMPLE' WHEN 'DATA' THEN 'CAPTURE_HEADERS_AND_SAMPLE'
    WHEN 'LANDING_PAGE' THEN 'RECORD_RESEARCH_LEAD' WHEN 'CONTROLLED_ACCESS' THEN 'RECORD_LIMITATION' ELSE 'STORE_DOCUMENT' END"""


@query(
    "route_resource",
    f"""WITH u AS (SELECT p_partkey, p_type = 'STANDARD' AS controlled, 'https://data.example.org/' || replace(p_name, ' ', '/') ||
             CASE WHEN p_size < 10 THEN '/api/v1' WHEN p_size < 20 THEN '.CSV?x=1' WHEN p_size < 25 THEN '/dictionary' WHEN p_size < 30 THEN '/docs/a.pdf' ELSE '' END AS url FROM part),
        r AS (SELECT *, lower(split_part(split_part(url, '?', 1), '#', 1)) AS path FROM u),
        c AS (SELECT p_partkey, url, CASE WHEN controlled THEN 'CONTROLLED_ACCESS' ELSE {ROUTE_SQL} END AS resource_class FROM r)
        SELECT *, {ACTION_SQL} AS next_action FROM c""",
)
def route_resource(t: Tables) -> DataFrame:
    size = F.col("p_size")
    tail = F.when(size < 10, "/api/v1").when(size < 20, ".CSV?x=1").when(size < 25, "/dictionary").when(size < 30, "/docs/a.pdf").otherwise("")
    urls = t.part.select(
        "p_partkey",
        F.concat(F.lit("https://data.example.org/"), F.replace("p_name", F.lit(" "), F.lit("/")), tail).alias("url"),
        F.when(F.col("p_type") == "STANDARD", "Restricted").alias("access"),
    )
    return discovery.route_resource(urls, "url", access="access").drop("access")


@query(
    "register_resources",
    f"""WITH l AS (SELECT page_id, regexp_extract_all(html, 'href="([^"]+)"', 1) AS links FROM pages),
        e AS (SELECT page_id, unnest(links) AS resource_url, generate_subscripts(links, 1) - 1 AS position FROM l),
        r AS (SELECT *, lower(split_part(split_part(resource_url, '?', 1), '#', 1)) AS path FROM e),
        c AS (SELECT page_id, CAST(position AS INT) AS position, resource_url, {ROUTE_SQL} AS resource_class FROM r)
        SELECT *, {ACTION_SQL} AS next_action FROM c""",
)
def register_resources(t: Tables) -> DataFrame:
    links = t.pages.select("page_id", F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1)).alias("links"))
    return discovery.register_resources(links, "page_id", "links")


@query(
    "relevance",
    r"""WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS words FROM documents),
        b AS (SELECT list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS words FROM benchmark),
        terms AS (SELECT DISTINCT unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS phrase FROM b),
        said AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS phrase FROM d),
        hits AS (SELECT doc_id, COUNT(*) AS n FROM said JOIN terms USING (phrase) GROUP BY doc_id)
        SELECT doc_id, COALESCE(n, 0) AS term_hits FROM documents LEFT JOIN hits USING (doc_id)""",
)
def relevance(t: Tables) -> DataFrame:
    """Two-word search terms (every word pair of the benchmark texts) against whole document texts."""
    terms = t.benchmark.select(F.explode(discovery.phrases(discovery.tokens(F.col("text")), 2)).alias("term"))
    return discovery.relevance_match(spread(t.documents.select("doc_id", "text")), "doc_id", ["text"], terms)


# --- artifacts and redaction ------------------------------------------------------------------


def artifacts(t: Tables) -> DataFrame:
    return ledger.register_artifacts(
        t.documents.select("doc_id", "source", "lang", "text"), "text",
        environment=F.lit("dev"), resource_key=F.col("source"), run=F.col("lang"), kind="DOCUMENT", media_type="text/plain",
    )


@query(
    "artifact_registry",
    """WITH a AS (SELECT doc_id, sha256(text) AS sha256, CAST(octet_length(encode(text)) AS BIGINT) AS byte_count,
             'dev/' || source || '/' || lang || '/' || sha256(text) || '.bin' AS artifact_uri FROM documents)
       SELECT *, MIN(doc_id) OVER (PARTITION BY sha256) AS canonical_id, COUNT(*) OVER (PARTITION BY sha256) AS n_observations,
              doc_id = MIN(doc_id) OVER (PARTITION BY sha256) AS is_canonical FROM a""",
)
def artifact_registry(t: Tables) -> DataFrame:
    marked = history.dedupe_keep_observations(artifacts(t), ["sha256"], ["doc_id"], "doc_id")
    return marked.select("doc_id", "sha256", "byte_count", "artifact_uri", "canonical_id", "n_observations", "is_canonical")


_LIST = "sha256(string_agg(pos || ':' || d, chr(10) ORDER BY pos, d))"


@query(
    "manifest",
    f"""WITH p AS (SELECT DISTINCT ingestion_run_id AS run, request_sequence AS page, sha256(text) AS d, left(sha256(text), 2) AS pos FROM turns),
        n AS (SELECT run, COUNT(*) AS artifact_count FROM p GROUP BY 1),
        prefixes AS (SELECT run, page, pos, {_LIST} AS d FROM p GROUP BY ALL),
        pages AS (SELECT run, page AS pos, {_LIST.replace("pos", "prefixes.pos")} AS d FROM prefixes GROUP BY run, page),
        blocks AS (SELECT run, CAST(floor(pages.pos / 1024) AS BIGINT) AS pos, {_LIST.replace("pos", "pages.pos")} AS d FROM pages GROUP BY 1, 2),
        wide AS (SELECT run, CAST(floor(blocks.pos / 1024) AS BIGINT) AS pos, {_LIST.replace("pos", "blocks.pos")} AS d FROM blocks GROUP BY 1, 2),
        whole AS (SELECT run, {_LIST} AS manifest_sha256 FROM wide GROUP BY run)
        SELECT run AS ingestion_run_id, artifact_count, manifest_sha256 FROM n JOIN whole USING (run)""",
    ["turns"],
)
def manifest(t: Tables) -> DataFrame:
    pages = t.turns.withColumn("sha256", digest.sha256_hex(F.col("text")))
    return ledger.build_manifest(pages, "ingestion_run_id", "request_sequence", "sha256")


# Fixed value: the credential pattern.
PATTERN = r"(?i)((?:token|secret|password|private[_ -]?key|authorization)\s*[=:]\s*)\S+"


@query(
    "redact_text",
    rf"""SELECT doc_id, sha256(masked) AS masked_sha256, CAST(length(masked) AS BIGINT) AS masked_chars,
           CAST(least(length(masked), 4000) AS BIGINT) AS message_chars
         FROM (SELECT doc_id, regexp_replace(text, '{PATTERN}', '\1[REDACTED]', 'g') AS masked FROM documents)""",
)
def redact_text(t: Tables) -> DataFrame:
    masked = redact.redact_text(F.col("text"), limit=None)
    return spread(t.documents.select("doc_id", "text")).select(
        "doc_id",
        digest.sha256_hex(masked).alias("masked_sha256"),
        F.length(masked).cast("bigint").alias("masked_chars"),
        F.length(redact.redact_text(F.col("text"))).cast("bigint").alias("message_chars"),
    )


@query(
    "secret_scan",
    rf"""WITH s AS (SELECT doc_id, 'text' AS column_name, len(regexp_extract_all(text, '{PATTERN}')) AS hits FROM documents
             UNION ALL SELECT doc_id, 'source', len(regexp_extract_all(source, '{PATTERN}')) FROM documents)
         SELECT doc_id, column_name, CAST(hits AS BIGINT) AS hits FROM s WHERE hits > 0""",
)
def secret_scan(t: Tables) -> DataFrame:
    return quality.secret_scan(spread(t.documents.select("doc_id", "text", "source")), "doc_id", ["text", "source"])


@query(
    "redact_map",
    """WITH p AS (SELECT page_id, split_part(url, '?', 1) AS endpoint, string_split(split_part(split_part(url, '#', 1), '?', 2), '&') AS pairs FROM pages)
       SELECT page_id, endpoint, array_to_string(list_transform(list_filter(pairs, lambda x: x <> ''),
         lambda x: split_part(x, '=', 1) || '=' || CASE WHEN lower(split_part(x, '=', 1)) IN ('token','secret','password','authorization','x-api-key','x-app-token','ref','sid')
           THEN '[REDACTED]' ELSE split_part(x, '=', 2) END), '&') AS parameters FROM p""",
)
def redact_map(t: Tables) -> DataFrame:
    bare = F.substring_index("url", "#", 1)
    text = F.when(F.instr(bare, "?") > 0, F.substring_index(bare, "?", -1))
    pairs = F.when(text != "", F.str_to_map(text, F.lit("&"), F.lit("=")))
    masked = F.map_entries(redact.redact_map(pairs, extra_names=("ref", "SID")))
    shown = F.array_join(F.transform(masked, lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("")))), "&")
    return t.pages.select(
        "page_id", redact.strip_query(F.col("url")).alias("endpoint"), F.coalesce(shown, F.lit("")).alias("parameters")
    )


@query("strip_query", "SELECT page_id, split_part(url, '?', 1) AS endpoint FROM pages")
def strip_query(t: Tables) -> DataFrame:
    return t.pages.select("page_id", redact.strip_query(F.col("url")).alias("endpoint"))


@query(
    "resource_keys",
    "SELECT p_partkey, 'catalog:' || lower(p_brand) || ':' || left(sha256(lower(p_name)), 16) AS resource_key FROM part",
)
def resource_keys(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey", digest.catalog_resource_key(F.col("p_brand"), F.when(F.col("p_size") > 20, F.upper("p_name")).otherwise(F.col("p_name"))).alias("resource_key")
    )


@query(
    "canonical_json",
    """SELECT o_orderkey, '{"a":{"x":[' || o_custkey || ',null],"y":"' || o_orderstatus || '"},"b":"' || o_orderpriority || '"}' AS canonical,
         sha256('{"a":{"x":[' || o_custkey || ',null],"y":"' || o_orderstatus || '"},"b":"' || o_orderpriority || '"}') AS digest FROM orders""",
)
def canonical_json(t: Tables) -> DataFrame:
    text = F.concat(
        F.lit('{ "b" : "'), "o_orderpriority", F.lit('", "a": {"y":"'), "o_orderstatus", F.lit('", "x": ['), F.col("o_custkey").cast("string"), F.lit(", null]}}")
    )
    canonical = digest.canonical_json(text)
    return t.orders.select("o_orderkey", canonical.alias("canonical"), digest.sha256_hex(canonical).alias("digest"))


@query("observed_fields", "SELECT k AS field_name, COUNT(*) AS n_records FROM (SELECT unnest(json_keys(payload)) AS k FROM surveillance) GROUP BY 1", ["surveillance"])
def observed_fields(t: Tables) -> DataFrame:
    return quality.observed_fields(t.surveillance.withColumn("payload", F.parse_json("payload")), "payload")


@query(
    "observed_schema",
    """WITH k AS (SELECT payload, unnest(json_keys(payload)) AS key FROM surveillance),
       t AS (SELECT DISTINCT key, CASE json_type(payload, '$.' || key) WHEN 'VARCHAR' THEN 'STRING' WHEN 'UBIGINT' THEN 'BIGINT' END AS kind FROM k),
       m AS (SELECT key, CASE WHEN COUNT(kind) > 1 THEN 'VARIANT' ELSE MAX(kind) END AS kind FROM t GROUP BY key)
       SELECT 'OBJECT<' || string_agg(key || ': ' || kind, ', ' ORDER BY key) || '>' AS observed_schema FROM m""",
    ["surveillance"],
)
def observed_schema(t: Tables) -> DataFrame:
    return quality.observed_schema(t.surveillance.withColumn("payload", F.parse_json("payload")), "payload")


@query(
    "missing_required_fields",
    """SELECT f AS field_name FROM (SELECT unnest(['fips', 'year', 'case_status', 'frequency', 'county', 'k']) AS f)
       WHERE f NOT IN (SELECT unnest(json_keys(payload)) FROM surveillance)""",
    ["surveillance"],
)
def missing_required_fields(t: Tables) -> DataFrame:
    seen = observed_fields(t)
    return quality.missing_required(seen, ["fips", "year", "case_status", "frequency", "county", "k"])


@query(
    "schema_fingerprint",
    """SELECT schema_snapshot_id, CAST(COUNT(*) AS INT) AS field_count,
         sha256('[' || string_agg('{"position":' || position || ',"field_name":"' || field_name || '","data_type":"' || data_type || '"}', ',' ORDER BY position, field_name) || ']') AS fingerprint
       FROM schema_fields GROUP BY schema_snapshot_id""",
    ["schema_fields"],
)
def schema_fingerprint(t: Tables) -> DataFrame:
    # A snapshot's field list is bounded by the width of a source table.
    fields = t.schema_fields.groupBy("schema_snapshot_id").agg(
        F.array_sort(F.collect_list(F.struct("position", "field_name", "data_type"))).alias("fields")
    )
    return fields.select(
        "schema_snapshot_id", F.size("fields").alias("field_count"), digest.schema_fingerprint(F.col("fields")).alias("fingerprint")
    )


@query(
    "profile_contract",
    """SELECT source_access_profile_id, 'deterministic_order_required' AS violation FROM profile_events
       WHERE deterministic_order_clause IS DISTINCT FROM ':id ASC'
       UNION ALL SELECT source_access_profile_id, 'resource_key_required' FROM profile_events WHERE resource_key IS NULL""",
    ["profile_events"],
)
def profile_contract(t: Tables) -> DataFrame:
    return quality.profile_contract(t.profile_events)


# --- ledgers and sources ----------------------------------------------------------------------


def _raw(df: DataFrame, batch_id: str | None = None) -> DataFrame:
    return ledger.raw_rows(
        df, "props",
        version=F.col("user_id").cast("string"), run=F.date_format("ts", "yyyy-MM-dd"), artifact=F.col("event_type"),
        source_url=F.lit("https://data.example.org/events?secret=1"), record_id=F.col("event_id").cast("string"),
        retrieved_at=F.col("ts"), batch_id=batch_id,
    )


RAW_SQL = """SELECT CAST(user_id AS STRING) AS data_source_version_id, CAST(event_id AS STRING) AS source_record_id,
       sha256(replace(props, ' ', '')) AS source_row_hash, strftime(ts, '%Y-%m-%d') AS ingestion_run_id,
       'https://data.example.org/events' AS source_url FROM events"""
RAW_OUTPUT = "data_source_version_id source_record_id source_row_hash ingestion_run_id source_url".split()


@query("append_raw", RAW_SQL)
def append_raw(t: Tables) -> DataFrame:
    return _raw(t.events).select(*RAW_OUTPUT)


@query("append_raw_idempotent", RAW_SQL)
def append_raw_idempotent(t: Tables) -> DataFrame:
    """Load a part, then everything, then everything again: each record is there once."""
    from attestry.session import scratch_path

    root = scratch_path(t.spark, "raw")
    for batch_id, rows in (("b1", t.events.filter("value < 50")), ("b2", t.events), ("b3", t.events)):
        ledger.append_raw_idempotent(_raw(rows, batch_id), root, "raw", batch_id)
    return ledger.read_ledger(t.spark, root, "raw").select(*RAW_OUTPUT)


@query(
    "append_ledger",
    """SELECT c.conv_id AS ingestion_run_id, COUNT(*) AS n_requests, COUNT(DISTINCT sha256(text)) AS n_digests FROM conversations c GROUP BY 1""",
)
def append_ledger(t: Tables) -> DataFrame:
    """Runs and their requests as one unit; a second unit that is never published stays invisible."""
    from attestry.session import scratch_path

    root = scratch_path(t.spark, "ledger")
    runs = t.turns.select("ingestion_run_id").distinct()
    requests = t.turns.select("ingestion_run_id", "request_sequence", digest.sha256_hex(F.col("text")).alias("response_sha256"))
    ledger.append_ledger(root, "unit-1", {"ingestion_runs": runs, "ingestion_requests": requests})
    dead = requests.withColumn("batch_id", F.lit("unit-2")).withColumn("attempt", F.lit("dead"))
    dead.write.mode("append").partitionBy("batch_id", "attempt").parquet(f"{root}/ingestion_requests")
    seen = ledger.read_ledger(t.spark, root, "ingestion_requests").groupBy("ingestion_run_id").agg(
        F.count(F.lit(1)).alias("n_requests"), F.count_distinct("response_sha256").alias("n_digests")
    )
    return ledger.read_ledger(t.spark, root, "ingestion_runs").select("ingestion_run_id").join(seen, "ingestion_run_id")


@query(
    "close_run",
    """SELECT event_id AS ingestion_run_id, CASE WHEN event_type = 'error' THEN 'FAILED' WHEN value < 200 THEN 'COMPLETED' ELSE 'RUNNING' END AS status FROM events""",
)
def close_run(t: Tables) -> DataFrame:
    """RUNNING rows, then closing rows in a later batch; the last status of each run counts."""
    from attestry.session import scratch_path

    root = scratch_path(t.spark, "status")
    ok = t.events.filter("event_type <> 'error' AND value < 200")
    batches = {
        "1-open": ledger.close_run(F.col("event_id"), "RUNNING", F.col("ts"), t.events),
        "2-done": ledger.close_run(F.col("event_id"), "COMPLETED", F.col("ts") + F.expr("interval 1 hour"), ok),
        "3-fail": ledger.close_run(F.col("event_id"), "FAILED", F.col("ts") + F.expr("interval 2 hours"), t.events.filter("event_type = 'error'")),
    }
    for batch_id, rows in batches.items():
        ledger.append_ledger(root, batch_id, {"run_status": rows})
    status = ledger.read_ledger(t.spark, root, "run_status")
    return history.current_status(status, "ingestion_run_id", "at", "batch_id").select("ingestion_run_id", "status")


@query("ordered_sample", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 25")
def ordered_sample(t: Tables) -> DataFrame:
    return quality.ordered_sample(t.orders, "o_orderkey").select("o_orderkey", "o_custkey", "o_orderstatus")


@query(
    "direct_file",
    "SELECT kind, c_custkey, c_name, c_acctbal FROM customer, (SELECT unnest(['csv', 'json', 'parquet']) AS kind)",
)
def direct_file(t: Tables) -> DataFrame:
    """The customers written as CSV, JSON and Parquet, read back as direct files with their origin."""
    from attestry.session import scratch_path

    root = scratch_path(t.spark, "direct")
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal")
    rows.write.option("header", True).csv(f"{root}/csv")
    rows.write.json(f"{root}/json")
    rows.write.parquet(f"{root}/parquet")
    schema = "c_custkey bigint, c_name string, c_acctbal double"
    parts = []
    for kind in ("csv", "json", "parquet"):
        df = files.read_direct_file(t.spark, f"{root}/{kind}", kind, None if kind == "parquet" else schema)
        checked = df.filter(F.col("source_file").contains(f"/{kind}/") & (F.col("source_file_bytes") > 0))
        parts.append(checked.select(F.lit(kind).alias("kind"), "c_custkey", "c_name", "c_acctbal"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "paged_source",
    """SELECT day(ts) AS page_sequence, event_id, event_type, COUNT(*) OVER (PARTITION BY day(ts)) AS page_rows FROM events""",
)
def paged_source(t: Tables) -> DataFrame:
    """Events laid out as numbered pages of JSON, read through the paged data source."""
    from attestry.session import scratch_path

    path = scratch_path(t.spark, "pages").removeprefix("file:")
    t.events.select(F.dayofmonth("ts").alias("page"), "event_id", "event_type").repartition("page").write.partitionBy("page").json(path)
    paged.register(t.spark)
    record = F.from_json("record", "event_id bigint, event_type string")
    rows = t.spark.read.format("paged_json").load(path).withColumn("r", record)
    return rows.select("page_sequence", "r.event_id", "r.event_type", "page_rows")


@query(
    "export_summary",
    """SELECT resource_key, resource_type, catalog_name FROM queue""",
    ["resources", "datasets", "decisions", "changes", "components", "scored", "assessments", "latest_assessment", "queue"],
)
def export_summary(t: Tables) -> DataFrame:
    """The queue with a payload column, exported as CSV and read back: the payload is gone."""
    from attestry.session import scratch_path

    path = scratch_path(t.spark, "export")
    waiting = queue(t).select("resource_key", "resource_type", "catalog_name", F.lit("{}").alias("resource_payload"))
    console.export_summary(waiting, path)
    return t.spark.read.option("header", True).schema("resource_key bigint, resource_type string, catalog_name string").csv(path)


# --- units of work ----------------------------------------------------------------------------


@query(
    "record_discovery",
    f"""WITH {PLAN_SQL}, r AS (SELECT request_sequence, catalog_id, term, term_key, contains(term_key, 'red ') AS failed,
            '{{"n":' || request_sequence || ',"term":"' || term || '"}}' AS payload FROM numbered)
        SELECT request_sequence, 'https://catalog.example.org/' || lower(catalog_id) AS endpoint,
          '{{"X-Api-Key":"[REDACTED]","catalog_id":"' || catalog_id || '","term":"' || term || '"}}' AS redacted_request,
          CAST(CASE WHEN failed THEN 503 ELSE 200 END AS BIGINT) AS status_code,
          CASE WHEN NOT failed THEN sha256(payload) END AS response_sha256, CASE WHEN NOT failed THEN CAST(length(payload) AS BIGINT) END AS byte_count,
          CASE WHEN NOT failed THEN 'dev/catalog:' || lower(catalog_id) || ':' || left(sha256(term_key), 16) || '/run-1/' || sha256(payload) || '.bin' END AS artifact_uri,
          'PARTIAL' AS run_status FROM r""",
)
def record_discovery(t: Tables) -> DataFrame:
    """A discovery run over the search plan, some requests failed, written as one unit and read back."""
    from attestry.session import scratch_path
    from attestry.sources import acquire

    root = scratch_path(t.spark, "discovery")
    numbered_plan = search_plan_rows(t)
    endpoint = F.concat(F.lit("https://catalog.example.org/"), F.lower("catalog_id"))
    failed = F.contains(F.col("term_key"), F.lit("red "))
    body = F.to_json(F.struct(F.col("term"), F.col("request_sequence").alias("n")))
    responses = numbered_plan.withColumns(
        {
            "url": discovery.request_url(endpoint, F.create_map(F.lit("rows"), F.lit("100")), F.lit("q"), F.col("term")),
            "headers": F.create_map(F.lit("X-Api-Key"), F.lit("k-123")),
            "status_code": F.when(failed, 503).otherwise(200),
            "response": F.when(~failed, body),
        }
    ).drop("request_sequence")
    tables = acquire.discovery_tables(responses, "run-1", "0" * 64, "dev", F.current_timestamp(), F.current_timestamp())
    ledger.append_ledger(root, "run-1", tables)
    runs = ledger.read_ledger(t.spark, root, "ingestion_runs").withColumn("at", F.coalesce("completed_at", "started_at"))
    status = history.current_status(runs, "ingestion_run_id", "at", "step").select("ingestion_run_id", F.col("status").alias("run_status"))
    artifacts = ledger.read_ledger(t.spark, root, "raw_artifacts").select("ingestion_request_id", "byte_count", "artifact_uri")
    requests = ledger.read_ledger(t.spark, root, "ingestion_requests").join(artifacts, "ingestion_request_id", "left").join(status, "ingestion_run_id")
    return requests.select(
        "request_sequence", "endpoint", F.to_json("redacted_request").alias("redacted_request"), "status_code", "response_sha256",
        "byte_count", "artifact_uri", "run_status",
    )


@query(
    "collect_evidence",
    """WITH s AS (SELECT user_id, event_id, '{"event_type":"' || event_type || '","k":' || json_extract_string(props, '$.k') || '}' AS record,
             ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
       g AS (SELECT user_id, COUNT(*) AS sample_rows, sha256('[' || string_agg(record, ',' ORDER BY n) || ']') AS sample_sha256 FROM s WHERE n <= 25 GROUP BY 1),
       c AS (SELECT c_custkey AS resource_key, c_mktsegment, CASE WHEN c_acctbal >= 0 THEN '{"name":"' || c_name || '"}' END AS document FROM customer)
       SELECT resource_key, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'NO_DETERMINISTIC_ORDER' WHEN document IS NULL THEN 'METADATA_MISSING'
                WHEN sample_rows IS NULL THEN 'SAMPLE_EMPTY' END AS refusal,
              CASE WHEN c_mktsegment <> 'MACHINERY' AND document IS NOT NULL AND sample_rows IS NOT NULL THEN sample_rows END AS sample_rows,
              CASE WHEN c_mktsegment <> 'MACHINERY' AND document IS NOT NULL AND sample_rows IS NOT NULL THEN sample_sha256 END AS sample_sha256,
              CASE WHEN c_mktsegment <> 'MACHINERY' AND document IS NOT NULL AND sample_rows IS NOT NULL THEN sha256(document) END AS metadata_sha256,
              CASE WHEN c_mktsegment <> 'MACHINERY' AND document IS NOT NULL AND sample_rows IS NOT NULL THEN 69.5 END AS overall_score
       FROM c LEFT JOIN g ON g.user_id = c.resource_key""",
)
def collect_evidence(t: Tables) -> DataFrame:
    """Evidence of every customer's source in one unit; refused sources keep their reason."""
    from attestry.session import scratch_path
    from attestry.sources import acquire

    root = scratch_path(t.spark, "evidence")
    record = F.to_json(F.struct(F.get_json_object("props", "$.k").cast("bigint").alias("k"), "event_type"))
    records = t.events.select(F.col("user_id").alias("resource_key"), F.col("event_id").alias("record_id"), record.alias("record"))
    metadata = t.customer.filter("c_acctbal >= 0").select(
        F.col("c_custkey").alias("resource_key"), F.to_json(F.struct(F.col("c_name").alias("name"))).alias("document")
    )
    profiles = t.customer.select(
        F.col("c_custkey").alias("resource_key"), F.lit(1).alias("profile_version"), F.lit("SODA").alias("connector_name"),
        F.lit("https://data.example.org/r.json?x=1").alias("endpoint_template"), F.lit("https://data.example.org/m").alias("metadata_endpoint_template"),
        F.when(F.col("c_mktsegment") != "MACHINERY", ":id ASC").alias("deterministic_order_clause"), F.lit("FULL_REFRESH").alias("incremental_strategy"),
    )
    scores = {n: F.lit(v) for n, v in {"relevance": 80, "joinability": 60, "accessibility": 90, "documentation": 40, "quality": 70}.items()}
    tables = acquire.evidence_tables(metadata, records, profiles, scores, "dev", F.lit("2024-02-01").cast("timestamp"), required=("k", "event_type"))
    ledger.append_ledger(root, "evidence-1", tables)

    def back(name: str) -> DataFrame:
        rows = ledger.read_ledger(t.spark, root, name)
        # Ledgers keep keys as text.
        return rows.withColumn("resource_key", F.col("resource_key").cast("bigint")) if "resource_key" in rows.columns else rows

    requests = back("ingestion_requests").join(back("ingestion_runs").select("ingestion_run_id", "resource_key"), "ingestion_run_id")
    sample = requests.filter("request_purpose = 'ORDERED_SOURCE_SAMPLE'").select(
        "resource_key", F.col("retrieved_row_count").alias("sample_rows"), F.col("response_sha256").alias("sample_sha256")
    )
    documents = back("source_document_snapshots").select("resource_key", F.col("content_sha256").alias("metadata_sha256"))
    assessed = back("dataset_quality_assessments").select("resource_key", F.col("overall_score").cast("double").alias("overall_score"))
    accepted = sample.join(documents, "resource_key").join(assessed, "resource_key")
    return accepted.unionByName(back("refused").select("resource_key", "refusal"), allowMissingColumns=True)
