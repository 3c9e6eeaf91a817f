"""Policy operators on hand-written rows: scoring, decisions, redaction, keys, configuration, bundles."""

from __future__ import annotations

import hashlib
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from attestry.functions import digest, redact, values
from attestry.operators import discovery, gate, history, quality, release
from attestry.schemas import DECISION_INPUT, LEDGERS
from attestry.sources import files, ledger

T0 = datetime(2026, 1, 1)


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


@pytest.mark.parametrize(
    ("scores", "total", "verdict"),
    [((70,) * 5, 70, "APPROVED"), ((50,) * 5, 50, "CONDITIONAL"), ((49,) * 5, 49, "REJECTED"), ((88, 62, 74, 91, 55), 74.2, "APPROVED"), ((61, 40, 83, 37, 72), 58.2, "CONDITIONAL")],
)
def test_scores(spark, scores, total, verdict):
    df = spark.createDataFrame([tuple(float(s) for s in scores)], [f"{n}_score" for n in values.WEIGHTS])
    row = values.score_sources(df).first()
    assert (float(row.overall_score), row.recommendation) == (total, verdict)


def test_recommendation_uses_the_unrounded_score(spark):
    df = spark.createDataFrame([(69.996,) * 5], [f"{n}_score" for n in values.WEIGHTS])
    row = values.score_sources(df).first()
    assert float(row.overall_score) == 70.0 and row.recommendation == "CONDITIONAL"


def test_artifact_identity(spark):
    df = spark.createDataFrame([("year,cases\n2019,37\n",)], ["content"])
    row = ledger.register_artifacts(
        df, "content", environment=F.lit("staging"), resource_key=F.lit("ticks-9"), run=F.lit("run-31"), kind="K", media_type="text/csv"
    ).first()
    want = hashlib.sha256(b"year,cases\n2019,37\n").hexdigest()
    assert (row.byte_count, row.sha256, row.artifact_uri) == (19, want, f"staging/ticks-9/run-31/{want}.bin")


def test_redaction(spark):
    pairs = F.create_map(*[F.lit(x) for x in ("x-API-Key", "k-481", "offset", "250")])
    url = F.create_map(F.lit("next"), F.lit("https://files.example.org/q?secret=s9"))
    row = one(
        spark,
        redact.redact_map(pairs).alias("m"),
        redact.redact_text(F.lit("retry with PASSWORD: hunter2 or private-key=MIIB, the token stays")).alias("t"),
        F.length(redact.redact_text(F.lit("long " * 1200))).alias("n"),
        redact.redact_values(url).alias("u"),
        redact.strip_query(F.lit("https://h/x?a=1?b")).alias("s"),
    )
    assert row.m == {"x-API-Key": "[REDACTED]", "offset": "250"}
    assert row.t == "retry with PASSWORD: [REDACTED] or private-key=[REDACTED] the token stays"
    assert row.n == 4000 and row.u == {"next": "https://files.example.org/q?secret=[REDACTED]"} and row.s == "https://h/x"


def test_resource_key_is_stable_and_hides_the_term(spark):
    def key(term):
        return one(spark, digest.catalog_resource_key(F.lit("DATA_GOV"), F.lit(term)).alias("k")).k

    assert key("Tick Bite") == key("TICK bite") and "tick" not in key("Tick Bite")
    assert key("straße") == "catalog:data_gov:" + hashlib.sha256("straße".casefold().encode()).hexdigest()[:16]
    assert key("ΣΑΣ") == "catalog:data_gov:" + hashlib.sha256("ΣΑΣ".casefold().encode()).hexdigest()[:16]


def test_form_encoding(spark):
    from urllib.parse import quote_plus

    text = "tick & mite * ~ü-_./?=%+"
    assert one(spark, digest.form_encode(F.lit(text)).alias("e")).e == quote_plus(text)


def test_canonical_json(spark):
    row = one(spark, digest.canonical_json(F.lit('{"b": [1, {"z": null, "a": "x"}], "a": true}')).alias("a"), digest.canonical_json(F.lit("{broken")).alias("b"))
    assert row.a == '{"a":true,"b":[1,{"a":"x","z":null}]}' and row.b is None


def batch(spark, *rows):
    return spark.createDataFrame(rows, DECISION_INPUT)


def decision(key="r", kind="APPROVED", why="good enough reason", conditions=None, who="ann", at=T0, ref="c1"):
    return (key, kind, why, conditions, who, "1", ref, at)


@pytest.mark.parametrize(
    ("row", "code"),
    [
        (decision(), None),
        (decision(kind="PUBLISH"), -20001),
        (decision(kind=None), -20001),
        (decision(why="12345"), -20002),
        (decision(why="1234567890"), None),
        (decision(why="   123456789   "), -20002),
        (decision(why="x" * 10_000), None),
        (decision(why="x" * 10_001), -20002),
        (decision(why=None), -20002),
        (decision(kind="DEFERRED"), -20003),
        (decision(kind="DEFERRED", conditions=[]), -20003),
        (decision(kind="DEFERRED", conditions=["  ", "\t", None]), -20003),
        (decision(kind="DEFERRED", conditions=["  ", "wait"]), None),
    ],
)
def test_decision_input(spark, row, code):
    assert gate.validate_decisions(batch(spark, row)).first().error_code == code


def facts(spark, **changes):
    base = {"document_count": 1, "schema_count": 1, "open_profile_count": 1, "blocking_count": 0, "assessment_status": "PENDING_REVIEW"}
    row = {"resource_key": "r", **base, **changes}
    return spark.createDataFrame([row], "resource_key string, document_count bigint, schema_count bigint, open_profile_count bigint, blocking_count bigint, assessment_status string")


@pytest.mark.parametrize(
    ("changes", "ready"),
    [({}, True), ({"document_count": 0}, False), ({"schema_count": 0}, False), ({"open_profile_count": 0}, False),
     ({"open_profile_count": 2}, False), ({"blocking_count": 1}, False), ({"assessment_status": "DRAFT"}, False), ({"assessment_status": None}, False)],
)
def test_prerequisites(spark, changes, ready):
    assert facts(spark, **changes).select(gate.prerequisites_met().alias("x")).first().x is ready


def stewards(spark):
    rows = [("ann", "GLOBAL", True), ("bob", "r", True), ("cid", "other", True), ("dan", "GLOBAL", False), ("eve", "GLOBAL", True), ("eve", "r", True)]
    return spark.createDataFrame(rows, "username string, authorization_scope string, is_active boolean")


def empty_ledger(spark):
    return spark.createDataFrame([], LEDGERS["manual_review_decisions"])


@pytest.mark.parametrize(("who", "n"), [("ann", 1), ("bob", 1), ("cid", 0), ("dan", 0), ("eve", 2), ("nobody", 0)])
def test_steward_matches(spark, who, n):
    assert gate.steward_matches(batch(spark, decision(who=who)), stewards(spark)).first().steward_count == n


def test_decisions_in_one_batch_supersede_each_other(spark):
    rows = batch(
        spark,
        decision(at=datetime(2026, 1, 1), ref="a"),
        decision(kind="DEFERRED", conditions=["later"], at=datetime(2026, 2, 1), ref="b"),
        decision(kind="APPROVED_WITH_CONDITIONS", conditions=["x"], at=datetime(2026, 3, 1), ref="c"),
        decision(who="cid", at=datetime(2026, 4, 1), ref="d"),
        decision(key="other", who="cid", ref="e"),
    )
    out = gate.apply_decisions(rows, stewards(spark), facts(spark), empty_ledger(spark))
    done = {r.correlation_id: r for r in out.decisions.collect()}
    assert set(done) == {"a", "b", "c"}
    assert done["a"].supersedes_decision_id is None
    assert done["b"].supersedes_decision_id == done["a"].manual_review_decision_id
    assert done["c"].supersedes_decision_id == done["b"].manual_review_decision_id
    assert done["b"].data_source_version_id is None
    versions = {r.approved_decision_id: r for r in out.versions.collect()}
    assert {v.status for v in versions.values()} == {"APPROVED", "CONDITIONAL"}
    assert versions[done["a"].manual_review_decision_id].data_source_version_id == done["a"].data_source_version_id
    assert {r.correlation_id: r.error_code for r in out.rejects.collect()} == {"d": -20004, "e": -20005}
    again = gate.apply_decisions(rows, stewards(spark), facts(spark), empty_ledger(spark))
    assert sorted(r.manual_review_decision_id for r in again.decisions.collect()) == sorted(r.manual_review_decision_id for r in done.values())


def test_unresolved_changes(spark):
    changes = spark.createDataFrame(
        [("a", "BREAKING", T0), ("b", "COMPATIBLE", T0), ("c", "IGNORED_WITH_JUSTIFICATION", T0), ("d", "BREAKING", T0), ("e", "BREAKING", T0)],
        "resource_key string, compatibility_outcome string, detected_at timestamp",
    )
    decided = spark.createDataFrame([("d", datetime(2026, 5, 1), "APPROVED_WITH_CONDITIONS"), ("e", datetime(2026, 5, 1), "DEFERRED")], "resource_key string, decided_at timestamp, decision string")
    assert sorted(r.resource_key for r in gate.unresolved_changes(changes, decided).collect()) == ["a", "e"]


def test_null_status_is_not_eligible(spark):
    none = F.lit(None).cast("string")
    row = one(spark, gate.is_eligible(none, none).alias("a"), gate.is_eligible(F.lit("APPROVED"), none).alias("b"), gate.is_eligible(F.lit("APPROVED"), F.lit("x")).alias("c"))
    assert (row.a, row.b, row.c) == (False, True, False)


def test_value_states(spark):
    records = [
        '{"fips": "01001", "frequency": 0}', '{"fips": "UNKNOWN", "frequency": "Suppressed"}', '{"fips": null, "frequency": "12"}',
        '{"frequency": "Not Reported"}', '{"fips": " unknown ", "frequency": "2.5", ":id": "x"}',
    ]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(records)], "i int, t string").withColumn("p", F.parse_json("t"))
    typed = values.type_payload(df, "p", {"fips": ("fips", "string"), "n": ("frequency", "decimal(38,0)"), "id": (":id", "string")})
    out = typed.select(
        "i", "n", "id", values.mark_value_states({"fips": F.col("fips")}).alias("m"),
        values.mark_value_states({"fips": F.col("fips")}, trimmed=True).alias("mt"),
        values.value_state(F.col("p"), "fips").alias("s"), values.value_state(F.col("p"), "frequency").alias("f"),
    ).orderBy("i").collect()
    assert [r.s for r in out] == ["VALUE", "UNKNOWN", "NULL", "MISSING", "VALUE"]
    assert [r.f for r in out] == ["ZERO", "SUPPRESSED", "VALUE", "NOT_REPORTED", "VALUE"]
    assert [None if r.n is None else int(r.n) for r in out] == [0, None, 12, None, 3]
    assert [r.m for r in out] == ["{}", '{"fips":"unknown"}', "{}", "{}", "{}"]
    assert out[4].mt == '{"fips":"unknown"}' and out[4].id == "x"


def test_supplied_marker_wins(spark):
    got = one(spark, values.mark_value_states({"a": F.lit("unknown")}, supplied=F.parse_json(F.lit('{"a":"kept"}'))).alias("m")).m
    assert got == '{"a":"kept"}'


def test_eras(spark):
    years = [1991, 1992, 2007, 2008, 2021, 2022, 2030, None]
    df = spark.createDataFrame([(y,) for y in years], "y int")
    assert [r.e for r in df.select(values.tag_era(F.col("y")).alias("e")).collect()] == [
        None, "1992-2007", "1992-2007", "2008-2021", "2008-2021", "2022-current", "2022-current", None]


def config(spark, tmp_path, **changes):
    doc = {
        "$schema_version": "1.0",
        "initially_enabled_term_group_ids": ["g1", "g2"],
        "catalogs": [
            {"catalog_id": "A", "enabled": True, "search_endpoint": "https://a/s", "search_parameter": "q", "fixed_query_parameters": {"per_page": "100"},
             "search_term_group_ids": ["g1", "g2", "g3"], "catalog_specific_terms": ["own term", "HEDGE"]},
            {"catalog_id": "B", "enabled": False, "search_endpoint": "https://b/s", "search_parameter": "q", "fixed_query_parameters": {},
             "search_term_group_ids": ["g1"], "catalog_specific_terms": []},
        ],
        "term_groups": [{"id": "g1", "terms": ["Hedge", "tick bite"]}, {"id": "g2", "terms": ["hedge", "deer tick"]}, {"id": "g3", "terms": ["off"]}],
        **changes,
    }
    path = tmp_path / "config.json"
    path.write_text(json.dumps(doc))
    return spark.read.schema(discovery.SEARCH_CONFIG_SCHEMA).option("multiLine", True).json(str(path))


def test_search_plan(spark, tmp_path):
    parts = discovery.config_relations(config(spark, tmp_path))
    terms = parts["groups"].select("group_id", F.posexplode("terms").alias("term_order", "term"))
    plan = discovery.number_requests(discovery.expand_search_plan(parts["references"], terms)).orderBy("request_sequence").collect()
    # The repeated term keeps its first place and its last spelling.
    assert [(r.request_sequence, r.catalog_id, r.term) for r in plan] == [(1, "A", "hedge"), (2, "A", "tick bite"), (3, "A", "deer tick")]
    wide = discovery.expand_search_plan(parts["references"], terms, parts["specific"])
    assert sorted(r.term for r in wide.collect()) == ["HEDGE", "deer tick", "own term", "tick bite"]
    header = parts["catalogs"].select("catalog_id", "search_endpoint", "search_parameter", "fixed_query_parameters")
    urls = discovery.expand_search_plan(parts["references"], terms).join(header, "catalog_id").select(
        discovery.request_url(F.col("search_endpoint"), F.col("fixed_query_parameters"), F.col("search_parameter"), F.col("term")).alias("u"))
    assert "https://a/s?per_page=100&q=tick+bite" in [r.u for r in urls.collect()]
    with pytest.raises(ValueError):
        discovery.first_requests(wide, 0)


def test_search_config_checks(spark, tmp_path):
    bad = config(spark, tmp_path, **{"$schema_version": "2.0", "term_groups": [{"id": "g1", "terms": ["x"]}, {"id": "g2", "terms": []}]})
    parts = discovery.config_relations(bad)
    terms = parts["groups"].select("group_id", F.explode("terms").alias("term"))
    found = discovery.search_config_checks(bad.select(F.col("`$schema_version`").alias("schema_version")), parts["references"], terms)
    assert sorted((r.violation, r.group_id or "") for r in found.collect()) == [
        ("missing_or_empty_group", "g2"), ("missing_or_empty_group", "g3"), ("unsupported_schema_version", "")]


def test_profile_contract(spark):
    rows = [("p1", "r", ":id ASC"), ("p2", "r", "name"), ("p3", " ", None)]
    df = spark.createDataFrame(rows, "source_access_profile_id string, resource_key string, deterministic_order_clause string")
    assert sorted(tuple(r) for r in quality.profile_contract(df).collect()) == [
        ("p2", "deterministic_order_required"), ("p3", "deterministic_order_required"), ("p3", "resource_key_required")]


def feature(fips="01001", score=50, status="linked", count=3, geometry=None):
    properties = {
        "fips": fips, "county": "C", "state": "AL", "state_name": "Alabama", "population": 10, "in_contiguous_tick_scope": True, "human_status": status,
        "case_count_floor_2023": count, "incidence_floor_2023": None if count is None else 1.5, "tick_status": "t", "burgdorferi_status": "b",
        "evidence_completeness": 4, "default": {"score": score, "note": "n"},
    }
    return {"type": "Feature", "properties": properties, "geometry": geometry or {"type": "Point", "coordinates": [1.5, 2]}}


def bundle(spark, tmp_path, *features, version="0.2.0"):
    import gzip

    doc = {"schema_version": version, "generated_at": "2026-08-06T05:37:16Z", "scope": "s", "score_defaults": {"w": 1},
           "sources": [{"key": "k", "label": "l", "vintage": "v", "url": "u", "note": "n"}], "feature_collection": {"features": list(features)}}
    path = tmp_path / "bundle.json.gz"
    path.write_bytes(gzip.compress(json.dumps(doc, indent=1).encode()))
    return files.read_release_bundle(spark, str(path))


def test_bundle_end_to_end(spark, tmp_path):
    doc = bundle(spark, tmp_path, feature("01001"), feature("01003", geometry={"type": "Polygon", "coordinates": "bad"}))
    rows = release.finalize_counties(release.flatten_features(files.bundle_features(doc, "r1"))).orderBy("fips").collect()
    assert [r.fips for r in rows] == ["01001", "01003"]
    assert rows[0].geography.min_x == 1.5 and rows[1].geography is None and rows[1].geometry_json is not None
    registry = files.bundle_release(doc, "r1", "d" * 64, "m", "l").first()
    assert registry.generated_at == datetime(2026, 8, 6, 5, 37, 16) and registry.scope == "s"
    assert files.bundle_sources(doc, "r1").first().source_url == "u"


def checks(spark, tmp_path, *features, version="0.2.0"):
    rows = release.flatten_features(files.bundle_features(bundle(spark, tmp_path, *features, version=version), "r1"))
    scored = rows.withColumn("default_score", F.get_json_object("default_score_text", "$.score").cast("double"))
    return {r.rule_id: r.offences for r in release.bundle_checks(scored, version, expected=len(features)).collect() if not r.passed}


def test_bundle_checks(spark, tmp_path):
    assert checks(spark, tmp_path, feature("01001"), feature("01003", score=0), feature("01005", score=100)) == {}
    assert checks(spark, tmp_path, feature("01001"), feature("01001")) == {"unique_fips": 1}
    assert checks(spark, tmp_path, feature("0100"), feature("0100a"), feature("٠١٢٣٤")) == {"fips_format": 3}
    assert checks(spark, tmp_path, feature(score=-1), feature("01003", score=101)) == {"score_range": 2}
    assert checks(spark, tmp_path, feature(status="no_county_linked_record", count=None)) == {}
    assert checks(spark, tmp_path, feature(status="no_county_linked_record", count=0)) == {"missing_not_zero": 1}
    assert checks(spark, tmp_path, feature(), version="0.1.0") == {"schema_version": 1}


def test_ordered_sample_limits(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], ["i"])
    assert [r.i for r in quality.ordered_sample(df, "i", 2).collect()] == [1, 2]
    for size in (0, 101):
        with pytest.raises(ValueError):
            quality.ordered_sample(df, "i", size)
    with pytest.raises(ValueError):
        quality.require_rows(df.limit(0))


def test_retry(spark):
    codes = spark.createDataFrame([(200, 1), (429, 1), (503, 2), (503, 3), (401, 1), (403, 1), (422, 1)], "c int, a int")
    got = codes.select(quality.retry_class(F.col("c")).alias("k"), quality.retry_delay(F.col("c"), F.col("a")).alias("d")).collect()
    assert [(r.k, r.d) for r in got] == [("SUCCESS", None), ("RETRYABLE", 1), ("RETRYABLE", 2), ("RETRYABLE", None), ("REVIEW", None), ("REVIEW", None), ("REVIEW", None)]


def test_conform_aggregate_keeps_missing_apart(spark):
    rows = [("a", 5, "VALUE"), ("a", None, "SUPPRESSED"), ("a", 0, "ZERO"), ("b", None, "UNKNOWN"), ("b", None, "NULL")]
    df = spark.createDataFrame(rows, "k string, v bigint, s string")
    got = {r.k: r for r in quality.conform_aggregate(df, ["k"], "v", "s", "MEAN").collect()}
    assert got["a"].measure == 2.5 and got["a"].n_suppressed == 1 and got["b"].measure is None and got["b"].n_unknown == 1
    with pytest.raises(ValueError):
        quality.conform_aggregate(df, ["k"], "v", "s", "RATE")


def test_retire_orphans_ignores_versions_without_a_decision(spark):
    versions = spark.createDataFrame(
        [("v1", "APPROVED", "d1", None), ("v2", "APPROVED", "gone", None), ("v3", "APPROVED", None, None), ("v4", "APPROVED", "gone", T0)],
        "data_source_version_id string, status string, approved_decision_id string, retired_at timestamp")
    known = spark.createDataFrame([("d1",), (None,)], "manual_review_decision_id string")
    got = history.retire_orphans(versions, known, F.lit(T0)).collect()
    assert [(r.data_source_version_id, r.status) for r in got] == [("v2", "RETIRED")]


def test_relevance_finds_terms_of_any_length(spark):
    from attestry.operators import discovery

    resources = spark.createDataFrame([(1, "On the social determinants of health in towns"), (2, "weather"), (3, None)], "id int, text string")
    terms = spark.createDataFrame([("social determinants of health",), ("weather",), ("the social determinants of health in",)], "term string")
    assert {r.id: r.term_hits for r in discovery.relevance_match(resources, "id", ["text"], terms).collect()} == {1: 2, 2: 1, 3: 0}
    assert discovery.relevance_match(resources, "id", ["text"], terms.limit(0)).filter("term_hits = 0").count() == 3


def test_all_server_failures_are_retried(spark):
    from attestry.operators import quality

    codes = spark.createDataFrame([(c,) for c in (200, 404, 429, 500, 501, 505, 520, 599, 600)], "c int")
    again = {r.c for r in codes.withColumn("k", quality.retry_class(F.col("c"))).filter("k = 'RETRYABLE'").collect()}
    assert again == {429, 500, 501, 505, 520, 599}


def test_lineage_deeper_than_fifty_levels(spark):
    from attestry.operators import lineage

    edges = spark.createDataFrame([(f"a{i}", f"a{i + 1}") for i in range(53)], "output_object string, input_object string")
    found = lineage.trace_lineage(edges, spark.createDataFrame([("a0",)], "asset string"))
    assert found.agg(F.max("depth")).first()[0] == 53


def test_points_without_coordinates_keep_a_row(spark):
    from attestry.operators import match

    points = spark.createDataFrame([(1, 10.0, 50.0), (2, None, 50.0)], "p int, lon double, lat double")
    stations = spark.createDataFrame([(7, 10.1, 50.0)], "s int, lon double, lat double")
    assert {r.p: r.s for r in match.nearest_station(points, stations, "p", "s").collect()} == {1: 7, 2: None}
    assert {r.p: r.s for r in match.nearest_station(points, stations.limit(0), "p", "s").collect()} == {1: None, 2: None}
