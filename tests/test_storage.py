"""Ledgers, releases, paged source, streams, lineage: what stays after reruns and failures."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from attestry.operators import lineage
from attestry.sources import files, identities, ledger, paged
from attestry.sources.commits import EVERY, Conflict, Log
from attestry.streaming import arrivals


def test_unpublished_batches_are_invisible_and_reruns_add_nothing(spark, tmp_path):
    root = str(tmp_path / "l")
    ledger.append_ledger(root, "1", {"a": spark.range(3), "b": spark.range(2)})
    dead = spark.range(100).withColumn("batch_id", F.lit("2")).withColumn("attempt", F.lit("dead"))
    dead.write.mode("append").partitionBy("batch_id", "attempt").parquet(f"{root}/a")
    assert ledger.read_ledger(spark, root, "a").count() == 3
    ledger.append_ledger(root, "2", {"a": spark.range(5)})
    ledger.append_ledger(root, "2", {"a": spark.range(5)})
    assert ledger.read_ledger(spark, root, "a").count() == 8
    assert ledger.read_ledger(spark, root, "b").count() == 2


def test_a_dead_attempt_stays_unread_when_its_rerun_is_empty(spark, tmp_path):
    root = str(tmp_path / "l")
    ledger.append_ledger(root, "1", {"a": spark.range(3)})
    dead = spark.range(100).withColumn("batch_id", F.lit("2")).withColumn("attempt", F.lit("dead"))
    dead.write.mode("append").partitionBy("batch_id", "attempt").parquet(f"{root}/a")
    ledger.append_ledger(root, "2", {"a": spark.range(0)})
    assert ledger.read_ledger(spark, root, "a").count() == 3


def test_publication_is_by_table_and_published_rows_stay(spark, tmp_path):
    root = str(tmp_path / "l")
    ledger.append_ledger(root, "1", {"a": spark.range(3)})
    dead = spark.range(5).withColumn("batch_id", F.lit("1")).withColumn("attempt", F.lit("dead"))
    dead.write.mode("append").partitionBy("batch_id", "attempt").parquet(f"{root}/b")
    assert ledger.read_ledger(spark, root, "b").count() == 0
    with pytest.raises(Conflict, match="other content"):
        ledger.append_ledger(root, "1", {"a": spark.range(50), "b": spark.range(7)})
    assert ledger.read_ledger(spark, root, "b").count() == 0
    ledger.append_ledger(root, "1", {"a": spark.range(3).orderBy(F.desc("id")), "b": spark.range(7)})
    assert ledger.read_ledger(spark, root, "a").count() == 3
    assert ledger.read_ledger(spark, root, "b").count() == 7


def test_a_new_stream_on_one_root_keeps_what_the_first_one_loaded(spark, tmp_path):
    from attestry.streaming import arrivals

    root, landing = str(tmp_path / "raw"), str(tmp_path / "landing")
    for number, ids in enumerate((range(0, 3), range(3, 5))):
        rows = spark.createDataFrame([(str(i), f'{{"a":{i}}}') for i in ids], "i string, p string")
        rows.coalesce(1).write.mode("append").parquet(landing)
        stream = arrivals.file_stream(spark, landing, rows.schema, "*.parquet")
        loaded = arrivals.stream_raw_append(stream, lambda df: _raw_of(df), root, "raw", str(tmp_path / f"checkpoint{number}"))
        loaded.awaitTermination()
    found = ledger.read_ledger(spark, root, "raw")
    assert sorted(r[0] for r in found.select("source_record_id").collect()) == ["0", "1", "2", "3", "4"]


def _raw_of(df):
    return ledger.raw_rows(
        df, "p", version=F.lit("v"), run=F.lit("r"), artifact=F.lit("a"), source_url=F.lit("https://h/x"), record_id=F.col("i"),
        retrieved_at=F.lit(datetime(2026, 1, 1)),
    )


def test_tables_without_rows_can_be_read(spark, tmp_path):
    root = str(tmp_path / "l")
    ledger.append_ledger(root, "1", {"a": spark.range(0), "b": spark.range(3).withColumn("p", F.lit(1))}, {"b": ["p"]})
    assert ledger.read_ledger(spark, root, "a").count() == 0
    assert ledger.read_ledger(spark, root, "b").filter("p = 1").count() == 3


def raw(spark, *records):
    df = spark.createDataFrame(records, "i string, p string")
    return ledger.raw_rows(
        df, "p", version=F.lit("v"), run=F.lit("r"), artifact=F.lit("a"), source_url=F.lit("https://h/x?token=1"),
        record_id=F.col("i"), retrieved_at=F.lit(datetime(2026, 1, 1)),
    )


def test_raw_rows_keep_the_payload_and_hash_without_key_order(spark):
    a, b = raw(spark, ("1", '{"a":1,"b":null}'), ("2", '{"b":null, "a":1}')).orderBy("source_record_id").collect()
    assert a.source_row_hash == b.source_row_hash and a.source_url == "https://h/x" and a.payload.toPython() == {"a": 1, "b": None}


def test_idempotent_append(spark, tmp_path):
    root = str(tmp_path / "raw")
    first = raw(spark, ("1", '{"a":1}'), ("1", '{"a":1}'), (None, '{"a":2}'))
    ledger.append_raw_idempotent(first, root, "raw", "b1")
    ledger.append_raw_idempotent(first, root, "raw", "b2")
    ledger.append_raw_idempotent(raw(spark, ("1", '{"a":9}'), ("3", '{"a":1}')), root, "raw", "b3")
    ledger.append_raw_idempotent(first, root, "raw", "b1")
    got = sorted((r.source_record_id or "", r.payload.toPython()["a"]) for r in ledger.read_ledger(spark, root, "raw").collect())
    assert got == [("", 2), ("1", 1), ("1", 9), ("3", 1)]


def test_a_published_batch_with_other_records_is_an_error(spark, tmp_path):
    root = str(tmp_path / "raw")
    ledger.append_raw_idempotent(raw(spark, ("1", '{"a":1}'), ("2", '{"a":2}')), root, "raw", "b1")
    with pytest.raises(Conflict, match="other content"):
        ledger.append_raw_idempotent(raw(spark, ("3", '{"a":3}')), root, "raw", "b1")
    # The same records in another order are the same batch, and records that were loaded before belong to it too.
    ledger.append_raw_idempotent(raw(spark, ("2", '{"a":2}'), ("1", '{"a":1}')), root, "raw", "b1")
    for _ in range(2):
        ledger.append_raw_idempotent(raw(spark, ("2", '{"a":2}'), ("3", '{"a":3}')), root, "raw", "b2")
    assert sorted(r.source_record_id for r in ledger.read_ledger(spark, root, "raw").collect()) == ["1", "2", "3"]


def test_reads_of_the_identity_index_stay_flat(spark, tmp_path, monkeypatch):
    """Twenty batches, each with one record of an earlier batch; small buckets, so that runs have several and are merged."""
    monkeypatch.setattr(identities, "BUCKET", 16)
    root, n, read, listed = str(tmp_path / "raw"), 40, [], []
    for number in range(20):
        ids = [*range(number * n, number * n + n), max(0, number * n - 7)]
        batch = raw(spark, *[(str(i), json.dumps({"a": i})) for i in ids])
        read.append(ledger.append_raw_idempotent(batch, root, "raw", f"b{number}"))
        log = Log(spark, root)
        levels = [identities._parts(u)[0] for u in log.entries("raw_identities")]
        listed.append(log.listed)
        assert max(levels.count(level) for level in set(levels)) < identities.FAN
    found = ledger.read_ledger(spark, root, "raw")
    assert found.count() == 20 * n == found.select("source_record_id").distinct().count()
    # One bucket holds the repeated record; a wrong answer of a filter is rare.
    assert read[0] == 0 and all(1 <= r <= 3 for r in read[1:]) and sum(read[10:]) <= sum(read[1:10]) + 5
    assert max(levels) >= 1 and set(listed) and max(listed) <= 70
    assert log.read("raw_identities").select("__h", "__g").distinct().count() == 20 * n


def test_a_run_no_greater_than_the_batch_is_read_without_asking(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(identities, "WHOLE", 1)
    monkeypatch.setattr(identities, "_asked", lambda *_: pytest.fail("filters were asked"))
    root = str(tmp_path / "raw")
    for name, ids in (("b1", range(20)), ("b2", range(40)), ("b3", range(40))):
        batch = raw(spark, *[(str(i), json.dumps({"a": i})) for i in ids])
        assert ledger.append_raw_idempotent(batch, root, "raw", name) == {"b1": 0, "b2": 1, "b3": 2}[name]
    assert sorted(int(r.source_record_id) for r in ledger.read_ledger(spark, root, "raw").collect()) == [*range(40)]


def test_index_tells_what_it_holds(spark, tmp_path):
    log = Log(spark, str(tmp_path / "l"))
    rows = spark.range(3000).select(F.col("id").cast("string").alias("i"))
    keyed = identities.hashed(rows, ["i"])
    monkey = identities.BUCKET
    try:
        identities.BUCKET = 100
        log.commit(identities.run_of(log, "t", keyed.filter("cast(i as int) % 2 = 0"), 1500, 0), log.head())
        known, n = identities.seen_before(log, "t", keyed.filter("cast(i as int) < 300"))
        got = {int(r.i) for r in keyed.join(known, ["__h", "__g"]).collect()}
        assert got >= set(range(0, 300, 2)) and not any(i % 2 for i in got) and n <= 15
        none, n = identities.seen_before(log, "t", keyed.filter("cast(i as int) = 1"))
        assert n <= 1
        assert identities.seen_before(log, "t", keyed.limit(0)) == (None, 0)
    finally:
        identities.BUCKET = monkey


def test_listing_stays_bounded_over_a_thousand_commits(spark, tmp_path):
    root = str(tmp_path / "l")
    log = Log(spark, root)
    entry = {"table": "t", "attempt": "attempt=x", "digest": "d", "rows": 1, "schema": "{}", "retired": False}
    head = -1
    for i in range(1000):
        head = log.commit([entry | {"unit": f"u{i}"}], head)
    assert head == 999
    log.listed = 0
    assert log.head() == 999 and log.listed <= EVERY + 2
    assert len(log.entries("t")) == 1000 and set(log.published("u17")) == {"t"} and log.published("u1000") == {}
    # A lost hint is only a hint, and a dead snapshot of the next epoch is none.
    log._put(f"{root}/_commits/epoch", "3", replace=True)
    assert log.head() == 999 and len(Log(spark, root).entries("t")) == 1000


def test_concurrent_commits(spark, tmp_path):
    log = Log(spark, str(tmp_path / "l"))
    entry = {"table": "t", "attempt": "attempt=x", "digest": "d", "rows": 1, "schema": "{}", "retired": False}
    seen = log.head()
    assert log.commit([entry | {"unit": "a"}], seen) == 0
    # Another unit moves on to the next number; the same one is refused.
    assert log.commit([entry | {"unit": "b"}], seen) == 1
    with pytest.raises(Conflict, match="meanwhile"):
        log.commit([entry | {"unit": "a"}], seen)
    assert log.commit([entry | {"unit": "a", "retired": True}], log.head()) == 2
    assert set(log.entries("t")) == {"b"}


def test_replacing_one_release_keeps_the_others(spark, tmp_path):
    root = str(tmp_path / "rel")
    rows = spark.createDataFrame([("r1", 1), ("r1", 2), ("r 2/ä", 3)], "release_id string, x int")
    ledger.replace_releases(root, {"facts": rows, "more": rows.limit(0)}, ["r1", "r 2/ä"], current="r1")
    ledger.replace_release(root, "r1", {"facts": spark.createDataFrame([(9,)], "x int"), "more": spark.createDataFrame([(8,)], "x int")})
    assert sorted((r.x, r.release_id) for r in ledger.read_release(spark, root, "facts").collect()) == [(3, "r 2/ä"), (9, "r1")]
    assert [r.x for r in ledger.read_release(spark, root, "more").collect()] == [8]
    ledger.set_current(spark, root, "r 2/ä")
    flagged = ledger.with_current_flag(rows.select("release_id").distinct(), root)
    assert {r.release_id: r.is_current for r in flagged.collect()} == {"r1": False, "r 2/ä": True}
    # A reload without rows empties the release.
    ledger.replace_release(root, "r1", {"facts": spark.createDataFrame([], "x int")})
    assert [r.x for r in ledger.read_release(spark, root, "facts").collect()] == [3]
    assert [r.x for r in ledger.read_release(spark, root, "more").collect()] == [8]
    with pytest.raises(ValueError, match="other releases"):
        ledger.replace_releases(root, {"facts": rows}, ["r1"])


def test_a_release_load_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    """Killed before each table's write and before the commit, in turn; and two loads at the same time."""
    root = str(tmp_path / "rel")
    frames = lambda x: {n: spark.createDataFrame([(x, i) for i in range(2)], "x int, i int") for n in ("a", "b", "c")}
    ledger.replace_release(root, "r", frames(1), current=True)

    def state():
        return {n: sorted((r.x, r.i) for r in ledger.read_release(spark, root, n).collect()) for n in ("a", "b", "c")}, ledger.current_release(spark, root)

    before = state()
    real_write, real_commit = Log.write, Log.commit
    for step in range(4):

        def dying_write(self, tables, partitions=None, step=step):
            done = real_write(self, dict(list(tables.items())[:step]), partitions)
            if step < 3:
                raise RuntimeError("executor lost")
            return done

        def dying_commit(self, entries, seen):
            raise RuntimeError("driver lost")

        monkeypatch.setattr(Log, "write", dying_write)
        monkeypatch.setattr(Log, "commit", dying_commit)
        with pytest.raises(RuntimeError):
            ledger.replace_release(root, "r", frames(2), current=True)
        monkeypatch.setattr(Log, "write", real_write)
        monkeypatch.setattr(Log, "commit", real_commit)
        assert state() == before
    seen = Log(spark, root).head()
    ledger.replace_release(root, "r", frames(3), current=True)
    with pytest.raises(Conflict, match="meanwhile"):
        ledger.replace_release(root, "r", frames(4), current=True, seen=seen)
    assert state()[0]["a"] == [(3, 0), (3, 1)]


def test_manifest_is_order_free_and_covers_many_blocks(spark):
    pages = spark.range(5000).select(F.lit("r").alias("run"), F.col("id").alias("seq"), F.sha2(F.col("id").cast("string"), 256).alias("d"))
    one = ledger.build_manifest(pages, "run", "seq", "d").first()
    two = ledger.build_manifest(pages.orderBy(F.desc("id")).repartition(7), "run", "seq", "d").first()
    other = ledger.build_manifest(pages.withColumn("d", F.when(F.col("seq") == 4321, "x").otherwise(F.col("d"))), "run", "seq", "d").first()
    assert one.artifact_count == 5000 and one == two and one.manifest_sha256 != other.manifest_sha256


def test_paged_source(spark, tmp_path):
    for page in range(1, 6):
        folder = tmp_path / f"page={page:05d}"
        folder.mkdir()
        # Blank lines are no records, and the last one may lack its end.
        (folder / "data.json").write_text("\n \n" * (page % 2) + "\n".join(json.dumps({"page": page, "i": i}) for i in range(page)) + "\n" * (page % 3))
    paged.register(spark)
    df = spark.read.format("paged_json").option("pagesPerTask", 2).load(str(tmp_path))
    assert df.rdd.getNumPartitions() == 3
    assert df.groupBy("page_sequence").agg(F.count(F.lit(1)).alias("n"), F.max("page_rows").alias("m")).filter("n <> m OR n <> page_sequence").isEmpty()
    assert df.select("page_sha256").distinct().count() == 5
    some = spark.read.format("paged_json").option("firstPage", 2).option("maxPages", 2).load(str(tmp_path))
    assert sorted({r.page_sequence for r in some.collect()}) == [2, 3]


def test_malformed_records_keep_their_text(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": 1}\n{"a": \n{"a": null}\n')
    (tmp_path / "a.csv").write_text("a,b\n1,2\nx,3\n,4\n")
    df = files.read_direct_file(spark, str(tmp_path / "a.json"), "json", "a int")
    assert [r.record for r in files.malformed_records(df).collect()] == ['{"a": '] and df.filter("a = 1").count() == 1
    df = files.read_direct_file(spark, str(tmp_path / "a.csv"), "csv", "a int, b int")
    assert [r.record for r in files.malformed_records(df).collect()] == ["x,3"] and sorted(r.b for r in df.select("b").collect()) == [2, 3, 4]


def test_direct_files(spark, tmp_path):
    (tmp_path / "g.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {}, "geometry": {"type": "Point", "coordinates": [3, 4]}}]}))
    row = files.read_direct_file(spark, str(tmp_path / "g.geojson"), "geojson").first()
    assert row.geometry.max_y == 4 and row.source_file.endswith("g.geojson") and row.source_file_bytes > 0
    digest = files.file_digest(spark, str(tmp_path / "g.geojson")).first()
    assert len(digest.sha256) == 64 and digest.byte_count == row.source_file_bytes
    with pytest.raises(ValueError):
        files.read_direct_file(spark, str(tmp_path), "csv")
    with pytest.raises(ValueError):
        files.read_direct_file(spark, str(tmp_path), "xlsx", "a int")


def land(spark, folder, name, rows):
    df = spark.createDataFrame(rows, "i string, p string, at timestamp, src string").coalesce(1)
    df.toPandas().to_parquet(f"{folder}/{name}.parquet", coerce_timestamps="us")


def test_streams_keep_late_and_repeated_records_straight(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    land(spark, folder, "a", [("1", '{"a":1}', datetime(2026, 1, 3), "s"), ("2", '{"a":2}', datetime(2026, 1, 3), "s")])
    schema = spark.read.parquet(str(folder)).schema
    root = str(tmp_path / "out")

    def to_raw(batch):
        return ledger.raw_rows(
            batch, "p", version=F.lit("v"), run=F.lit("r"), artifact=F.lit("a"), source_url=F.lit("u"), record_id=F.col("i"), retrieved_at=F.col("at")
        )

    def run():
        stream = arrivals.file_stream(spark, str(folder), schema, "*.parquet", files_per_batch=1)
        arrivals.stream_raw_append(stream, to_raw, root, "raw", f"{root}-c1").awaitTermination()
        stream = arrivals.file_stream(spark, str(folder), schema, "*.parquet", files_per_batch=1)
        arrivals.record_arrivals(stream, "at", "src", "1 day", root + "-arr", "arrivals", f"{root}-c2").awaitTermination()

    run()
    # A record from two days earlier and one that is already loaded.
    land(spark, folder, "b", [("3", '{"a":3}', datetime(2026, 1, 1), "s"), ("2", '{"a":2}', datetime(2026, 1, 3), "s")])
    run()
    run()
    assert sorted(r.source_record_id for r in ledger.read_ledger(spark, root, "raw").collect()) == ["1", "2", "3"]
    got = {r.window_start.day: (r.n, r.n_batches) for r in arrivals.arrivals(spark, root + "-arr", "arrivals", "src").collect()}
    assert got == {1: (1, 1), 3: (3, 2)}


def test_windowed_counts_with_watermark(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    land(spark, folder, "a", [(str(i), "{}", datetime(2026, 1, 1 + i), "s") for i in range(5)])
    schema = spark.read.parquet(str(folder)).schema
    stream = arrivals.file_stream(spark, str(folder), schema, "*.parquet")
    job = (
        arrivals.windowed_counts(stream, "at", "src", "1 day", "1 day").writeStream.format("memory").queryName("counts")
        .outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    job.awaitTermination()
    # Closed windows only: the newest day and the day inside the allowed lateness stay open.
    assert sorted(r.window_start.day for r in spark.table("counts").collect()) == [1, 2, 3]


def test_trace_ends_on_cycles_and_counts_diamonds_once(spark):
    pairs = [("d", "b"), ("d", "c"), ("b", "a"), ("c", "a"), ("a", "d"), ("x", "y")]
    edges = spark.createDataFrame(pairs, "output_object string, input_object string")
    roots = spark.createDataFrame([("d",)], "asset string")
    got = {r.ancestor: r.depth for r in lineage.trace_lineage(edges, roots).collect()}
    assert got == {"b": 1, "c": 1, "a": 2}
    chain = spark.createDataFrame([(str(i), str(i + 1)) for i in range(6)], "output_object string, input_object string")
    with pytest.raises(ValueError):
        lineage.trace_lineage(chain, spark.createDataFrame([("0",)], "asset string"), max_depth=3)


def test_load_release_checks_before_it_writes(spark, tmp_path):
    import gzip
    import hashlib

    from attestry.sources import acquire
    from test_policy import feature

    def write(*features):
        doc = {"schema_version": "0.2.0", "generated_at": "2026-08-06T05:37:16Z", "scope": "s", "score_defaults": {"w": 1},
               "sources": [{"key": "k", "label": "l", "vintage": "v", "url": "u", "note": "n"}], "feature_collection": {"features": list(features)}}
        path = tmp_path / "b.json.gz"
        text = json.dumps(doc, indent=1).encode()
        path.write_bytes(gzip.compress(text))
        return str(path), hashlib.sha256(text).hexdigest()

    root = str(tmp_path / "release")
    path, digest = write(feature("01001"), feature("01003"))
    with pytest.raises(ValueError, match="checksum"):
        acquire.load_release(spark, path, root, "r1", "0" * 64, "m", "l", 2)
    with pytest.raises(ValueError, match="county_count"):
        acquire.load_release(spark, path, root, "r1", digest, "m", "l", 3)
    acquire.load_release(spark, path, root, "r1", digest, "m", "l", 2)
    acquire.load_release(spark, path, root, "r1", digest, "m", "l", 2)
    assert ledger.read_release(spark, root, "county_facts").count() == 2
    assert ledger.read_release(spark, root, "source_metadata").count() == 1
    assert ledger.read_release(spark, root, "dataset_release").count() == 1
    assert ledger.current_release(spark, root) == "r1"
    path, digest = write(feature("01001"), feature("0100x"))
    with pytest.raises(ValueError, match="fips_format"):
        acquire.load_release(spark, path, root, "r2", digest, "m", "l", 2)
    assert ledger.read_release(spark, root, "dataset_release").count() == 1 and ledger.current_release(spark, root) == "r1"


def test_repeated_registrations_count_once(spark):
    from attestry.operators import history

    rows = [("1", "r", datetime(2026, 1, 1)), ("2", "r", datetime(2026, 1, 2)), ("3", "q", datetime(2026, 1, 1))]
    df = spark.createDataFrame(rows, "catalog_resource_id string, resource_key string, registered_at timestamp")
    assert sorted(r.catalog_resource_id for r in history.latest_resources(df).collect()) == ["2", "3"]


def test_shape_follows_the_ledger(spark):
    from attestry.schemas import LEDGERS, shape

    df = spark.range(1).select(
        F.lit(True).alias("is_active"), F.lit(5).alias("username"), F.lit("GLOBAL").alias("authorization_scope"),
        F.lit(datetime(2026, 1, 1)).alias("granted_at"), F.lit("x").alias("granted_by"), F.lit("extra").alias("other"),
    )
    shaped = shape(df, LEDGERS["approval_stewards"])
    assert shaped.columns == LEDGERS["approval_stewards"].names and shaped.first().username == "5"
    with pytest.raises(ValueError, match="granted_by"):
        shape(df.drop("granted_by"), LEDGERS["approval_stewards"])
    versions = spark.range(1).select(F.lit("v").alias("data_source_version_id"), F.lit("r").alias("resource_key"), F.lit("APPROVED").alias("status"), F.current_timestamp().alias("created_at"))
    assert shape(versions, LEDGERS["data_source_versions"]).first().retired_at is None
