"""Append-only ledgers, RAW and releases on Parquet.

A unit of work is one ``batch_id`` (for releases, one release id). Every attempt at it writes each table to a folder of its own, and one record of the
commit log names them all (``commits``), so a job that dies half-way leaves nothing visible, whatever its rerun holds. A batch is published
once: publishing it again with the same content does nothing, with other content it is an error. A release is replaced as a whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from attestry.functions.digest import artifact_key, row_hash, sha256_hex
from attestry.sources import identities
from attestry.sources.commits import Conflict, Log, content


def is_published(spark: SparkSession, root: str, name: str, batch_id: str) -> bool:
    return name in Log(spark, root).published(batch_id)


def _same_content(name: str, batch_id: str, entry: Mapping, digest: str) -> None:
    if entry["digest"] != digest:
        raise Conflict(f"{name}: batch {batch_id} is published with other content")


def append_ledger(root: str, batch_id: str, tables: Mapping[str, DataFrame], partitions: Mapping[str, Sequence[str]] | None = None) -> None:
    """Append several tables as one unit.

    Tables of the batch that are published already must hold the same rows, columns of ``commits.VOLATILE`` aside, and are left as they are.
    """
    log = Log(next(iter(tables.values())).sparkSession, root)
    seen, known = log.head(), log.published(batch_id)
    marked = {n: df.withColumn("batch_id", F.lit(batch_id)) for n, df in tables.items()}
    for name in tables.keys() & known.keys():
        _same_content(name, batch_id, known[name], marked[name].agg(*content(marked[name])).first().digest)
    new = {n: df for n, df in marked.items() if n not in known}
    if new:
        entries = log.described(new, log.write(new, partitions), batch_id)
        try:
            log.commit(entries, seen)
        except Conflict:
            # Someone else published the batch meanwhile: that is well if it is the same.
            found = log.published(batch_id)
            for e in entries:
                _same_content(e["table"], batch_id, found[e["table"]], e["digest"])


def read_ledger(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Rows of the table's published batches."""
    return Log(spark, root).read(name)


def raw_rows(
    records: DataFrame,
    payload: str,
    *,
    version: Column,
    run: Column,
    artifact: Column,
    source_url: Column,
    record_id: Column,
    retrieved_at: Column,
    loaded_at: Column | None = None,
    batch_id: str | None = None,
) -> DataFrame:
    """Source records (JSON text) to RAW rows: untouched payload, provenance columns, row hash."""
    parsed = records.withColumn("__payload", F.parse_json(payload))
    return parsed.select(
        F.col("__payload").alias("payload"),
        version.alias("data_source_version_id"),
        run.alias("ingestion_run_id"),
        artifact.alias("artifact_id"),
        F.substring_index(source_url, "?", 1).alias("source_url"),
        record_id.alias("source_record_id"),
        row_hash(F.col("__payload")).alias("source_row_hash"),
        retrieved_at.alias("retrieved_at"),
        (F.current_timestamp() if loaded_at is None else loaded_at).alias("loaded_at"),
        F.lit(batch_id).cast("string").alias("raw_load_batch_id"),
    )


RAW_IDENTITY = ("data_source_version_id", "source_record_id", "source_row_hash")


def append_raw_idempotent(incoming: DataFrame, root: str, table: str, batch_id: str) -> int:
    """Append only what published batches do not hold yet, each record once.

    Identities are looked up in an index (``identities``) that is published together with the rows, so RAW itself is never read.
    Appending a batch again does nothing; other records under a published batch id are an error. Of two appends at the same time the
    later one starts anew. Returns the number of the index's buckets that were read.
    """
    log = Log(incoming.sparkSession, root)
    mark = identities.names(table)[2]
    keyed = identities.hashed(incoming, RAW_IDENTITY)
    # The digest is that of all records given, whatever was loaded before them.
    n, given = keyed.agg(*content(keyed, ["__h", "__g"])).first()
    while True:
        seen, known = log.head(), log.published(batch_id)
        if table in known:
            _same_content(table, batch_id, known[table], given)
            return 0
        held, n_buckets = identities.seen_before(log, table, keyed, n)
        fresh = keyed.dropDuplicates(["__h", "__g"])
        if held is not None:
            fresh = fresh.join(held, ["__h", "__g"], "left_anti")
        # Rows of a version lie together, in files of an even size.
        rows = fresh.drop("__h", "__g").withColumn("batch_id", F.lit(batch_id)).hint("rebalance", "data_source_version_id").sortWithinPartitions("data_source_version_id")
        attempts = log.write({table: rows})
        (entry,) = log.described({table: rows}, attempts, batch_id)
        written = log.spark.read.schema(rows.schema).parquet(log.attempt_path(table, entry["attempt"]))
        run = identities.run_of(log, table, identities.hashed(written, RAW_IDENTITY), entry["rows"], 0) if entry["rows"] else []
        last = entry | {"table": mark, "unit": "last", "rows": 0}
        try:
            log.commit([entry | {"digest": given}, *run, last], seen)
        except Conflict:
            continue
        identities.merge(log, table)
        return n_buckets


def register_artifacts(
    items: DataFrame, content: str, *, environment: Column, resource_key: Column, run: Column, kind: str, media_type: str
) -> DataFrame:
    """Digest, byte count and deterministic object key of each content (text or binary)."""
    digest = sha256_hex(F.col(content).cast("binary"))
    sized = items.withColumns({"sha256": digest, "byte_count": F.octet_length(F.col(content)).cast("bigint")})
    return sized.withColumns(
        {
            "artifact_uri": artifact_key(environment, resource_key, run, F.col("sha256")),
            "artifact_type": F.lit(kind),
            "media_type": F.lit(media_type),
            "retention_class": F.lit("STANDARD_7_YEARS"),
        }
    ).drop(content)


MANIFEST_BLOCK = 1024


def _hash_lists(entries: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Digest of the ordered ``position:digest`` lines of each group, and the number of artifacts below it."""
    line = lambda p: F.concat(p["pos"].cast("string"), F.lit(":"), p["d"])
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "d"))), line)
    return entries.groupBy(*keys).agg(sha256_hex(F.array_join(ordered, "\n")).alias("d"), F.sum("n").alias("n"))


def build_manifest(artifacts: DataFrame, run: str, sequence: str, digest: str) -> DataFrame:
    """One manifest digest per acquisition over its ordered page digests.

    A tree of digests, so that no list grows with a run: repeated retrievals of a page are hashed
    by digest prefix, prefixes by page, pages by block of ``MANIFEST_BLOCK``, blocks by block of
    blocks, and those by run.
    """
    block = F.floor(F.col("pos") / MANIFEST_BLOCK)
    leaves = artifacts.select(
        F.col(run).alias("run"), F.col(sequence).cast("bigint").alias("page"), F.col(digest).alias("d")
    ).distinct()
    leaves = leaves.withColumns({"pos": F.left("d", F.lit(2)), "n": F.lit(1).cast("bigint")})
    prefixes = _hash_lists(leaves.withColumn("prefix", F.col("pos")), ["run", "page", "prefix"])
    pages = _hash_lists(prefixes.withColumnRenamed("prefix", "pos"), ["run", "page"])
    level = pages.withColumnRenamed("page", "pos")
    for _ in range(2):
        level = _hash_lists(level.withColumn("block", block), ["run", "block"]).withColumnRenamed("block", "pos")
    return _hash_lists(level, ["run"]).select(
        F.col("run").alias(run), F.col("n").alias("artifact_count"), F.col("d").alias("manifest_sha256")
    )


def close_run(run_id: Column, status: str, at: Column, runs: DataFrame, status_column: str = "status") -> DataFrame:
    """Status rows that close runs; appended to the ledger, never written over the RUNNING rows."""
    return runs.select(run_id.alias("ingestion_run_id"), F.lit(status).alias(status_column), at.alias("at"))


SLOT = "release_slot"


def replace_releases(root: str, tables: Mapping[str, DataFrame], release_ids: Sequence[str], current: str | None = None, seen: int | None = None) -> None:
    """Replace whole releases in all ``tables`` (rows with a ``release_id``) and move the pointer, in one commit.

    A release without rows in a table has none there afterwards. Other releases stay as they are. ``seen`` is the commit number that the load rests
    on; if one of these releases was loaded since, this load is refused.
    """
    log = Log(next(iter(tables.values())).sparkSession, root)
    seen = log.head() if seen is None else seen
    # Releases are told apart on disk by their place in the list, which needs no escaping; 0 stands for any other.
    slot = F.array_position(F.array(*[F.lit(r) for r in release_ids]), F.col("release_id")).cast("int")
    tables = {n: df.withColumn("release_id", F.col("release_id").cast("string")) for n, df in tables.items()}
    attempts = log.write({n: df.withColumn(SLOT, F.coalesce(slot, F.lit(0))) for n, df in tables.items()}, dict.fromkeys(tables, [SLOT]))
    entries = []
    for name, df in tables.items():
        back = log.spark.read.schema(StructType([*df.schema.fields]).add(SLOT, IntegerType())).parquet(log.attempt_path(name, attempts[name]))
        counted = {r[SLOT]: r.n for r in back.groupBy(SLOT).agg(F.count(F.lit(1)).alias("n")).collect()}
        if 0 in counted:
            raise ValueError(f"{name} has {counted[0]} rows of other releases than {', '.join(release_ids)}")
        for i, release in enumerate(release_ids, 1):
            folder = f"{attempts[name]}/{SLOT}={i}"
            entries.append({"table": name, "unit": release, "attempt": folder, "digest": "", "rows": counted.get(i, 0), "schema": df.schema.json(), "retired": False})
    if current is not None:
        entries.append(_pointer(current))
    log.commit(entries, seen)


def replace_release(root: str, release_id: str, tables: Mapping[str, DataFrame], current: bool = False, seen: int | None = None) -> None:
    """``replace_releases`` for one release, whose tables need no ``release_id``."""
    marked = {n: df.withColumn("release_id", F.lit(release_id)) for n, df in tables.items()}
    replace_releases(root, marked, [release_id], release_id if current else None, seen)


def read_release(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Rows of all releases of a table, each as it was loaded last."""
    return Log(spark, root).read(name)


def _pointer(release_id: str) -> dict:
    return {"table": "current_release", "unit": "pointer", "attempt": release_id, "digest": "", "rows": 0, "schema": "", "retired": False}


def set_current(spark: SparkSession, root: str, release_id: str) -> None:
    """Name the current release; the newest commit counts. Moving it twice at the same time is refused."""
    log = Log(spark, root)
    log.commit([_pointer(release_id)], log.head())


def current_release(spark: SparkSession, root: str) -> str | None:
    entry = Log(spark, root).entries("current_release").get("pointer")
    return entry["attempt"] if entry else None


def with_current_flag(releases: DataFrame, root: str) -> DataFrame:
    """Release registry with ``is_current`` as the newest commit has it."""
    return releases.withColumn("is_current", F.col("release_id").eqNullSafe(F.lit(current_release(releases.sparkSession, root))))


def newest_release(releases: DataFrame, by: str) -> DataFrame:
    """Flag the release with the greatest ``by``."""
    newest = releases.agg(F.max_by("release_id", F.struct(by, "release_id"))).scalar()
    return releases.withColumn("is_current", F.col("release_id") == newest)
