"""Quality rules, reconciliation, freshness, cadence and value-state-aware aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestry.functions.redact import credential_count
from attestry.operators.segments import neighbour

# Outlier limit, attempts and freshness limits in hours.
OUTLIER_SIGMAS = 3.5
MAX_ATTEMPTS = 3
FRESHNESS_HOURS = {"weather": 24, "annual_final": 30 * 24}
RETENTION_YEARS = 7


@dataclass(frozen=True)
class RowRule:
    """A rule judged row by row; ``broken`` is true for an offending row."""

    rule_id: str
    severity: str
    broken: Column


@dataclass(frozen=True)
class TableRule:
    """A rule judged on the whole table; ``offences`` is an aggregate, above zero on failure."""

    rule_id: str
    severity: str
    offences: Column


def not_null(rule_id: str, column: str, severity: str = "BLOCKING") -> RowRule:
    return RowRule(rule_id, severity, F.col(column).isNull())


def in_domain(rule_id: str, column: str, allowed: Sequence[object], severity: str = "BLOCKING") -> RowRule:
    return RowRule(rule_id, severity, F.col(column).isNotNull() & ~F.col(column).isin(*allowed))


def in_range(rule_id: str, column: str, low: object, high: object, severity: str = "BLOCKING") -> RowRule:
    return RowRule(rule_id, severity, ~F.col(column).between(low, high))


def semantic(rule_id: str, must_hold: Column, severity: str = "WARNING") -> RowRule:
    return RowRule(rule_id, severity, ~must_hold)


def _result(rule_id: Column, severity: Column, offences: Column) -> list[Column]:
    found = F.coalesce(offences, F.lit(0)).cast("bigint")
    return [
        rule_id.alias("rule_id"),
        severity.alias("severity"),
        F.when(found > 0, "FAIL").otherwise("PASS").alias("status"),
        found.alias("offences"),
    ]


def single_pass_rules(df: DataFrame, rules: Sequence[RowRule | TableRule]) -> DataFrame:
    """All row and table rules in one scan and one aggregate, then one row per rule."""

    def offences(rule: RowRule | TableRule) -> Column:
        return F.count_if(F.coalesce(rule.broken, F.lit(False))) if isinstance(rule, RowRule) else rule.offences

    counts = df.agg(*[offences(r).alias(f"r{i}") for i, r in enumerate(rules)])
    rows = F.array(
        *[F.struct(*_result(F.lit(r.rule_id), F.lit(r.severity), F.col(f"r{i}"))) for i, r in enumerate(rules)]
    )
    return counts.select(F.inline(rows))


def row_count(rule_id: str, low: int, high: int | None = None, severity: str = "BLOCKING") -> TableRule:
    n = F.count(F.lit(1))
    bad = (n < low) if high is None else ~n.between(low, high)
    return TableRule(rule_id, severity, bad.cast("int"))


def fresh_enough(rule_id: str, at: str, as_of: Column, max_hours: int, severity: str = "WARNING") -> TableRule:
    late = F.coalesce(F.timestamp_diff("HOUR", F.max(at), as_of) > max_hours, F.lit(True))
    return TableRule(rule_id, severity, late.cast("int"))


def unique_rule(df: DataFrame, rule_id: str, keys: Sequence[str], severity: str = "BLOCKING") -> DataFrame:
    """Rows beyond the first of each key."""
    extra = df.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("n")).agg(F.sum("n").alias("n"))
    return extra.select(*_result(F.lit(rule_id), F.lit(severity), F.col("n")))


def volume_rule(df: DataFrame, rule_id: str, keys: Sequence[str], period: Column, severity: str = "WARNING") -> DataFrame:
    flagged = volume_outliers(df.withColumn("__period", period), keys, "__period")
    counted = flagged.agg(F.count_if("is_outlier").alias("n"))
    return counted.select(*_result(F.lit(rule_id), F.lit(severity), F.col("n")))


def continuity_rule(df: DataFrame, rule_id: str, keys: Sequence[str], period: str, unit: str, severity: str = "WARNING") -> DataFrame:
    missing = temporal_gaps(df, keys, period, unit).agg(F.count(F.lit(1)).alias("n"))
    return missing.select(*_result(F.lit(rule_id), F.lit(severity), F.col("n")))


def combine_results(results: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), results)


def quality_summary(results: DataFrame, keys: Sequence[str] = ("severity",)) -> DataFrame:
    """Results by severity and status, one column per status."""
    return results.groupBy(*keys).agg(
        F.count_if(F.col("status") == "PASS").alias("n_pass"),
        F.count_if(F.col("status") == "FAIL").alias("n_fail"),
    )


def referential_checks(relations: Mapping[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Orphans per relation: child rows whose (non-null) reference has no parent row."""
    parts = []
    for name, (child, foreign, parent, primary) in relations.items():
        known = parent.select(F.col(primary).alias("__ref"))
        orphans = child.select(F.col(foreign).alias("__ref")).filter(F.col("__ref").isNotNull()).join(known, "__ref", "left_anti")
        parts.append(
            orphans.agg(F.count(F.lit(1)).alias("orphan_rows"), F.count_distinct("__ref").alias("orphan_keys")).select(
                F.lit(name).alias("relation"), "orphan_rows", "orphan_keys"
            )
        )
    return combine_results(parts)


def page_gaps(requests: DataFrame, run: str, sequence: str, rows: str | None = None, page_size: int | None = None) -> DataFrame:
    """Per run: highest page, distinct pages, missing pages, repeated pages (and a short page before the last).

    Pages are counted per (run, sequence) first, so the second step holds one row per page.
    """
    per_page = requests.groupBy(run, sequence).agg(
        F.count(F.lit(1)).alias("n"), *([F.max(rows).alias("page_rows")] if rows else [])
    )
    measures = [
        F.max(sequence).cast("bigint").alias("last_sequence"),
        F.count(F.lit(1)).alias("distinct_pages"),
        (F.max(sequence) - F.count(F.lit(1))).cast("bigint").alias("missing_pages"),
        F.sum(F.col("n") - 1).cast("bigint").alias("repeated_pages"),
    ]
    if rows and page_size:
        last = F.max_by("page_rows", F.col(sequence))
        measures += [
            (F.count_if(F.col("page_rows") < page_size) - F.when(last < page_size, 1).otherwise(0)).cast("bigint").alias("short_inner_pages"),
            (last < page_size).alias("short_last_page"),
        ]
    return per_page.groupBy(run).agg(*measures)


def page_gap_ranges(requests: DataFrame, run: str, sequence: str) -> DataFrame:
    """Missing ranges between consecutive recorded pages of a run, and before the first."""
    pages = requests.select(run, sequence).distinct()
    linked = neighbour(pages, [run], [sequence], [sequence])
    before = F.coalesce(F.col(f"prev_{sequence}"), F.lit(0))
    return linked.filter(F.col(sequence) > before + 1).select(
        run, (before + 1).cast("bigint").alias("gap_from"), (F.col(sequence) - 1).cast("bigint").alias("gap_to")
    )


def reconcile_counts(run: str, **stages: DataFrame) -> DataFrame:
    """Row counts per run and stage side by side; each stage is ``(run, n)``. Absent stages stay null."""
    names = list(stages)
    stacked = reduce(
        lambda a, b: a.unionByName(b),
        [
            df.select(run, *[(F.col("n") if name == s else F.lit(None)).cast("bigint").alias(s) for s in names])
            for name, df in stages.items()
        ],
    )
    sums = stacked.groupBy(run).agg(*[F.sum(s).alias(s) for s in names])
    equal = reduce(lambda a, b: a & b, [F.col(names[0]).eqNullSafe(F.col(s)) for s in names[1:]])
    return sums.withColumn("is_reconciled", equal)


def volume_outliers(df: DataFrame, keys: Sequence[str], period: str, sigmas: float = OUTLIER_SIGMAS) -> DataFrame:
    """Row volume per key and period, flagged when over ``sigmas`` deviations from the key's mean. Nothing is changed.

    The series per key has one row per period; only that is ordered or averaged per key.
    """
    volume = df.groupBy(*keys, period).agg(F.count(F.lit(1)).alias("volume"))
    series = Window.partitionBy(*keys)
    judged = volume.withColumns(
        {"mean_volume": F.avg("volume").over(series), "__sd": F.stddev_samp("volume").over(series)}
    )
    far = F.abs(F.col("volume") - F.col("mean_volume")) > F.col("__sd") * sigmas
    return judged.withColumn("is_outlier", F.coalesce((F.col("__sd") > 0) & far, F.lit(False))).drop("__sd")


def temporal_gaps(df: DataFrame, keys: Sequence[str], period: str, unit: str) -> DataFrame:
    """Periods missing between a key's first and last period. ``period`` is a date cut to ``unit``."""
    seen = df.select(*keys, period).distinct()
    before = F.lag(period).over(Window.partitionBy(*keys).orderBy(period))
    step = F.expr(f"interval 1 {unit}")
    return (
        seen.withColumn("__before", before)
        .filter(F.col("__before") + step < F.col(period))
        .select(*keys, F.explode(F.sequence(F.col("__before") + step, F.col(period) - step, step)).alias("missing_period"))
    )


def align_periods(df: DataFrame, keys: Sequence[str], period: Column, measure: Column, trailing: int) -> DataFrame:
    """Reporting periods with the previous period's value and a trailing sum over ``trailing`` days.

    Rows collapse to one per key and period before any ordering, so frames stay small.
    """
    per_period = df.groupBy(*keys, period.alias("period")).agg(F.sum(measure).alias("total"))
    days = F.datediff(F.col("period"), F.lit("1970-01-01").cast("date"))
    order = Window.partitionBy(*keys).orderBy("period")
    trail = Window.partitionBy(*keys).orderBy(days).rangeBetween(-(trailing - 1), 0)
    return per_period.withColumns(
        {"previous_total": F.lag("total").over(order), "trailing_total": F.sum("total").over(trail)}
    )


def freshness(sources: DataFrame, at: str, cadence: str, as_of: Column, limits: Mapping[str, int]) -> DataFrame:
    """Age in hours against the limit of the source's cadence; an unknown cadence is UNKNOWN, not fresh."""
    limit = F.element_at(F.create_map(*[F.lit(x) for p in limits.items() for x in p]), F.col(cadence))
    age = F.timestamp_diff("HOUR", F.col(at), as_of)
    state = F.when(limit.isNull() | F.col(at).isNull(), "UNKNOWN").when(age > limit, "STALE").otherwise("FRESH")
    return sources.withColumns({"age_hours": age, "freshness": state})


def ops_status(
    runs: DataFrame, key: str, run_id: str, status: str, at: str, as_of: Column, stale_hours: int
) -> DataFrame:
    """Latest status, counts by outcome and staleness per source, in one aggregate."""
    ok = contract_name(F.col(status), CONTRACT_STATUS) == "SUCCEEDED"
    per = runs.groupBy(key).agg(
        F.max_by(status, F.struct(at, run_id)).alias("latest_status"),
        F.count_if(F.col(status) == "FAILED").alias("n_failed"),
        F.count_if(F.col(status) == "PARTIAL").alias("n_partial"),
        F.count_if(F.col(status) == "BLOCKED_REVIEW").alias("n_blocked"),
        F.max(F.when(ok, F.col(at))).alias("last_success_at"),
    )
    stale = F.coalesce(F.timestamp_diff("HOUR", F.col("last_success_at"), as_of) > stale_hours, F.lit(True))
    return per.withColumn("is_stale", stale)


# Run statuses and modes as recorded, and the contract's names for them.
CONTRACT_STATUS = {"COMPLETED": "SUCCEEDED"}
CONTRACT_MODE = {"DISCOVERY": "METADATA_ONLY", "EVIDENCE_ONLY": "VALIDATION_ONLY"}


def contract_name(recorded: Column, names: Mapping[str, str]) -> Column:
    """Contract name of a recorded status or mode; names the contract knows stay as they are."""
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in names.items() for x in p]), recorded), recorded)


def retry_class(status_code: Column) -> Column:
    """SUCCESS, RETRYABLE (rate limit or server failure) or REVIEW (everything else)."""
    return (
        F.when(status_code.between(200, 299), "SUCCESS")
        .when((status_code == 429) | status_code.between(500, 599), "RETRYABLE")
        .otherwise("REVIEW")
    )


def retry_delay(status_code: Column, attempt: Column, max_attempts: int = MAX_ATTEMPTS) -> Column:
    """Seconds to wait before the next attempt (1, 2, 4, ...); null when there is none."""
    again = (retry_class(status_code) == "RETRYABLE") & (attempt < max_attempts)
    return F.when(again, F.pow(F.lit(2), attempt - 1).cast("bigint"))


def secret_scan(df: DataFrame, id_column: str, columns: Sequence[str]) -> DataFrame:
    """Evidence rows and columns that hold credential-like text, with the number of hits."""
    hits = F.array(*[F.struct(F.lit(c).alias("column_name"), credential_count(F.col(c)).alias("hits")) for c in columns])
    return df.select(id_column, F.explode(F.filter(hits, lambda h: h["hits"] > 0)).alias("h")).select(
        id_column, "h.column_name", F.col("h.hits").cast("bigint").alias("hits")
    )


def retention_due(artifacts: DataFrame, protected: DataFrame, id_column: str, at: str, as_of: Column) -> DataFrame:
    """Artifacts past the retention period that nothing active, published, held or under review refers to."""
    old = artifacts.filter(F.col(at) < as_of - F.expr(f"interval {RETENTION_YEARS} year"))
    return old.join(protected.select(id_column), id_column, "left_anti")


STATE_COLUMNS = {
    "n_value": "VALUE",
    "n_zero": "ZERO",
    "n_null": "NULL",
    "n_unknown": "UNKNOWN",
    "n_suppressed": "SUPPRESSED",
    "n_not_reported": "NOT_REPORTED",
    "n_missing": "MISSING",
}


def conform_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    measure: str,
    state: str,
    method: str | Sequence[str] = "SUM",
    weight: str | None = None,
) -> DataFrame:
    """Aggregate a measure without turning missing values into zero, by one method or by several at once.

    Only VALUE and ZERO rows enter the measure; a group without any gives null. Counts of every
    value state stand beside it. RATE divides by, and AREA_WEIGHTED_MEAN weights with, ``weight``
    of the rows that entered. All methods come out of one scan and one aggregate, one row each.
    """
    methods = [method] if isinstance(method, str) else list(method)
    usable = F.col(state).isin("VALUE", "ZERO") & F.col(measure).isNotNull()
    value = F.when(usable, F.col(measure))
    sums = [F.sum(value).alias("__sum"), F.avg(value).alias("__mean")]
    totals = {"SUM": F.col("__sum"), "MEAN": F.col("__mean")}
    if weight is not None:
        sums += [F.sum(F.when(usable, F.col(weight))).alias("__base"), F.sum(value * F.col(weight)).alias("__weighted")]
        over = lambda top: F.when(F.col("__base") != 0, F.col(top) / F.col("__base"))
        totals |= {"RATE": over("__sum"), "AREA_WEIGHTED_MEAN": over("__weighted")}
    for name in methods:
        if name in ("RATE", "AREA_WEIGHTED_MEAN") and weight is None:
            raise ValueError(f"{name} needs a weight column")
        if name not in totals:
            raise ValueError(f"unknown aggregation method: {name}")
    counts = [F.count_if(F.col(state) == s).alias(n) for n, s in STATE_COLUMNS.items()]
    sums = df.groupBy(*keys).agg(*sums, *counts)
    # One method keeps the measure's own type; several share one.
    kind = None if len(methods) == 1 else "double"
    rows = [F.struct((totals[m] if kind is None else totals[m].cast(kind)).alias("measure"), F.lit(m).alias("aggregation_method")) for m in methods]
    out = sums.withColumn("__r", F.explode(F.array(*rows)))
    return out.select(*keys, "__r.measure", *STATE_COLUMNS, "__r.aggregation_method")


def feature_snapshot(
    conformed: DataFrame,
    keys: Sequence[str],
    version: str,
    features: Mapping[str, str],
    definition_version: str,
    as_of: str,
    caveat: str,
) -> DataFrame:
    """Versioned feature rows per key that carry their input versions.

    Sums are taken per (key, source version) first: that gives the number and range of input
    versions without collecting them.
    """
    per_version = conformed.groupBy(*keys, version).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(column).alias(name) for name, column in features.items()]
    )
    return per_version.groupBy(*keys).agg(
        F.sum("n").alias("input_rows"),
        *[F.sum(name).alias(name) for name in features],
        F.count(F.lit(1)).alias("input_versions"),
        F.min(version).alias("first_version"),
        F.max(version).alias("last_version"),
    ).withColumns(
        {
            "definition_version": F.lit(definition_version),
            "as_of": F.lit(as_of),
            "caveat": F.lit(caveat),
        }
    )


def profile_sample(df: DataFrame, columns: Sequence[str], exact: bool = False) -> DataFrame:
    """Rows, nulls, distinct values, minimum and maximum per column, one row per column, in one aggregate.

    Distinct counts are sketches unless ``exact``.
    """
    distinct = F.count_distinct if exact else F.approx_count_distinct
    measures = [F.count(F.lit(1)).alias("rows")]
    for i, name in enumerate(columns):
        measures += [
            F.count_if(F.col(name).isNull()).alias(f"n{i}"),
            distinct(F.col(name)).alias(f"d{i}"),
            F.min(name).cast("string").alias(f"l{i}"),
            F.max(name).cast("string").alias(f"h{i}"),
        ]
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.col("rows").alias("row_count"),
                F.col(f"n{i}").alias("null_count"),
                F.col(f"d{i}").alias("distinct_count"),
                F.col(f"l{i}").alias("min_value"),
                F.col(f"h{i}").alias("max_value"),
            )
            for i, name in enumerate(columns)
        ]
    )
    return df.agg(*measures).select(F.inline(rows))


def observed_fields(df: DataFrame, payload: str) -> DataFrame:
    """Every top-level key seen in a VARIANT column and how many records have it."""
    names = F.map_keys(F.col(payload).cast("map<string,variant>"))
    return df.select(F.explode(names).alias("field_name")).groupBy("field_name").agg(F.count(F.lit(1)).alias("n_records"))


def observed_schema(df: DataFrame, payload: str) -> DataFrame:
    """One row: the merged schema of all records of a VARIANT column, keys in order."""
    return df.agg(F.schema_of_variant_agg(payload).alias("observed_schema"))


def missing_required(observed: DataFrame, required: Sequence[str]) -> DataFrame:
    """Required fields never observed."""
    names = F.array(*[F.lit(r) for r in required])
    wanted = observed.sparkSession.range(1).select(F.explode(names).alias("field_name"))
    return wanted.join(observed.select("field_name"), "field_name", "left_anti")


def profile_contract(profiles: DataFrame, order_clause: str = ":id ASC") -> DataFrame:
    """Violations of the access-profile contract, one row per profile and rule."""
    broken = F.array_compact(
        F.array(
            F.when(F.coalesce(F.length(F.trim(F.col("resource_key").cast("string"))), F.lit(0)) == 0, "resource_key_required"),
            F.when(~F.col("deterministic_order_clause").eqNullSafe(F.lit(order_clause)), "deterministic_order_required"),
        )
    )
    return profiles.select("source_access_profile_id", F.explode(broken).alias("violation"))


def ordered_sample(df: DataFrame, order: str, size: int = 25) -> DataFrame:
    """First ``size`` records by record id, 1 to 100; an empty source is an error."""
    if not 1 <= size <= 100:
        raise ValueError("sample size must be between 1 and 100")
    return require_rows(df.orderBy(F.asc_nulls_last(order)).limit(size))


def require_rows(sample: DataFrame) -> DataFrame:
    """Fail early on an empty sample (reads at most one row)."""
    if sample.isEmpty():
        raise ValueError("sample is empty")
    return sample
