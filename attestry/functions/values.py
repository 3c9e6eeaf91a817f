"""Typed extraction, value states, eras and scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Markers that stand for a missing number or code.
STATE_MARKERS = ("unknown", "suppressed", "not reported")
# Component weights in percent, and the score limits of each recommendation.
WEIGHTS = {"relevance": 25, "joinability": 25, "accessibility": 20, "documentation": 15, "quality": 15}
APPROVE_FROM = 70
CONDITIONAL_FROM = 50
# Surveillance eras (label, first year, last year; None is open).
ERAS = (("1992-2007", 1992, 2007), ("2008-2021", 2008, 2021), ("2022-current", 2022, None))


def type_payload(df: DataFrame, payload: str, fields: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Add typed columns: ``{column: (json key, type)}``. A value that does not fit the type is null."""
    # Quoted key: a name such as ":id" is not a plain path step.
    return df.withColumns(
        {out: F.try_variant_get(payload, f"$['{key}']", kind) for out, (key, kind) in fields.items()}
    )


def marker(text: Column, markers: Sequence[str] = STATE_MARKERS, trimmed: bool = False) -> Column:
    """The lower-cased marker, or null where the text is an ordinary value."""
    word = F.lower(F.trim(text)) if trimmed else F.lower(text)
    return F.when(word.isin(*markers), word)


def mark_value_states(
    fields: Mapping[str, Column],
    supplied: Column | None = None,
    markers: Sequence[str] = STATE_MARKERS,
    trimmed: bool = False,
) -> Column:
    """JSON object {field: marker} of the fields holding one; a supplied object wins; ``{}`` if none."""
    found = F.to_json(F.struct(*[marker(c, markers, trimmed).alias(name) for name, c in fields.items()]))
    return found if supplied is None else F.coalesce(F.to_json(supplied), found)


def value_state(payload: Column, key: str, markers: Sequence[str] = STATE_MARKERS) -> Column:
    """One of MISSING, NULL, a marker in capitals, ZERO or VALUE, for one key of a VARIANT record."""
    path = f"$['{key}']"
    text = F.try_variant_get(payload, path, "string")
    absent = F.when(F.variant_get(payload, path, "variant").isNull(), "MISSING").otherwise("NULL")
    word = F.lower(text)
    return (
        F.when(text.isNull(), absent)
        .when(word.isin(*markers), F.upper(F.replace(word, F.lit(" "), F.lit("_"))))
        .when(F.try_variant_get(payload, path, "double") == 0, "ZERO")
        .otherwise("VALUE")
    )


@dataclass(frozen=True)
class Semantics:
    """Meaning that a conformed relation carries with every row."""

    geography_semantics: str
    source_resolution: str
    temporal_window: str
    caveat: str


# Semantics of the county surveillance source.
COUNTY_SURVEILLANCE = Semantics(
    geography_semantics="COUNTY_OF_RESIDENCE",
    source_resolution="COUNTY_YEAR_CASE_STATUS_SEX_AGE",
    temporal_window="ANNUAL_SURVEILLANCE_YEAR",
    caveat="2022-current surveillance era; not comparable to prior eras without review",
)


def annotate_semantics(df: DataFrame, semantics: Semantics) -> DataFrame:
    return df.withColumns({name: F.lit(text) for name, text in vars(semantics).items()})


def tag_era(year: Column, eras: Sequence[tuple[str, int, int | None]] = ERAS) -> Column:
    """Era label of a year; null before the first era or in a gap."""
    label = F.lit(None).cast("string")
    for name, first, last in reversed(eras):
        inside = (year >= first) if last is None else year.between(first, last)
        label = F.when(inside, F.lit(name)).otherwise(label)
    return label


def overall_score(components: Mapping[str, Column]) -> Column:
    """Weighted mean of the five components."""
    total = F.lit(0)
    for name, weight in WEIGHTS.items():
        total = total + components[name] * weight
    return total / 100


def recommend(score: Column) -> Column:
    return (
        F.when(score >= APPROVE_FROM, "APPROVED")
        .when(score >= CONDITIONAL_FROM, "CONDITIONAL")
        .when(score.isNotNull(), "REJECTED")
    )


def score_sources(df: DataFrame) -> DataFrame:
    """Add ``overall_score`` (stored with two decimals) and ``recommendation`` (from the unrounded score)."""
    score = overall_score({name: F.col(f"{name}_score") for name in WEIGHTS})
    return (
        df.withColumn("__score", score)
        .withColumn("overall_score", F.col("__score").cast("decimal(5,2)"))
        .withColumn("recommendation", recommend(F.col("__score")))
        .drop("__score")
    )
