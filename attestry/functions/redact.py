"""Keep credentials out of evidence."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sensitive names, the credential pattern, the mask and the text limit.
SENSITIVE_NAMES = ("authorization", "x-api-key", "x-app-token", "password", "token", "secret")
CREDENTIAL_PATTERN = r"(?i)((?:token|secret|password|private[_ -]?key|authorization)\s*[=:]\s*)\S+"
MASK = "[REDACTED]"
TEXT_LIMIT = 4000


def redact_map(pairs: Column, extra_names: Iterable[str] = ()) -> Column:
    """Mask the values of sensitive keys (any letter case) in a string map."""
    names = [*SENSITIVE_NAMES, *[n.lower() for n in extra_names]]
    return F.transform_values(pairs, lambda k, v: F.when(F.lower(k).isin(*names), F.lit(MASK)).otherwise(v))


def redact_values(pairs: Column) -> Column:
    """Mask credentials that sit inside the values of a map, such as a URL with a token."""
    return F.transform_values(pairs, lambda _, v: F.regexp_replace(v, CREDENTIAL_PATTERN, "$1" + MASK))


def redact_text(text: Column, limit: int | None = TEXT_LIMIT) -> Column:
    """Mask the word after a credential name and ``=`` or ``:``; then cut messages to ``limit``."""
    masked = F.regexp_replace(text, CREDENTIAL_PATTERN, "$1" + MASK)
    return masked if limit is None else F.left(masked, F.lit(limit))


def credential_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(CREDENTIAL_PATTERN))


def strip_query(url: Column) -> Column:
    """The endpoint without its query string."""
    return F.substring_index(url, "?", 1)
