"""All registered queries. Importing the modules registers them."""

from attestry.plans import analytics, checks, evidence, governed, review  # noqa: F401
from attestry.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
