"""Governed data pipelines on Spark: ledgers, review gates, provenance and quality as DataFrame operators."""

__version__ = "0.1.0"
