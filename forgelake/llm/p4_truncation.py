"""Problem 4: comments whose content lost its end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from forgelake.llm.truncation import rates, truncated
from forgelake.sources.tables import table


def _comments(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "comments", "comment_id", "content", "source")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return truncated(_comments(spark, d), "comment_id", "content", "source").select("comment_id")


def p4_rates(spark: SparkSession, d: str) -> DataFrame:
    """How often each source truncates."""
    return rates(_comments(spark, d), "comment_id", "content", "source")


QUERIES = {"p4_found": p4_found, "p4_rates": p4_rates}
SQL: dict[str, str] = {}
