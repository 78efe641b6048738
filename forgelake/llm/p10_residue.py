"""Problem 10: template residue and error-page text in documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from forgelake.llm.residue import classified, messages
from forgelake.sources.tables import table


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents", "doc_id", "source", "text")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return classified(_docs(spark, d), "text", "source").where("residue is not null").select("doc_id")


def p10_kept(spark: SparkSession, d: str) -> DataFrame:
    """The documents without residue."""
    return classified(_docs(spark, d), "text", "source").where("residue is null").select("doc_id", "source", "text")


def p10_messages(spark: SparkSession, d: str) -> DataFrame:
    """The masked residue texts, by class and spread."""
    return messages(_docs(spark, d), "text", "source")


QUERIES = {"p10_found": p10_found, "p10_kept": p10_kept, "p10_messages": p10_messages}
SQL: dict[str, str] = {}
