"""Problem 3: page text around comments and in the titles of issues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.llm.chrome import fitted, holds_page_text, main_text, node_counts, path_statistics
from forgelake.sources.tables import table


def _texts(spark: SparkSession, d: str) -> DataFrame:
    comments = table(spark, d, "comments", "comment_id", "content").select(F.lit("comment").alias("record_kind"), F.col("comment_id").alias("record_id"), F.col("content").alias("text"), F.lit(False).alias("is_title"))
    issues = table(spark, d, "issues", "issue_id", "title").select(F.lit("issue").alias("record_kind"), F.col("issue_id").alias("record_id"), F.col("title").alias("text"), F.lit(True).alias("is_title"))
    return comments.unionByName(issues)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    texts = _texts(spark, d)
    return texts.where(holds_page_text(F.col("text"), F.col("is_title"), *fitted(texts, "text", "is_title"))).select("record_kind", "record_id").distinct()


def p3_main_text(spark: SparkSession, d: str) -> DataFrame:
    """Every text with only what its author wrote."""
    texts = _texts(spark, d)
    return texts.select("record_kind", "record_id", main_text(F.col("text"), F.col("is_title"), *fitted(texts, "text", "is_title")).alias("text"))


def p3_paths(spark: SparkSession, d: str) -> DataFrame:
    """The paths of all nodes with their sums of text and punctuation."""
    return path_statistics(node_counts(_texts(spark, d), "text", "is_title"))


QUERIES = {"p3_found": p3_found, "p3_main_text": p3_main_text, "p3_paths": p3_paths}
SQL: dict[str, str] = {}
