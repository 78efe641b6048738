"""Problem 1: personal information in comments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.llm.pii import masked_text, name_parts, types_of
from forgelake.sources.tables import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    comments = table(spark, d, "comments", "comment_id", "author", "content")
    lexicon = name_parts(comments, "author")
    both = comments.select("comment_id", F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("text")) for f in ("content", "author")])).alias("x")).select("comment_id", "x.*")
    kinds = both.select("comment_id", "field_name", types_of(F.col("text"), F.col("field_name"), lexicon).alias("kinds"))
    return kinds.select("comment_id", "field_name", F.explode("kinds").alias("pii_type")).distinct()


def p1_masked(spark: SparkSession, d: str) -> DataFrame:
    """Every comment with typed placeholders in place of personal information."""
    comments = table(spark, d, "comments", "comment_id", "author", "content")
    lexicon = name_parts(comments, "author")
    return comments.select("comment_id", masked_text(F.col("author"), F.lit("author"), lexicon).alias("author"), masked_text(F.col("content"), F.lit("content"), lexicon).alias("content"))


QUERIES = {"p1_found": p1_found, "p1_masked": p1_masked}
SQL: dict[str, str] = {}
