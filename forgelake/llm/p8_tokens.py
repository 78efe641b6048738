"""Problem 8: the whole corpus as token ids of a public tokenizer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.llm.tokenizer import encode_corpus, token_texts
from forgelake.sources.tables import table


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode_corpus(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text")


def p8_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Per source: texts, tokens, and texts that don't come back from their ids as they were (none)."""
    docs = table(spark, d, "documents", "doc_id", "text", "source")
    ids = docs.join(encode_corpus(docs, "doc_id", "text"), "doc_id").withColumn("back", token_texts(spark, F.col("ids")))
    return ids.groupBy("source").agg(F.count(F.lit(1)).alias("n_texts"), F.sum(F.size("ids").cast("bigint")).alias("n_tokens"), F.count_if(F.col("back") != F.coalesce("text", F.lit(""))).alias("n_changed"))


QUERIES = {"p8_ids": p8_ids, "p8_round_trip": p8_round_trip}
SQL: dict[str, str] = {}
