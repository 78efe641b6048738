"""Problem 9: sources of documents mixed to the shares of mix_targets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.llm.mixing import mixture, plan, report
from forgelake.llm.tokenizer import token_count
from forgelake.session import written
from forgelake.sources.tables import table


def _mixed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, d, "documents", "doc_id", "source", "text")
    sized = written(docs.select("doc_id", "source", token_count(spark, F.col("text")).alias("n_tokens")), "p9-sizes")
    planned = plan(sized.groupBy("source").agg(F.sum("n_tokens").alias("available")), table(spark, d, "mix_targets"))
    return mixture(sized, planned, "doc_id", "source", "n_tokens"), planned


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d)[0]


def p9_report(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual share of each listed source."""
    return report(*_mixed(spark, d))


QUERIES = {"p9_mixture": p9_mixture, "p9_report": p9_report}
SQL: dict[str, str] = {}
