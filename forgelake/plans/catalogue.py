"""All queries of the core and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from forgelake.plans import ordered_queries, p2_drift, p5_nested, p6_heavy_keys, p7_times, relational_queries, text_queries

_PARTS = (relational_queries, ordered_queries, text_queries, p2_drift, p5_nested, p6_heavy_keys, p7_times)

QUERIES = {name: q for part in _PARTS for name, q in part.QUERIES.items()}
SQL = {name: q for part in _PARTS for name, q in part.SQL.items()}


def flagship(spark: SparkSession, d: str) -> DataFrame:
    return relational_queries.flagship(spark, d)
