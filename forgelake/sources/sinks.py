"""Writers of records. Spark's commit protocol makes each write whole or absent; no file is appended to by two tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake.sources.records import repo_key


def output_name(stem: str, min_stars: int) -> str:
    """The name of the output of an input file."""
    return f"{stem}_crawled_stars_{min_stars}.jsonl"


def write_records(df: DataFrame, path: str, append: bool = True) -> None:
    """One JSON object per line, nulls kept out, all characters as they are. Writing no rows succeeds."""
    df.write.mode("append" if append else "overwrite").json(path)


def write_pull_cache(df: DataFrame, path: str) -> None:
    """Requests by repository, one folder each; df has repo_url. Rows are spread by repository and number, so a hot one has several writers."""
    keyed = df.withColumn("repo_key", repo_key(F.col("repo_url")))
    keyed.repartition("repo_key", F.pmod(F.xxhash64("number"), F.lit(16))).write.mode("append").partitionBy("repo_key").json(path)


def save_state(df: DataFrame, path: str) -> None:
    """The whole state table anew."""
    df.write.mode("overwrite").parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    """Child rows (commits, mappings, failures) behind what is there."""
    df.write.mode("append").parquet(path)


def drop_keys(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """The table without some keys, to be saved in its place."""
    return df.join(keys.select(*on), on, "left_anti")
