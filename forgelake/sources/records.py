"""JSON and JSONL files of records: inputs, outputs, caches, states and failures."""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake import schemas


def usable_paths(paths: Sequence[str]) -> list[str]:
    """The paths that are files (local paths only; others are taken as given)."""
    return [p for p in paths if "://" in p or Path(p).is_file()]


def read_inputs(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """file, language, summary, repositories: one row per readable input document, in the order of paths; broken ones are left out."""
    df = spark.read.schema(schemas.INPUT + ", _corrupt_record string").option("multiLine", True).option("mode", "PERMISSIVE").json(list(paths)).withColumn("file", F.input_file_name())
    return df.where("_corrupt_record is null and repositories is not null").drop("_corrupt_record").select("file", "language", "summary", "repositories")


def repositories(inputs: DataFrame) -> DataFrame:
    """file, pos, url, stars, language of every listed repository."""
    return inputs.select("file", F.posexplode("repositories").alias("pos", "r")).select("file", "pos", "r.url", "r.stars", "r.language")


def read_outputs(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """All lines of output files; blank ones are skipped, broken ones come as _corrupt_record, ones without url have usable = false."""
    df = spark.read.schema(schemas.CRAWLED + ", _corrupt_record string").option("mode", "PERMISSIVE").json(paths if isinstance(paths, str) else list(paths))
    return df.withColumn("usable", F.col("_corrupt_record").isNull() & F.col("url").isNotNull())


def output_urls(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """The distinct urls of output files; only that field is parsed."""
    return spark.read.schema("url string").json(paths if isinstance(paths, str) else list(paths)).where("url is not null").distinct()


def known_urls(spark: SparkSession, folder: str) -> DataFrame:
    """The distinct urls of all output files of a folder."""
    return output_urls(spark, f"{folder}/*.jsonl")


def was_crawled(spark: SparkSession, folder: str, url: str) -> bool:
    """Whether any output file of a folder holds the url; the scan ends at the first hit."""
    return bool(spark.read.schema("url string").json(f"{folder}/*.jsonl").where(F.col("url") == url).limit(1).count())


def repo_key(url: Column) -> Column:
    """A file-safe key of a repository that doesn't collide: its readable form and a hash."""
    return F.concat(F.regexp_replace(F.regexp_replace(url, "^https?://", ""), "[^A-Za-z0-9.-]", "_"), F.lit("-"), F.substring(F.sha2(url, 256), 1, 12))


def cached_pulls(spark: SparkSession, folder: str, url: str | None = None) -> DataFrame:
    """The cached requests, of one repository (only its partition is read) or of all."""
    df = spark.read.schema(f"repo_url string, {schemas.PULL_REQUEST}, repo_key string").json(folder)
    if url is None:
        return df.drop("repo_key")
    key = spark.range(1).select(repo_key(F.lit(url)).alias("k")).first().k
    return df.where((F.col("repo_key") == key) & (F.col("repo_url") == url)).drop("repo_key")


def cached_numbers(spark: SparkSession, folder: str, url: str | None = None) -> DataFrame:
    """The distinct keys of the cached requests."""
    return cached_pulls(spark, folder, url).select("repo_url", "number").where("number is not null").distinct()


def crawl_states(spark: SparkSession, path: str) -> DataFrame:
    """States of crawls; fields that older files lack have their defaults."""
    df = spark.read.schema(schemas.CRAWL_STATE).option("multiLine", True).json(path)
    none = {"bigint": F.lit(0).cast("bigint"), "boolean": F.lit(False)}
    for f in df.schema:
        kind = f.dataType.simpleString()
        if kind in none:
            df = df.withColumn(f.name, F.coalesce(f.name, none[kind]))
        elif kind.startswith(("array", "map")):
            df = df.withColumn(f.name, F.coalesce(f.name, F.from_json(F.lit("[]" if kind.startswith("array") else "{}"), kind)))
    return df


def pr_commits(states: DataFrame) -> DataFrame:
    """repo_url, pr_number, pos, sha: the mapping of requests to commits as a typed child table."""
    pairs = states.select("repo_url", F.explode("pr_commit_mapping").alias("n", "shas"))
    return pairs.select("repo_url", F.col("n").try_cast("bigint").alias("pr_number"), F.posexplode("shas").alias("pos", "sha"))


def failures(spark: SparkSession, path: str, now_epoch: float, ttl_seconds: int = 604_800) -> DataFrame:
    """scope, repo_url, issue_number, reason, ts of the failures that haven't expired.

    Two older layouts are read as well: lists of numbers without times (they
    get the file's last_updated) and [reason, time] pairs.
    """
    raw = spark.read.option("wholetext", True).text(path).select(F.try_parse_json("value").alias("v"))
    last = F.coalesce(F.try_variant_get("v", "$.last_updated", "double"), F.lit(now_epoch))
    raw = raw.withColumn("last", last)
    issues = raw.select("last", F.explode(F.try_variant_get("v", "$.failed_issues", "map<string,variant>")).alias("repo_url", "x"))
    timed = F.transform(F.map_entries(F.try_variant_get("x", "$", "map<string,double>")), lambda e: F.struct(e["key"].alias("n"), e["value"].alias("ts")))
    listed = F.transform(F.try_variant_get("x", "$", "array<bigint>"), lambda n: F.struct(n.cast("string").alias("n"), F.col("last").alias("ts")))
    issues = issues.select("repo_url", F.inline(F.coalesce(timed, listed))).select(F.lit("issue").alias("scope"), "repo_url", F.col("n").try_cast("bigint").alias("issue_number"), F.lit(None).cast("string").alias("reason"), "ts")
    repos = raw.select(F.explode(F.try_variant_get("v", "$.failed_repositories", "map<string,variant>")).alias("repo_url", "x"))
    reason = F.coalesce(F.try_variant_get("x", "$.reason", "string"), F.try_variant_get("x", "$[0]", "string"))
    ts = F.coalesce(F.try_variant_get("x", "$.timestamp", "double"), F.try_variant_get("x", "$[1]", "double"))
    repos = repos.select(F.lit("repository").alias("scope"), "repo_url", F.lit(None).cast("bigint").alias("issue_number"), reason.alias("reason"), ts.alias("ts"))
    return issues.unionByName(repos).where(F.lit(now_epoch) - F.col("ts") < ttl_seconds)
