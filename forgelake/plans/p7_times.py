"""Problem 7: mixed timestamp formats and time zones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.functions.timeparse import CANONICAL, ntz_micros, with_read_time
from forgelake.operators.timezones import estimate_zones, known_us, resolved_zones, to_instants, with_undeclared
from forgelake.sources.tables import table


def written_times(spark: SparkSession, d: str) -> DataFrame:
    """table_name, row_id, field_name, value, source of the four fields."""
    comments = table(spark, d, "comments", "comment_id", "posted_at", "source")
    pulls = table(spark, d, "pull_requests", "pr_id", "created_at", "updated_at", "source")
    repos = table(spark, d, "crawled_repositories", "crawl_id", "crawl_timestamp", "source")

    def rows(df: DataFrame, name: str, key: str, *fields: str) -> DataFrame:
        each = [F.struct(F.lit(f).alias("field_name"), F.col(f).alias("value")) for f in fields]
        return df.select(F.lit(name).alias("table_name"), F.col(key).alias("row_id"), F.explode(F.array(*each)).alias("x"), "source").select("table_name", "row_id", "x.field_name", "x.value", "source")

    return rows(comments, "comments", "comment_id", "posted_at").unionByName(rows(pulls, "pull_requests", "pr_id", "created_at", "updated_at")).unionByName(rows(repos, "crawled_repositories", "crawl_id", "crawl_timestamp"))


def observed_times(spark: SparkSession, d: str) -> DataFrame:
    """source, local_us and the bounds around it, of every local time of the tables."""
    comments = with_read_time(table(spark, d, "comments", "posted_at", "source", "ingested_at").where(~F.coalesce(F.col("posted_at").rlike(CANONICAL), F.lit(True))), "posted_at", "t")
    local = lambda t: F.when(F.col(f"{t}.kind") == "local", F.col(f"{t}.local_us")).alias("local_us")
    none = F.lit(None).cast("bigint")
    of_comments = comments.select("source", local("t"), none.alias("not_before_us"), ntz_micros(F.col("ingested_at")).alias("not_after_us"))
    pulls = with_read_time(with_read_time(table(spark, d, "pull_requests", "created_at", "updated_at", "source", "ingested_at"), "created_at", "c"), "updated_at", "u").withColumn("i", ntz_micros(F.col("ingested_at")))
    side = lambda t, low, high: F.struct(local(t), low.alias("not_before_us"), high.alias("not_after_us"))
    of_pulls = pulls.select("source", F.inline(F.array(side("c", none, F.least(known_us("u"), F.col("i"))), side("u", known_us("c"), F.col("i")))))
    repos = with_read_time(table(spark, d, "crawled_repositories", "crawl_timestamp", "source"), "crawl_timestamp", "t")
    of_repos = repos.select("source", local("t"), none.alias("not_before_us"), none.alias("not_after_us"))
    return of_comments.unionByName(of_pulls).unionByName(of_repos)


def p7_zones(spark: SparkSession, d: str) -> DataFrame:
    """The zone each clock was found to be in, and how many of its times speak against it."""
    return estimate_zones(observed_times(spark, d), table(spark, d, "capture_zones"))


def normalised(spark: SparkSession, d: str, times: DataFrame) -> DataFrame:
    declared = table(spark, d, "capture_zones")
    zones = resolved_zones(observed_times(spark, d), declared)
    return to_instants(times, "value", "source", with_undeclared(zones, declared))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    times = written_times(spark, d).where(~F.col("value").rlike(CANONICAL))
    return normalised(spark, d, times).where("status in ('exact', 'declared')").select("table_name", "row_id", "field_name", "utc_us").distinct()


def p7_normalised(spark: SparkSession, d: str) -> DataFrame:
    """Every value of the four fields with its instant, if it has one, and how that was found."""
    return normalised(spark, d, written_times(spark, d)).select("table_name", "row_id", "field_name", "utc_us", "status")


def p7_recovered(spark: SparkSession, d: str) -> DataFrame:
    """What estimation alone makes of each clock: the declared zone is hidden and sought among the declared zones of all clocks.

    source, declared_zone, estimated_zone, n (its local times), violations (of
    the estimated zone), declared_violations, as_good (the declared zone has no
    fewer). Zones that no time of a clock tells apart are equally good.
    """
    declared = table(spark, d, "capture_zones")
    hidden = declared.select(F.lit(None).cast("string").alias("source"), "zone_name")
    seen = observed_times(spark, d)
    found = estimate_zones(seen, hidden).select("source", F.col("zone").alias("estimated_zone"), "n", "violations")
    known = estimate_zones(seen, declared).select(F.col("source").alias("__s"), "declared_zone", "declared_violations")
    return found.join(known, F.col("source") == F.col("__s")).select("source", "declared_zone", "estimated_zone", "n", "violations", "declared_violations", (F.col("violations") <= F.col("declared_violations")).alias("as_good"))


QUERIES = {"p7_found": p7_found, "p7_zones": p7_zones, "p7_normalised": p7_normalised, "p7_recovered": p7_recovered}
SQL: dict[str, str] = {}
