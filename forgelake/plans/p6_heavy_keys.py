"""Problem 6: a few repositories hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.operators.shredding import rebuild, shred
from forgelake.operators.tree_aggregate import heavy_keys, tree_aggregate
from forgelake.sources.tables import table

#: The share of all rows from which a repository counts as heavy.
HEAVY = 0.02


def p6_pull_counts(spark: SparkSession, d: str) -> DataFrame:
    """Per repository: stored rows of pull_requests, by state (of any case), and the span of numbers."""
    pulls = table(spark, d, "pull_requests", "repo_url", "number", "state")
    one = F.lit(1)
    of = lambda s: ("count", F.when(F.lower("state") == s, one))
    return tree_aggregate(pulls, ["repo_url"], {"n_rows": ("count", one), "n_open": of("open"), "n_closed": of("closed"), "n_merged": of("merged"), "n_without_state": ("count", F.when(F.col("state").isNull(), one)), "first_number": ("min", F.col("number")), "last_number": ("max", F.col("number"))})


def p6_comment_counts(spark: SparkSession, d: str) -> DataFrame:
    """Per repository: stored comments, by kind of parent, and the characters they hold."""
    comments = table(spark, d, "comments", "repo_url", "parent_kind", "content")
    one = F.lit(1)
    return tree_aggregate(comments, ["repo_url"], {"n_rows": ("count", one), "n_on_prs": ("count", F.when(F.col("parent_kind") == "pr", one)), "n_on_issues": ("count", F.when(F.col("parent_kind") == "issue", one)), "n_chars": ("sum", F.length("content").cast("bigint"))})


def p6_nested_counts(spark: SparkSession, d: str) -> DataFrame:
    """Per repository: requests nested in the lines of crawl files, by state, as stored."""
    lines = table(spark, d, "crawl_lines", "raw_line").select(F.try_variant_get(F.try_parse_json("raw_line"), "$.url", "string").alias("repo_url"), "raw_line")
    pulls = rebuild(shred(lines, ["repo_url"], "raw_line", r"pull_requests(?:\[\]\.state)?$"), ["repo_url"], {"pull_request": r"pull_requests\[\]"}, {"state": ["state"]})
    one = F.lit(1)
    of = lambda s: ("count", F.when(F.lower("state") == s, one))
    return tree_aggregate(pulls, ["repo_url"], {"n_rows": ("count", one), "n_open": of("open"), "n_closed": of("closed"), "n_merged": of("merged")})


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    pulls = table(spark, d, "pull_requests", "repo_url")
    counts = tree_aggregate(pulls, ["repo_url"], {"n_rows": ("count", F.lit(1))})
    return heavy_keys(counts, ["repo_url"], "n_rows", HEAVY).where("repo_url is not null").select("repo_url")


QUERIES = {"p6_found": p6_found, "p6_pull_counts": p6_pull_counts, "p6_comment_counts": p6_comment_counts, "p6_nested_counts": p6_nested_counts}
SQL = {
    "p6_found": "select repo_url from pull_requests group by repo_url having repo_url is not null and count(*) >= 0.02 * (select count(*) from pull_requests)",
    "p6_pull_counts": """
        select repo_url, count(*) n_rows, count(*) filter (lower(state) = 'open') n_open, count(*) filter (lower(state) = 'closed') n_closed,
               count(*) filter (lower(state) = 'merged') n_merged, count(*) filter (state is null) n_without_state, min(number) first_number, max(number) last_number
        from pull_requests group by repo_url""",
    "p6_comment_counts": """
        select repo_url, count(*) n_rows, count(*) filter (parent_kind = 'pr') n_on_prs, count(*) filter (parent_kind = 'issue') n_on_issues,
               cast(sum(length(content)) as bigint) n_chars
        from comments group by repo_url""",
    "p6_nested_counts": """
        with l as (select try_cast(raw_line as json) j from crawl_lines), o as (select j from l where json_type(j) = 'OBJECT' and json_type(j, '$.pull_requests') = 'ARRAY'),
        p as (select json_extract_string(j, '$.url') repo_url, unnest(cast(json_extract(j, '$.pull_requests') as json[])) p from o)
        select repo_url, count(*) n_rows, count(*) filter (lower(json_extract_string(p, '$.state')) = 'open') n_open, count(*) filter (lower(json_extract_string(p, '$.state')) = 'closed') n_closed,
               count(*) filter (lower(json_extract_string(p, '$.state')) = 'merged') n_merged from p group by repo_url""",
}
