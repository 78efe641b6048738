"""Whole flows: repositories to output records, and captured pages to requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake.config import EngineConfig
from forgelake.functions import html as H
from forgelake.functions import jsonx as J
from forgelake.functions import text as X
from forgelake.operators import relational as R
from forgelake.operators.ordered import first_rows, top_rows


def to_do(repos: DataFrame, done: DataFrame, config: EngineConfig) -> DataFrame:
    """The listed repositories that reach the threshold and have no output yet."""
    return R.not_done(R.at_least(repos, "stars", config.min_stars), done, ["url"])


def output_records(repos: DataFrame, stats: DataFrame, pulls: DataFrame, commits: DataFrame, config: EngineConfig, crawled_at: str) -> DataFrame:
    """Output rows with meets_requirement.

    repos: url, stars, language. stats: url and the statistics. pulls: the
    normalised requests with repo_url. commits: repo_url, pos, sha. The nested
    arrays are built here, at the sink, and nowhere before. error says why a
    repository has no requests to offer.
    """
    closed = F.lower("state").isin("closed", "merged")
    numbered = pulls.withColumn("__closed", F.coalesce(closed, F.lit(False)))
    counts = numbered.groupBy(F.col("repo_url").alias("url")).agg(F.count_if("__closed").alias("__n"))
    fields = [c for c in pulls.columns if c != "repo_url"]
    nested = pulls.groupBy(F.col("repo_url").alias("url")).agg(F.array_sort(F.collect_list(F.struct(*fields)), lambda a, b: F.when(a["number"] > b["number"], -1).when(a["number"] < b["number"], 1).otherwise(0)).alias("pull_requests"))
    history = commits.where(F.col("pos") < config.commit_limit).groupBy(F.col("repo_url").alias("url")).agg(F.array_sort(F.collect_list(F.struct("pos", "sha"))).alias("__h"))
    names = [c for c in stats.columns if c != "url"]
    all_of = repos.join(stats.select("url", F.struct(*names).alias("stats")), "url", "left").join(counts, "url", "left").join(nested, "url", "left").join(history, "url", "left")
    target = F.least(F.lit(config.closed_limit), F.col("stats.closed_pull_requests"))
    error = F.when(~F.coalesce(F.col("stats.pr_counts_available"), F.lit(False)), "counts unavailable").when(F.col("stats.closed_pull_requests") == 0, "no closed requests")
    return all_of.select(
        "url", "stars", "language", "stats", F.coalesce("pull_requests", F.array()).alias("pull_requests"), F.transform(F.coalesce("__h", F.array()), lambda x: x["sha"]).alias("commit_ids") if config.with_commits else F.expr("cast(array() as array<string>)").alias("commit_ids"),
        F.lit(crawled_at).alias("crawl_timestamp"), error.isNull().alias("crawl_success"), error.alias("error_message"), (error.isNull() & (F.coalesce("__n", F.lit(0)) >= config.coverage * target)).alias("meets_requirement"),
    )


def discovered(pages: DataFrame, config: EngineConfig) -> DataFrame:
    """repo_url, number, url: the newest requests that listing pages (kind `pulls`) lead to, as many per repository as its limit allows."""
    links = pages.where("page_kind = 'pulls'").select("repo_url", F.explode(H.hrefs(F.col("html"))).alias("href"))
    urls = links.select("repo_url", X.without_suffix(X.absolute(F.col("href"), F.col("repo_url"))).alias("u"))
    own = urls.where(X.belongs_to(F.col("u"), F.col("repo_url"))).select("repo_url", X.pull_number(F.col("u")).alias("number"), X.canonical_pull(F.col("u")).alias("url")).where("number is not null").distinct()
    limit = F.lit(config.closed_limit)
    for repo, n in config.limit_by_repo.items():
        limit = F.when(F.col("repo_url") == repo, n).otherwise(limit)
    return top_rows(own.withColumn("__limit", limit), ["repo_url"], F.col("__limit"), [F.desc("number")]).drop("__limit", "rank")


def fetched(found: DataFrame, cached: DataFrame, pages: DataFrame, config: EngineConfig) -> DataFrame:
    """The requests of found: cached ones as they are, others extracted from their captured pages; once per number.

    Pages are joined before anything is extracted from them, so only wanted
    pages are parsed. Issues that a request refers to come with it (first by
    links, then by text), never the request itself.
    """
    missing = R.not_done(found, cached, ["repo_url", "number"])
    detail = pages.where("page_kind = 'pr'").select("repo_url", F.col("item_no").alias("number"), "html")
    rows = missing.join(detail, ["repo_url", "number"]).withColumn("f", H.page_fields(F.col("html"), False, config.comment_min, config.comment_max))
    low, high = config.issue_numbers
    refs = F.slice(F.array_distinct(F.concat(X.issue_link_refs(F.col("html")), X.issue_refs(F.coalesce("f.text", F.lit(""))))), 1, config.issues_from_page)
    refs = F.filter(F.slice(refs, 1, config.issues_per_pull), lambda n: n.between(low, high) & (n != F.col("number")))
    rows = rows.select("repo_url", "number", "f.title", "f.state", "f.author", "f.created_at", F.col("f.created_at").alias("updated_at"), "f.tags", "f.comments", "url", F.coalesce(refs, F.expr("cast(array() as array<bigint>)")).alias("related_numbers"), F.coalesce(X.merge_sha(F.col("f.text")), F.get(X.commit_links(F.col("html")), F.lit(0)), F.lit("")).alias("commit_id"))
    every = cached.select(*rows.columns).withColumn("__part", F.lit(0)).unionByName(rows.withColumn("__part", F.lit(1)))
    return first_rows(every, ["repo_url", "number"], ["__part"]).drop("__part")


def commit_history(pages: DataFrame, config: EngineConfig) -> DataFrame:
    """repo_url, pos, sha: the newest commits that listing pages (kind `commits`) lead to, each at its first place.

    Pages end at the first one without commits; what lies behind it belongs to
    no history. At most commit_limit per repository.
    """
    links = pages.where("page_kind = 'commits'").select("repo_url", "page_no", X.commit_links(F.col("html")).alias("shas"))
    end = links.where(F.size("shas") == 0).groupBy("repo_url").agg(F.min("page_no").alias("__end"))
    rows = links.join(end, "repo_url", "left").where("__end is null or page_no < __end").select("repo_url", "page_no", F.posexplode("shas").alias("i", "sha"))
    first = first_rows(rows, ["repo_url", "sha"], ["page_no", "i"])
    kept = top_rows(first, ["repo_url"], config.commit_limit, [F.asc("page_no"), F.asc("i")])
    return kept.select("repo_url", (F.col("rank") - 1).alias("pos"), "sha")


def issue_records(pages: DataFrame, config: EngineConfig) -> DataFrame:
    """repo_url, number and fields of captured issue pages; comments from the page's JSON where it has some, else from its elements."""
    rows = pages.where("page_kind = 'issue'").withColumn("f", H.page_fields(F.col("html"), True, config.comment_min, config.comment_max)).withColumn("j", J.page_comments(F.col("html")))
    body = X.clean_body(F.coalesce("f.body", F.lit("")))
    first = F.when((F.length("f.body") > config.body_min) & (F.length(body) > config.body_min), F.array(F.struct(F.col("f.author").alias("author"), F.col("f.created_at").alias("timestamp"), X.shortened(body, config.comment_max).alias("content"))))
    shown = F.concat(F.coalesce(first, F.expr("cast(array() as array<struct<author:string,timestamp:string,content:string>>)")), F.col("f.comments"))
    comments = F.when(F.size("j") > 0, F.col("j")).otherwise(shown)
    return rows.select("repo_url", F.col("item_no").alias("number"), "f.title", "f.state", "f.author", "f.created_at", F.col("f.created_at").alias("updated_at"), "f.tags", comments.alias("comments"), "url", (F.col("f.title") != "").alias("ok"))


def with_previous(pulls: DataFrame, commits: DataFrame) -> DataFrame:
    """pulls with previous_commit_id: the commit behind commit_id in the repository's newest-first history; '' where there is none.

    A commit is looked up at its first position, by a join on numbered
    positions, whatever the length of the history.
    """
    first = commits.groupBy("repo_url", F.col("sha").alias("commit_id")).agg(F.min("pos").alias("__pos"))
    behind = commits.select("repo_url", (F.col("pos") - 1).alias("__pos"), F.col("sha").alias("previous_commit_id"))
    found = pulls.join(first, ["repo_url", "commit_id"], "left").join(behind, ["repo_url", "__pos"], "left").drop("__pos")
    return found.withColumn("previous_commit_id", F.coalesce("previous_commit_id", F.lit("")))


def repository_statistics(pages: DataFrame, issues: DataFrame) -> DataFrame:
    """url and statistics from captured repository and listing pages (kinds `repo`, `pulls`).

    issues: repo_url, number of known issues; the highest number bounds how
    many there ever were.
    """
    number = lambda c: F.coalesce(X.compact_count(c), F.lit(0).cast("bigint"))
    first = lambda href: F.get(F.filter(H.anchor_texts(F.col("html"), href), lambda t: t.rlike(r"\d")), F.lit(0))
    repo = pages.where("page_kind = 'repo'").select("repo_url", number(first("/graphs/contributors")).alias("contributors_count"), number(F.coalesce(first("/forks"), first("/network/members"))).alias("forks_count"), number(first(r"/issues(?:\"|\?|$)?")).alias("open_issues"))
    repo = repo.groupBy("repo_url").agg(*[F.max(c).alias(c) for c in repo.columns if c != "repo_url"])
    state = lambda s: F.coalesce(*[first(p) for p in (rf"/pulls\?q=is%3A{s}", rf"/pulls\?q=is%3Apr\+is%3A{s}", rf"/pulls\?q=is%3A{s}\+is%3Apr")])
    pulls = pages.where("page_kind = 'pulls'").select("repo_url", X.compact_count(state("open")).alias("o"), X.compact_count(state("closed")).alias("c")).groupBy("repo_url").agg(F.max("o").alias("o"), F.max("c").alias("c"))
    top = issues.groupBy("repo_url").agg(F.max("number").alias("__last"))
    r = repo.join(pulls, "repo_url", "left").join(top, "repo_url", "left")
    zero = F.lit(0).cast("bigint")
    o, c, last = F.coalesce("o", zero), F.coalesce("c", zero), F.coalesce("__last", zero)
    closed = F.greatest(zero, last - F.col("open_issues") - o - c)
    return r.select(F.col("repo_url").alias("url"), "contributors_count", "forks_count", (F.col("open_issues") + closed).alias("total_issues"), "open_issues", closed.alias("closed_issues"), (o + c).alias("total_pull_requests"), o.alias("open_pull_requests"), c.alias("closed_pull_requests"), (F.col("o").isNotNull() | F.col("c").isNotNull()).alias("pr_counts_available"))


def dry_run(repos: DataFrame, done: DataFrame, config: EngineConfig, n: int = 10) -> DataFrame:
    """The first repositories that a run would take, and how many more."""
    return R.preview(to_do(repos, done, config).select("url", "stars"), [F.desc("stars"), F.asc("url")], n)
