"""Filters, joins, sets, limits and aggregates of the catalogue, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.functions import text as X
from forgelake.operators import metrics as M
from forgelake.operators import relational as R
from forgelake.operators.ordered import first_rows, latest_rows, top_rows
from forgelake.operators.state import alive
from forgelake.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f"q_{f.__name__}"] = f
        if sql:
            SQL[f"q_{f.__name__}"] = sql
        return f

    return keep


def latest_crawls(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """url and columns of the newest crawl of each repository (the highest crawl_id); nothing else is read."""
    return latest_rows(table(spark, d, "crawled_repositories", "url", "crawl_id", *columns), ["url"], ["crawl_id"], columns)


LATEST = "latest as (select * from crawled_repositories qualify row_number() over (partition by url order by crawl_id desc) = 1)"


@query("select crawl_id, url, stars from crawled_repositories where stars >= 5000")
def threshold_filter(spark, d):
    return R.at_least(R.at_least(table(spark, d, "crawled_repositories", "crawl_id", "url", "stars"), "stars", 1000), "stars", 5000)


@query("select crawl_id, url from crawled_repositories c where not exists (select 1 from issues i where i.repo_url = c.url)")
def uncrawled_anti(spark, d):
    done = table(spark, d, "issues", "repo_url").withColumnRenamed("repo_url", "url").distinct()
    return R.not_done(table(spark, d, "crawled_repositories", "crawl_id", "url"), done, ["url"])


@query("select crawl_id, url from crawled_repositories c where exists (select 1 from issues i where i.repo_url = c.url)")
def done_semi(spark, d):
    done = table(spark, d, "issues", "repo_url").withColumnRenamed("repo_url", "url").distinct()
    return R.already_done(table(spark, d, "crawled_repositories", "crawl_id", "url"), done, ["url"])


@query("""
    with t as (select crawl_id, url, case when exists (select 1 from crawled_repositories k where k.url = c.url and k.crawl_success and k.source = 'crawler_a') then 'current'
        when exists (select 1 from pr_issue p where p.repo_url = c.url) then 'other_output' when exists (select 1 from issues i where i.repo_url = c.url) then 'recent' end skip_reason from crawled_repositories c)
    select skip_reason, count(*) n, count(distinct url) n_repos from t group by skip_reason""")
def skip_reason_tiers(spark, d):
    repos = table(spark, d, "crawled_repositories", "crawl_id", "url", "crawl_success", "source")
    tiers = {"current": repos.where("crawl_success and source = 'crawler_a'").select("url"), "other_output": table(spark, d, "pr_issue", "repo_url").toDF("url"), "recent": table(spark, d, "issues", "repo_url").toDF("url")}
    return R.tiered_skips(repos.select("crawl_id", "url"), "url", tiers).groupBy("skip_reason").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("url").alias("n_repos"))


@query("""
    with c as (select repo_url, pr_number number, min(issue_number) issue_number from pr_issue group by all)
    select pr_id, coalesce(c.issue_number, -1) issue_number, c.number is not null hit from pull_requests p left join c using (repo_url, number)""")
def cache_lookup_split(spark, d):
    cache = table(spark, d, "pr_issue", "repo_url", "pr_number", "issue_number").withColumnRenamed("pr_number", "number")
    return R.split_by_cache(table(spark, d, "pull_requests", "pr_id", "repo_url", "number"), cache, ["repo_url", "number"], "issue_number", -1).select("pr_id", "issue_number", "hit")


@query("""
    with o as (select repo_url, number, pr_id from pull_requests where source = 'cache_jsonl'),
    n as (select repo_url, number, min(pr_id) pr_id from pull_requests where source is distinct from 'cache_jsonl' group by all)
    select * from o union all select * from n where not exists (select 1 from o where o.repo_url = n.repo_url and o.number = n.number)""")
def merge_delta(spark, d):
    pulls = table(spark, d, "pull_requests", "repo_url", "number", "pr_id", "source")
    cached = F.col("source").eqNullSafe("cache_jsonl")
    return R.merge_new(pulls.where(cached).drop("source"), pulls.where(~cached).drop("source"), ["repo_url", "number"], ["pr_id"])


@query("""
    with s as (select distinct substr(h, 1, 7) short_sha from (select unnest(regexp_extract_all(content, 'After ([0-9a-f]{7,40}) ', 1)) h from comments)),
    f as (select distinct unnest(regexp_extract_all(text, '\\b([0-9a-f]{7,40})\\b', 1)) full_sha from documents where text is not null)
    select short_sha, min(full_sha) full_sha from s left join f on starts_with(full_sha, short_sha) group by short_sha""")
def prefix_join(spark, d):
    ids = lambda t, c, p, out: table(spark, d, t, c).select(F.explode(F.regexp_extract_all(c, F.lit(p), F.lit(1))).alias(out))
    short = ids("comments", "content", r"After ([0-9a-f]{7,40}) ", "h").select(F.substring("h", 1, 7).alias("short_sha"))
    return R.prefix_join(short, ids("documents", "text", r"\b([0-9a-f]{7,40})\b", "full_sha"), "short_sha", "full_sha")


@query("""
    with l as (select distinct repo_url, pr_number number, link_pos, issue_number from pr_issue), k as (select distinct repo_url, number from pull_requests)
    select repo_url, number, coalesce(string_agg(cast(issue_number as varchar), ',' order by link_pos, issue_number), '') issues, cast(count(issue_number) as integer) n_issues
    from k left join l using (repo_url, number) group by repo_url, number""")
def nest_children(spark, d):
    links = table(spark, d, "pr_issue").withColumnRenamed("pr_number", "number").distinct()
    pulls = table(spark, d, "pull_requests", "repo_url", "number").distinct()
    nested = R.nest(pulls, links, ["repo_url", "number"], ["link_pos", "issue_number"], ["issue_number"], "issues")
    return nested.select("repo_url", "number", F.array_join(F.transform("issues", lambda x: x["issue_number"].cast("string")), ",").alias("issues"), F.size("issues").alias("n_issues"))


_COUNTS = "counts as (select repo_url, count(*) filter (lower(state) in ('closed', 'merged')) n_closed from pull_requests group by repo_url)"


@query(f"""
    with {LATEST}, {_COUNTS}
    select url, n_closed, n_closed >= 0.9 * least(500, closed_pull_requests) meets,
           cast(greatest(0, ceil(round(0.9 * least(500, closed_pull_requests) - n_closed, 6))) as bigint) n_needed
    from latest join counts on repo_url = url where closed_pull_requests is not null""")
def coverage_gate(spark, d):
    closed = F.lower("state").isin("closed", "merged")
    counts = table(spark, d, "pull_requests", "repo_url", "state").groupBy("repo_url").agg(F.count_if(F.coalesce(closed, F.lit(False))).alias("n_closed"))
    target = F.least(F.lit(500), F.col("closed_pull_requests"))
    both = latest_crawls(spark, d, "closed_pull_requests").where("closed_pull_requests is not null").join(counts, F.col("url") == F.col("repo_url"))
    return both.select("url", "n_closed", (F.col("n_closed") >= 0.9 * target).alias("meets"), R.still_needed(F.col("n_closed"), target).alias("n_needed"))


@query("""
    select crawl_id, case when not pr_counts_available then 'counts unavailable' when closed_pull_requests = 0 then 'none closed' end as error,
           open_pull_requests + closed_pull_requests as n_sum, coalesce(open_pull_requests > 0, false) or coalesce(closed_pull_requests > 0, false) or coalesce(total_pull_requests > 0, false) as any_count
    from crawled_repositories""")
def availability_case(spark, d):
    repos = table(spark, d, "crawled_repositories", "crawl_id", "pr_counts_available", "open_pull_requests", "closed_pull_requests", "total_pull_requests")
    error = F.when(~F.col("pr_counts_available"), "counts unavailable").when(F.col("closed_pull_requests") == 0, "none closed")
    some = F.lit(False)
    for c in ("open_pull_requests", "closed_pull_requests", "total_pull_requests"):
        some = some | F.coalesce(F.col(c) > 0, F.lit(False))
    return repos.select("crawl_id", error.alias("error"), (F.col("open_pull_requests") + F.col("closed_pull_requests")).alias("n_sum"), some.alias("any_count"))


@query("""
    select repo_url, number, pr_id, cast(row_number() over (partition by repo_url order by number desc, pr_id) as integer) as "rank" from pull_requests
    where lower(state) in ('closed', 'merged') qualify "rank" <= 20""")
def latest_n_per_key(spark, d):
    closed = table(spark, d, "pull_requests", "repo_url", "number", "pr_id", "state").where(F.lower("state").isin("closed", "merged")).drop("state")
    return top_rows(closed, ["repo_url"], 20, [F.desc("number"), F.asc("pr_id")])


@query("""
    with o as (select url repo_url, cast(3 + (max(stars) % 5) as integer) row_limit from crawled_repositories where stars > 20000 group by url)
    select p.repo_url, p.number, p.pr_id, cast(row_number() over (partition by p.repo_url order by number desc, pr_id) as integer) as "rank", coalesce(row_limit, 10) row_limit
    from pull_requests p left join o using (repo_url) qualify "rank" <= coalesce(row_limit, 10)""")
def limit_override(spark, d):
    own = table(spark, d, "crawled_repositories", "url", "stars").where("stars > 20000").groupBy(F.col("url").alias("repo_url")).agg((F.max("stars") % 5 + 3).cast("int").alias("row_limit"))
    pulls = R.with_limit(table(spark, d, "pull_requests", "repo_url", "number", "pr_id"), own, "repo_url", 10)
    return top_rows(pulls, ["repo_url"], F.col("row_limit"), [F.desc("number"), F.asc("pr_id")])


@query("""
    with n as (select repo_url, count(*) n from pull_requests group by repo_url)
    select repo_url, cast(least(500, floor(greatest(n * 2, 100) * (1 + 0.5 * (n % 4)))) as bigint) next_limit, least(60.0, 1.0 * pow(2.0, n % 8)) wait_s, greatest(1, 10 - n) next_batch from n""")
def adaptive_limit(spark, d):
    n = F.col("n")
    return table(spark, d, "pull_requests", "repo_url").groupBy("repo_url").agg(F.count(F.lit(1)).alias("n")).select("repo_url", R.retry_limit(n, n % 4).alias("next_limit"), R.backoff(n % 8).alias("wait_s"), R.next_batch(n).alias("next_batch"))


@query("select pr_id, (row_number() over (partition by repo_url order by pr_id) - 1) // 50 batch from pull_requests")
def batch_assign(spark, d):
    from forgelake.operators.ordered import row_numbers

    pulls = table(spark, d, "pull_requests", "repo_url", "pr_id").withColumn("bucket", F.floor(F.col("pr_id") / 10_000))
    return row_numbers(pulls, ["repo_url"], "bucket", ["pr_id"], "rn").select("pr_id", R.in_batches(F.col("rn"), 50).alias("batch"))


@query("select url, crawl_id, stars, greatest((select count(*) from crawled_repositories) - 10, 0) n_more from crawled_repositories order by stars desc, crawl_id limit 10")
def preview_topn(spark, d):
    return R.preview(table(spark, d, "crawled_repositories", "url", "crawl_id", "stars"), [F.desc("stars"), F.asc("crawl_id")])


@query("""
    select source, count(*) n, cast(sum(stars) as bigint) total, avg(stars) average, max(stars) best from crawled_repositories group by source""")
def summary(spark, d):
    repos = table(spark, d, "crawled_repositories", "source", "url", "stars")
    s = M.summary(repos, ["source"], "stars", "stars")
    return s.withColumnRenamed("top", "best")


@query("""
    select source, count(*) n, count(*) filter (crawl_success) n_ok, count(*) - count(*) filter (crawl_success) n_failed,
           case when count(*) = 0 then 0.0 else count(*) filter (crawl_success) / count(*) * 100.0 end rate
    from crawled_repositories group by source""")
def status_stats(spark, d):
    g = table(spark, d, "crawled_repositories", "source", "crawl_success").groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce("crawl_success", F.lit(False))).alias("n_ok"))
    return g.select("*", (F.col("n") - F.col("n_ok")).alias("n_failed"), M.share(F.col("n_ok"), F.col("n"), 100.0).alias("rate"))


@query("""
    select cast(sum(n) as bigint) n_failures, count(*) n_keys, count(*) filter (last_ts > timestamp '2024-01-28') n_active, cast(sum(3 * n) as bigint) n_saved, sum(3 * n) / sum(4 * n) * 100.0 saved_share
    from (select user_id, count(*) n, max(ts) last_ts from events where event_type = 'error' group by user_id)""")
def failure_stats(spark, d):
    e = table(spark, d, "events", "user_id", "event_type", "ts").where("event_type = 'error'").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_ts"))
    active = F.col("last_ts") > F.lit("2024-01-28").cast("timestamp_ntz")
    g = e.agg(F.sum("n").alias("n_failures"), F.count(F.lit(1)).alias("n_keys"), F.count_if(active).alias("n_active"), F.sum(F.col("n") * 3).alias("n_saved"))
    return g.withColumn("saved_share", M.share(F.col("n_saved"), F.col("n_saved") + F.col("n_failures"), 100.0))


@query("""
    with d as (select cast(ts as date) as day, event_type, value from events)
    select "day", coalesce(avg(value) filter (event_type = 'view'), 0.0) mean_view, count(*) / 1440.0 per_minute,
           count(*) filter (event_type = 'purchase') * 100.0 / greatest(count(*) filter (event_type = 'view'), 1) coverage from d group by "day" """)
def rates(spark, d):
    e = table(spark, d, "events", "ts", "event_type", "value").withColumn("day", F.to_date("ts"))
    view, bought = F.col("event_type") == "view", F.col("event_type") == "purchase"
    return e.groupBy("day").agg(M.mean_or_zero(F.when(view, F.col("value"))).alias("mean_view"), (F.count(F.lit(1)) / 1440.0).alias("per_minute"), M.coverage(F.count_if(bought), F.count_if(view)).alias("coverage"))


@query("""
    with s as (select url, number // 25 as page, url like '%/pull/%' ok from pull_requests where url is not null order by url, page limit 10)
    select n_rows, n_pages, n_rows / greatest(n_pages, 1) per_page, n_invalid, n_repeated, case when n_rows / greatest(n_pages, 1) >= 20 and n_invalid = 0 then 'good' when n_rows / greatest(n_pages, 1) < 5 then 'sparse' else 'fair' end verdict
    from (select count(*) n_rows, count(distinct number // 25) n_pages from pull_requests where url is not null), (select count(*) filter (not ok) n_invalid, count(*) - count(distinct url) n_repeated from s)""")
def density_check(spark, d):
    links = table(spark, d, "pull_requests", "url", "number").where("url is not null").select("url", F.expr("number div 25").alias("page"))
    return M.density(links, "page", "url", F.contains("url", F.lit("/pull/")))


@query(f"""
    with {LATEST}, top as (select repo_url, max(number) last_number from issues group by repo_url)
    select url, coalesce(last_number, 0) last_number, greatest(0, coalesce(last_number, 0) - open_issues - total_pull_requests) estimate,
           case when coalesce(last_number, 0) = 0 or open_issues = 0 then 0 else greatest(0, last_number - open_issues) end fallback
    from latest left join top on repo_url = url""")
def closed_estimate(spark, d):
    top = table(spark, d, "issues", "repo_url", "number").groupBy("repo_url").agg(F.max("number").alias("last_number"))
    r = latest_crawls(spark, d, "open_issues", "total_pull_requests").join(top, F.col("url") == F.col("repo_url"), "left").withColumn("last_number", F.coalesce("last_number", F.lit(0).cast("bigint")))
    zero = F.lit(0).cast("bigint")
    return r.select("url", "last_number", F.greatest(zero, F.col("last_number") - F.col("open_issues") - F.col("total_pull_requests")).alias("estimate"), F.when((F.col("last_number") == 0) | (F.col("open_issues") == 0), zero).otherwise(F.greatest(zero, F.col("last_number") - F.col("open_issues"))).alias("fallback"))


@query("""
    with u as (select repo_url, number, pr_id, 0 part from pull_requests where lower(state) = 'open' union all select repo_url, number, pr_id, 1 from pull_requests where lower(state) in ('closed', 'merged'))
    select repo_url, number, cast(part as integer) part, pr_id from u qualify row_number() over (partition by repo_url, number order by part, pr_id) = 1""")
def union_keep_first(spark, d):
    pulls = table(spark, d, "pull_requests", "repo_url", "number", "pr_id", "state")
    part = lambda *s: pulls.where(F.lower("state").isin(*s)).drop("state")
    return R.union_keep_first([part("open"), part("closed", "merged")], ["repo_url", "number"], ["pr_id"])


@query("""
    with l as (select repo_url, pr_number, issue_number, min(link_pos) p from pr_issue group by all),
    r as (select repo_url, pr_number, issue_number, row_number() over (partition by repo_url, pr_number order by p, issue_number) rn from l)
    select repo_url, pr_number, string_agg(cast(issue_number as varchar), ',' order by rn) refs from r where rn <= 5 group by all""")
def ordered_union_refs(spark, d):
    links = table(spark, d, "pr_issue")
    first = first_rows(links, ["repo_url", "pr_number", "issue_number"], ["link_pos"])
    best = top_rows(first, ["repo_url", "pr_number"], 5, [F.asc("link_pos"), F.asc("issue_number")])
    one = best.groupBy("repo_url", "pr_number").agg(F.array_sort(F.collect_list(F.struct("rank", "issue_number"))).alias("refs"))
    return one.select("repo_url", "pr_number", F.array_join(F.transform(F.slice("refs", 1, 5), lambda x: x["issue_number"].cast("string")), ",").alias("refs"))


@query("""
    select distinct repo_url, url from pull_requests p
    where not exists (select 1 from pull_requests f where f.url = p.url and lower(f.state) = 'open')
      and not exists (select 1 from pr_issue s where s.repo_url = p.repo_url and s.pr_number = try_cast(case when contains(p.url, '/pull/') then regexp_extract(p.url, '.*/pull/(.*)$', 1) end as bigint))""")
def remaining_urls(spark, d):
    pulls = table(spark, d, "pull_requests", "repo_url", "url", "state")
    failed = pulls.where("lower(state) = 'open'").select("url")
    done = table(spark, d, "pr_issue", "repo_url", "pr_number").distinct()
    found = pulls.select("repo_url", "url").distinct().join(failed, "url", "left_anti").withColumn("n", X.strict_number(F.col("url")))
    return R.not_done(found.withColumnRenamed("n", "pr_number"), done, ["repo_url", "pr_number"]).select("repo_url", "url")


@query("""
    select crawl_id, error_message, contains(lower(error_message), '429') or contains(lower(error_message), 'rate limit') rate_limited,
           case when try_cast(nullif(regexp_extract(error_message, '\\b([1-5]\\d\\d)\\b', 1), '') as integer) between 400 and 499 then false else true end retryable
    from crawled_repositories where error_message is not null""")
def cached_failure_skip(spark, d):
    e = F.col("error_message")
    return table(spark, d, "crawled_repositories", "crawl_id", "error_message").where(e.isNotNull()).select("crawl_id", "error_message", X.is_rate_limit(e).alias("rate_limited"), X.is_retryable(e).alias("retryable"))


@query("""
    with f as (select user_id, floor(epoch(max(ts))) t from events where event_type = 'error' group by user_id)
    select c_custkey, c_name from customer where not exists (select 1 from f where user_id = c_custkey and 1706659200 - t < 604800)""")
def unexpired_failure_skip(spark, d):
    """The keys to be tried: those without a failure that hasn't expired yet (a week)."""
    failures = table(spark, d, "events", "user_id", "event_type", "ts").where("event_type = 'error'").groupBy("user_id").agg(F.max("ts").alias("last_ts"))
    blocked = failures.where(alive(F.col("last_ts"), F.lit("2024-01-31").cast("timestamp_ntz"), 604_800)).select(F.col("user_id").alias("c_custkey"))
    return R.not_done(table(spark, d, "customer", "c_custkey", "c_name"), blocked, ["c_custkey"])


@query("""
    select repo_url, lower(state) state, max(cast(ceil(number / 25.0) as bigint)) + 1 next_page, count(distinct number) n_numbers
    from pull_requests where number is not null and state is not null group by all""")
def resume_page(spark, d):
    """Where each listing of a repository goes on: the page behind the last one that was seen, 25 numbers a page."""
    pulls = table(spark, d, "pull_requests", "repo_url", "number", "state").where("number is not null and state is not null")
    page = F.ceil(F.col("number") / 25).cast("bigint")
    return pulls.groupBy("repo_url", F.lower("state").alias("state")).agg((F.max(page) + 1).alias("next_page"), F.count_distinct("number").alias("n_numbers"))


@query("select repo_url url from pull_requests where repo_url is not null union select repo_url from issues where repo_url is not null union select url from crawled_repositories where url is not null")
def url_union(spark, d):
    """Every repository that any table knows, once; each table is made distinct before the union."""
    each = [table(spark, d, t, c).where(F.col(c).isNotNull()).select(F.col(c).alias("url")).distinct() for t, c in (("pull_requests", "repo_url"), ("issues", "repo_url"), ("crawled_repositories", "url"))]
    return each[0].unionByName(each[1]).unionByName(each[2]).distinct()


@query(f"""
    with {LATEST}, n as (select repo_url, count(distinct number) scraped from pull_requests group by repo_url)
    select url, coalesce(scraped, 0) scraped, total_pull_requests > 0 and coalesce(scraped, 0) >= total_pull_requests complete,
           coalesce(scraped, 0) < 0.8 * total_pull_requests short, coalesce(scraped, 0) * 100.0 / greatest(total_pull_requests, 1) coverage
    from latest left join n on repo_url = url""")
def completion_flags(spark, d):
    n = table(spark, d, "pull_requests", "repo_url", "number").groupBy("repo_url").agg(F.count_distinct("number").alias("scraped"))
    r = latest_crawls(spark, d, "total_pull_requests").join(n, F.col("url") == F.col("repo_url"), "left").withColumn("scraped", F.coalesce("scraped", F.lit(0).cast("bigint")))
    t, s = F.col("total_pull_requests"), F.col("scraped")
    return r.select("url", "scraped", ((t > 0) & (s >= t)).alias("complete"), (s < 0.8 * t).alias("short"), M.coverage(s, t).alias("coverage"))


@query("""
    select source, count(*) n, count(distinct doc_id) n_keys, cast(sum(length(text)) as bigint) / 1048576 megabytes, cast(sum(len(regexp_extract_all(text, '#[0-9]+'))) as bigint) n_refs,
           count(*) filter (text is null or text = '') > 0 has_empty from documents group by source""")
def cache_stats(spark, d):
    docs = table(spark, d, "documents", "doc_id", "source", "text")
    refs = F.size(F.regexp_extract_all("text", F.lit("(#[0-9]+)"), F.lit(1)))
    return docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("n_keys"), M.megabytes(F.sum(F.length("text"))).alias("megabytes"), F.sum(F.when(F.col("text").isNotNull(), refs).cast("bigint")).alias("n_refs"), (F.count_if(F.col("text").isNull() | (F.col("text") == "")) > 0).alias("has_empty"))


@query("""
    select pr_id, created_at, created_at as updated_at, '2025-07-01T00:00:00' as crawled_at, cast(null as varchar) as commit_id, '' as previous_commit_id from pull_requests""")
def stamped_blanked(spark, d):
    pulls = table(spark, d, "pull_requests", "pr_id", "created_at")
    return pulls.select("pr_id", "created_at", F.col("created_at").alias("updated_at"), F.lit("2025-07-01T00:00:00").alias("crawled_at"), F.lit(None).cast("string").alias("commit_id"), F.lit("").alias("previous_commit_id"))


@query(f"""
    with {LATEST}, n as (select repo_url, count(*) n_prs, count(*) filter (lower(state) = 'merged') n_merged from pull_requests group by repo_url)
    select url, stars, open_pull_requests, coalesce(n_prs, 0) n_prs, coalesce(n_merged, 0) n_merged, crawl_success and n_prs > 0 ok from latest left join n on repo_url = url""")
def nested_output(spark, d):
    """The nested output record, read back field by field: stats as a struct, counts from the children's table."""
    n = table(spark, d, "pull_requests", "repo_url", "state").groupBy("repo_url").agg(F.count(F.lit(1)).alias("n_prs"), F.count_if(F.coalesce(F.lower("state") == "merged", F.lit(False))).alias("n_merged"))
    stats = ["contributors_count", "forks_count", "total_issues", "open_issues", "closed_issues", "total_pull_requests", "open_pull_requests", "closed_pull_requests", "pr_counts_available"]
    r = latest_crawls(spark, d, "stars", "crawl_success", *stats).select("url", "stars", F.struct(*stats).alias("stats"), "crawl_success").join(n, F.col("url") == F.col("repo_url"), "left")
    return r.select("url", "stars", "stats.open_pull_requests", F.coalesce("n_prs", F.lit(0).cast("bigint")).alias("n_prs"), F.coalesce("n_merged", F.lit(0).cast("bigint")).alias("n_merged"), (F.col("crawl_success") & (F.col("n_prs") > 0)).alias("ok"))


@query(f"""
    with {LATEST}, {_COUNTS}, done as (select distinct url from crawled_repositories where crawl_success and source = 'crawler_c'),
    picked as (select url from latest join counts on repo_url = url where n_closed >= 0.9 * least(5, closed_pull_requests) and stars >= 500 and not exists (select 1 from done where done.url = latest.url))
    select repo_url, number, pr_id, cast(row_number() over (partition by repo_url order by number desc, pr_id) as integer) as "rank" from pull_requests join picked on url_of = repo_url
    where lower(state) in ('closed', 'merged') qualify "rank" <= 10""".replace("url_of", "picked.url"))
def flagship(spark, d):
    """Threshold, coverage, anti-join with finished work and latest closed requests per repository, in one plan."""
    closed = F.lower("state").isin("closed", "merged")
    pulls = table(spark, d, "pull_requests", "repo_url", "number", "pr_id", "state").where(closed).drop("state")
    counts = pulls.groupBy("repo_url").agg(F.count(F.lit(1)).alias("n_closed"))
    repos = R.at_least(latest_crawls(spark, d, "stars", "closed_pull_requests"), "stars", 500)
    done = table(spark, d, "crawled_repositories", "url", "crawl_success", "source").where("crawl_success and source = 'crawler_c'").select("url")
    every = repos.join(counts, F.col("url") == F.col("repo_url"), "left").withColumn("n_closed", F.coalesce("n_closed", F.lit(0)))
    picked = R.not_done(every.where(F.col("n_closed") >= 0.9 * F.least(F.lit(5), F.col("closed_pull_requests"))), done, ["url"]).select(F.col("url").alias("repo_url"))
    return top_rows(pulls.join(picked, "repo_url", "left_semi"), ["repo_url"], 10, [F.desc("number"), F.asc("pr_id")])


