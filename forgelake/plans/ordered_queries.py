"""Order, history and state of the catalogue: runs, leads, samples, breakers, expiry, upserts, refinement."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from forgelake.functions import text as X
from forgelake.operators import ordered as O
from forgelake.operators import relational as R
from forgelake.operators import state as S
from forgelake.session import shared_folder
from forgelake.sources.tables import table
from forgelake.streaming.resume import new_files, once_per_key, run_available

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f"q_{f.__name__}"] = f
        if sql:
            SQL[f"q_{f.__name__}"] = sql
        return f

    return keep


def _events(spark, d, *columns):
    """Events with the day as the bucket of their order."""
    return table(spark, d, "events", "event_id", "ts", "user_id", *columns).withColumn("day", F.to_date("ts"))


@query("select event_id, user_id, coalesce(lead('c' || event_id) over (partition by user_id order by ts, event_id), '') as next_id from events")
def next_in_history(spark, d):
    e = _events(spark, d).withColumn("sha", F.concat(F.lit("c"), F.col("event_id").cast("string")))
    return O.next_values(e, ["user_id"], "day", ["ts", "event_id"], "sha", "next_id").select("event_id", "user_id", F.coalesce("next_id", F.lit("")).alias("next_id"))


@query("""
    with h as (select user_id, event_id, ts, row_number() over (partition by user_id order by ts desc, event_id desc) pos from events),
    p as (select user_id, event_id commit_id from events where event_type = 'purchase')
    select p.user_id, p.commit_id, coalesce(n.event_id, -1) previous_commit_id from p join h using (user_id) left join h n on n.user_id = p.user_id and n.pos = h.pos + 1 where h.event_id = p.commit_id""")
def prev_commit(spark, d):
    """The entry behind each picked one in the newest-first history of its key: a join on numbered positions."""
    e = _events(spark, d, "event_type").withColumns({"back": -F.col("event_id"), "age": -F.datediff("day", F.lit("1970-01-01")), "at": -F.unix_micros(F.col("ts").cast("timestamp"))})
    h = O.row_numbers(e, ["user_id"], "age", ["at", "back"], "pos")
    n = h.select("user_id", (F.col("pos") - 1).alias("pos"), F.col("event_id").alias("previous_commit_id"))
    return h.where("event_type = 'purchase'").join(n, ["user_id", "pos"], "left").select("user_id", F.col("event_id").alias("commit_id"), F.coalesce("previous_commit_id", F.lit(-1)).alias("previous_commit_id"))


_RUN = """
    with f as (select event_id, user_id, ts, {hit} hit, sum(case when {hit} then 0 else 1 end) over (partition by user_id order by ts, event_id) island from events)
    select event_id, cast(sum(case when hit then 1 else 0 end) over (partition by user_id, island order by ts, event_id) as bigint) run_length from f"""


@query(_RUN.format(hit="(event_type = 'error')"))
def consecutive_failures(spark, d):
    e = _events(spark, d, "event_type").withColumn("bad", F.col("event_type") == "error")
    return O.run_lengths(e, ["user_id"], "day", ["ts", "event_id"], "bad", "run_length").select("event_id", F.col("run_length").cast("bigint"))


@query("with r as (" + _RUN.format(hit="(value < 8.0)") + ") select user_id, min(event_id) filter (run_length >= 3) first_stop, max(run_length) longest from r join events using (event_id) group by user_id")
def empty_runs(spark, d):
    """Per key: where three small values in a row would first stop a paged scan, and the longest such run."""
    e = _events(spark, d, "value").withColumn("empty", F.col("value") < 8.0)
    r = O.run_lengths(e, ["user_id"], "day", ["ts", "event_id"], "empty", "n")
    return r.groupBy("user_id").agg(F.min(F.when(F.col("n") >= 3, F.col("event_id"))).alias("first_stop"), F.max("n").cast("bigint").alias("longest"))


@query("""
    with recursive a as (select cast(user_id as varchar) user_id, epoch_us(ts) / 1e6 t, event_type <> 'error' ok, row_number() over (partition by user_id order by ts, event_id) rn from events),
    s(user_id, rn, n, until, skipped, trips) as (
        select distinct user_id, cast(0 as bigint), cast(0 as bigint), cast(0 as double), cast(0 as bigint), cast(0 as bigint) from a
        union all
        select user_id, rn, case when skip then n0 when ok then 0 else n1 end, case when skip then until0 when ok then 0.0 when n1 >= 3 then t + 86400.0 else 0.0 end,
               skipped + case when skip then 1 else 0 end, trips + case when not skip and not ok and n1 >= 3 then 1 else 0 end
        from (select s.user_id, a.rn, a.ok, a.t, s.skipped, s.trips, s.until until0, s.until > 0 and a.t < s.until skip, s.n n0, case when s.until > 0 then 0 else s.n end + 1 n1 from s join a on a.user_id = s.user_id and a.rn = s.rn + 1))
    select user_id, rn n_attempts, skipped n_skipped, trips n_trips, n n_failures, round(nullif(until, 0.0), 3) blocked_until from s qualify row_number() over (partition by user_id order by rn desc) = 1""")
def circuit_breaker(spark, d):
    e = table(spark, d, "events", "user_id", "ts", "event_id", "event_type").withColumn("ok", F.col("event_type") != "error")
    b = S.circuit_breaker(e, "user_id", "ts", "ok", "event_id", failures=3, seconds=86_400.0)
    return b.withColumn("blocked_until", F.round("blocked_until", 3))


@query("""
    select event_id, avg(value) over w mean_value, count(*) over w n from events window w as (partition by user_id order by ts, event_id rows between 9 preceding and current row)""")
def sample_window(spark, d):
    """The last ten samples of each key: rows meet in blocks of a key, not in one task per key."""
    e = _events(spark, d, "value")
    # Each block of 64 rows also gets the last nine rows before it.
    n = O.row_numbers(e, ["user_id"], "day", ["ts", "event_id"], "rn").withColumn("block", F.floor((F.col("rn") - 1) / 64))
    over = n.select("*", F.lit(True).alias("own")).unionByName(n.where("(rn - 1) % 64 >= 55").select(*[c for c in n.columns if c != "block"], (F.col("block") + 1).alias("block"), F.lit(False).alias("own")))
    w = Window.partitionBy("user_id", "block").orderBy("rn").rowsBetween(-9, 0)
    return over.select("event_id", "own", F.avg("value").over(w).alias("mean_value"), F.count(F.lit(1)).over(w).alias("n")).where("own").drop("own")


@query("""
    select crawl_id, coalesce(crawl_success and t >= timestamp '2025-01-01' - interval 30 days, false) fresh, coalesce(t < timestamp '2025-01-01' - interval 60 days, true) purge
    from (select crawl_id, crawl_success, case when regexp_full_match(crawl_timestamp, '\\d{4}-\\d\\d-\\d\\dT\\d\\d:\\d\\d:\\d\\dZ') then try_cast(replace(crawl_timestamp, 'Z', '') as timestamp) end t from crawled_repositories)""")
def freshness(spark, d):
    repos = table(spark, d, "crawled_repositories", "crawl_id", "crawl_success", "crawl_timestamp")
    written_at = F.when(F.col("crawl_timestamp").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ$"), F.col("crawl_timestamp"))
    now = F.lit("2025-01-01T00:00:00Z")
    old = F.coalesce(written_at.try_cast("timestamp") < now.cast("timestamp") - F.make_dt_interval(F.lit(60)), F.lit(True))
    return repos.select("crawl_id", S.is_fresh(F.col("crawl_success"), written_at, now, 30).alias("fresh"), old.alias("purge"))


@query("""
    with l as (select user_id, max(ts) last_ts, count(*) n from events where event_type = 'error' group by user_id)
    select user_id, n, epoch(timestamp '2024-01-31') - floor(epoch(last_ts)) < 604800 alive from l""")
def ttl_latest_failure(spark, d):
    e = table(spark, d, "events", "user_id", "ts", "event_type").where("event_type = 'error'").groupBy("user_id").agg(F.max("ts").alias("last_ts"), F.count(F.lit(1)).alias("n"))
    return e.select("user_id", "n", S.alive(F.col("last_ts"), F.lit("2024-01-31").cast("timestamp_ntz"), 604_800).alias("alive"))


@query("""
    with l as (select user_id, event_type, floor(epoch(max(ts))) t from events group by all)
    select user_id, event_type, cast(t as bigint) t from l where 1706659200 - t < 864""")
def ttl_map(spark, d):
    """Per key a map of kinds to their latest times, expired entries filtered out of it, read back as rows."""
    e = table(spark, d, "events", "user_id", "event_type", "ts").groupBy("user_id", "event_type").agg(F.max(F.unix_timestamp(F.col("ts").cast("timestamp"))).alias("t"))
    maps = e.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "t"))).alias("m"))
    return maps.select("user_id", F.explode(S.ttl_map(F.col("m"), F.lit(1706659200), 864)).alias("event_type", "t"))


@query("""
    select user_id, event_id, event_type from (select * from events where event_id % 2 = 0 union all select * from events where event_id % 2 = 1) e
    where not exists (select 1 from events x where x.user_id = e.user_id and x.value > 200) qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""")
def keyed_upsert(spark, d):
    """A keyed table, newer rows written over it, and keys deleted from it."""
    e = table(spark, d, "events", "user_id", "event_id", "event_type", "ts", "value")
    parts = [e.where(F.col("event_id") % 2 == i).drop("value") for i in (0, 1)]
    return S.keyed_upsert(*parts, ["user_id"], ["ts", "event_id"], e.where("value > 200").select("user_id").distinct()).select("user_id", "event_id", "event_type")


@query("""
    select comment_id, repo_url, parent_kind, parent_number, case when length(c) > 500 then substr(c, 1, 500) || '...' else c end as content from (
        select *, regexp_replace(content, '^\\s+|\\s+$', '', 'g') c from comments) where length(c) >= 5
    qualify row_number() over (partition by repo_url, parent_kind, parent_number, c order by pos, comment_id) = 1""")
def comment_history(spark, d):
    """Comments of each thread once by text, long enough, shortened."""
    c = table(spark, d, "comments", "comment_id", "repo_url", "parent_kind", "parent_number", "pos", "content").withColumn("c", X.strip(F.col("content"))).where(F.length("c") >= 5)
    one = O.first_rows(c.withColumn("k", F.sha2("c", 256)), ["repo_url", "parent_kind", "parent_number", "k"], ["pos", "comment_id"], ["comment_id"])
    return c.join(one.select("comment_id"), "comment_id", "left_semi").select("comment_id", "repo_url", "parent_kind", "parent_number", X.shortened(F.col("c"), 500).alias("content"))


@query("""
    select repo_url, parent_kind, parent_number, string_agg(comment_id::varchar, ',' order by posted_at nulls first, pos, comment_id) ids, count(*) n from comments group by all""")
def sorted_threads(spark, d):
    """The comments of each thread, sorted by their written times."""
    c = table(spark, d, "comments", "comment_id", "repo_url", "parent_kind", "parent_number", "pos", "posted_at")
    g = c.groupBy("repo_url", "parent_kind", "parent_number").agg(F.array_sort(F.collect_list(F.struct("posted_at", "pos", "comment_id"))).alias("a"))
    # array_sort puts null fields of structs first.
    return g.select("repo_url", "parent_kind", "parent_number", F.array_join(F.transform("a", lambda x: x["comment_id"].cast("string")), ",").alias("ids"), F.size("a").cast("bigint").alias("n"))


@query("select doc_id, text from documents where text is not null qualify row_number() over (partition by text order by doc_id) = 1")
def text_dedup(spark, d):
    docs = table(spark, d, "documents", "doc_id", "text").where("text is not null")
    first = docs.groupBy(F.sha2("text", 256).alias("k")).agg(F.min("doc_id").alias("doc_id"))  # hashes are shuffled, no text
    return docs.join(first.select("doc_id"), "doc_id", "left_semi").select("doc_id", "text")


@query("""
    with c as (select comment_id, substr(content, 1, 60) head, row_number() over (partition by repo_url, parent_kind, parent_number order by pos, comment_id) rn, repo_url, parent_kind, parent_number from comments where length(content) > 10)
    select repo_url, parent_kind, parent_number, string_agg(head, '|' order by rn) heads from c where rn <= 10 group by all""")
def comment_sample(spark, d):
    """The beginnings of the first ten longer comments of each thread: what a short record keeps."""
    c = table(spark, d, "comments", "comment_id", "repo_url", "parent_kind", "parent_number", "pos", "content").where(F.length("content") > 10).withColumn("head", F.substring("content", 1, 60)).drop("content")
    best = O.top_rows(c, ["repo_url", "parent_kind", "parent_number"], 10, [F.asc("pos"), F.asc("comment_id")])
    g = best.groupBy("repo_url", "parent_kind", "parent_number").agg(F.array_sort(F.collect_list(F.struct("rank", "head"))).alias("a"))
    return g.select("repo_url", "parent_kind", "parent_number", F.array_join(F.transform("a", lambda x: x["head"]), "|").alias("heads"))


@query("""
    with n as (select repo_url, count(distinct number) n from pull_requests group by repo_url)
    select p.repo_url, p.number from (select distinct repo_url, number from pull_requests) p join n using (repo_url)
    qualify row_number() over (partition by p.repo_url order by p.number desc) <= least(n.n, 40)""")
def refinement_loop(spark, d):
    """Rounds that add the newest missing requests until every repository has 40, or all it has: the fixed point is the newest 40."""
    every = table(spark, d, "pull_requests", "repo_url", "number").distinct()
    have = O.top_rows(every, ["repo_url"], 10, [F.desc("number")]).drop("rank")

    def enough(now):
        counts = every.groupBy("repo_url").agg(F.count(F.lit(1)).alias("n")).join(now.groupBy("repo_url").agg(F.count(F.lit(1)).alias("m")), "repo_url", "left")
        return counts.where(F.coalesce("m", F.lit(0)) < F.least("n", F.lit(40))).limit(1).count() == 0

    def step(now, attempt):
        missing = R.not_done(every, now, ["repo_url", "number"])
        more = O.top_rows(missing, ["repo_url"], 10 + 5 * attempt, [F.desc("number")]).drop("rank")
        return O.top_rows(now.unionByName(more), ["repo_url"], 40, [F.desc("number")]).drop("rank")

    return S.refine(have, enough, step)


@query("select user_id, event_type, count(distinct event_id) n from events group by all")
def stream_resume(spark, d):
    """The events table read as a stream in two runs of one checkpoint: what is there, and nothing again."""
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    schema = table(spark, d, "events").schema  # the pattern below also fits where the table is a single file
    for _ in range(2):
        run_available(once_per_key(new_files(spark, f"{d}/events.parque[t]", schema).select("event_id", "user_id", "event_type"), ["event_id"]), f"{folder}/out", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/out").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
