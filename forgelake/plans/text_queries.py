"""Text, links, JSON and captured pages of the catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from forgelake.functions import html as H
from forgelake.functions import jsonx as J
from forgelake.functions import text as X
from forgelake.operators.ordered import first_rows
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


@query(r"""
    with c as (select comment_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(content,
        '^Description[a-zA-Z0-9\s]*opened\s*on\s*[a-zA-Z0-9\s,]*Issue body actions', '', 'gi'), '^[a-zA-Z0-9\s]*opened\s*on\s*[a-zA-Z0-9\s,]*Issue body actions', '', 'gi'),
        'Issue body actions', '', 'gi'), 'Description\s*', '', 'gi'), 'opened\s*on\s*[a-zA-Z0-9\s,]*', '', 'gi'), '\s+', ' ', 'g')) body, content
      from (select comment_id, 'Description' || coalesce(author, 'x') || ' opened on Jan 1, 2024Issue body actions ' || content as content from comments where content is not null))
    select comment_id, body from c where length(content) > 50 and length(body) > 50""")
def clean_text(spark, d):
    """Bodies as a page shows them, cleaned of what the page says around them; only long ones count, before and after."""
    c = table(spark, d, "comments", "comment_id", "author", "content").where("content is not null")
    shown = c.select("comment_id", F.concat(F.lit("Description"), F.coalesce("author", F.lit("x")), F.lit(" opened on Jan 1, 2024Issue body actions "), F.col("content")).alias("content")).where(F.length("content") > 50)
    return shown.select("comment_id", X.clean_body(F.col("content")).alias("body")).where(F.length("body") > 50)


@query(r"""
    select doc_id, array_to_string(regexp_extract_all(text, '\b[0-9a-f]{12}\b', 0), ',') refs, regexp_full_match(regexp_extract(text, 'Change-Ref: (\S+)', 1), '(?i)[a-f0-9]{7,40}') valid
    from documents where contains(text, 'Change-Ref')""")
def sha_refs(spark, d):
    docs = table(spark, d, "documents", "doc_id", "text").where(F.contains("text", F.lit("Change-Ref")))
    refs = F.array_join(F.regexp_extract_all("text", F.lit(r"(\b[0-9a-f]{12}\b)"), F.lit(1)), ",")
    return docs.select("doc_id", refs.alias("refs"), X.is_sha(F.regexp_extract("text", r"Change-Ref: (\S+)", 1)).alias("valid"))


@query()
def issue_refs(spark, d):
    """The issues each comment refers to, by phrase; not its own thread, and only plausible numbers."""
    c = table(spark, d, "comments", "comment_id", "parent_number", "content")
    refs = c.select("comment_id", "parent_number", F.posexplode(F.slice(X.issue_refs(F.col("content")), 1, 10)).alias("pos", "issue_number"))
    return refs.where(X.valid_issue(F.col("issue_number")) & ~F.col("issue_number").eqNullSafe(F.col("parent_number"))).select("comment_id", "pos", "issue_number")


@query(r"""
    with u as (select pr_id, url, split_part(split_part(url, '#', 1), '?', 1) bare from pull_requests)
    select pr_id, bare, array_to_string(string_split(url, '/')[1:5], '/') repo, nullif(regexp_extract(url, '^https?://[^/]+/([^/]+/[^/#?]+)', 1), '') owner_repo, try_cast(nullif(regexp_extract(bare, '/pull/(\d+)', 1), '') as bigint) number,
           try_cast(case when contains(url, '/pull/') then regexp_extract(url, '.*/pull/(.*)$', 1) end as bigint) strict_number, nullif(regexp_extract(bare, '^(.*?/pull/\d+)', 1), '') canonical from u""")
def url_parts(spark, d):
    u = F.col("url")
    return table(spark, d, "pull_requests", "pr_id", "url").select("pr_id", X.without_suffix(u).alias("bare"), X.repo_prefix(u).alias("repo"), X.owner_repo(u).alias("owner_repo"), X.pull_number(u).alias("number"), X.strict_number(u).alias("strict_number"), X.canonical_pull(u).alias("canonical"))


@query(r"""
    select crawl_id, cast(floor(cast(regexp_extract(t, '(\d+(?:\.\d+)?)', 1) as decimal(18, 6)) * case when regexp_matches(t, '\dk') then 1000 when regexp_matches(t, '\dm') then 1000000 else 1 end) as bigint) n,
           cast(regexp_extract(t, '(\d+)', 1) as bigint) first_int
    from (select crawl_id, case when forks_count >= 1000 then printf('%.1fk', forks_count // 100 / 10.0) else format('{:,}', stars) end t0, lower(replace(t0, ',', '')) t from crawled_repositories)""")
def compact_count(spark, d):
    """Counts written as pages write them (8.2k, 60,190), read back."""
    r = table(spark, d, "crawled_repositories", "crawl_id", "forks_count", "stars")
    written = F.when(F.col("forks_count") >= 1000, F.format_string("%.1fk", F.expr("forks_count div 100") / 10)).otherwise(F.format_number("stars", 0))
    r = r.select("crawl_id", written.alias("t"))
    return r.select("crawl_id", X.compact_count(F.col("t")).alias("n"), X.first_integer(F.col("t")).alias("first_int"))


@query("""
    select pr_id, case when contains(lower(state), 'merged') then 'merged' when contains(lower(state), 'closed') then 'closed' else 'open' end state_word,
           case when contains(lower(state), 'open') then 'open' when contains(lower(state), 'closed') then 'closed' else 'open' end issue_word,
           case when number < 60 then printf('%.2f s', cast(number as double)) when number < 3600 then printf('%.2f min', number / 60.0) else printf('%.2f h', number / 3600.0) end as took,
           case when 400 + number % 120 = 404 then 'not found' when 400 + number % 120 = 403 then 'forbidden' when 400 + number % 120 = 429 then 'rate limited' when 400 + number % 120 >= 500 then 'server error' else 'status ' || (400 + number % 120) end status
    from pull_requests""")
def state_keyword(spark, d):
    n = F.col("number")
    return table(spark, d, "pull_requests", "pr_id", "state", "number").select("pr_id", X.state_word(F.col("state")).alias("state_word"), X.issue_state_word(F.col("state")).alias("issue_word"), X.duration(n.cast("double")).alias("took"), X.status_message(400 + n % 120).alias("status"))


@query("select event_id, coalesce(try_cast(json_extract_string(props, '$.missing') as bigint), try_cast(json_extract_string(props, '$.k') as bigint), -1) k from events")
def json_cascade(spark, d):
    v = F.try_parse_json(F.col("props"))
    return table(spark, d, "events", "event_id", "props").withColumn("v", v).select("event_id", F.coalesce(J.at(F.col("v"), "$.missing", "bigint"), J.at(F.col("v"), "$.k", "bigint"), F.lit(-1).cast("bigint")).alias("k"))


@query("select pr_id, number, title, coalesce(list_aggregate(tags, 'string_agg', ','), '') tags from pull_requests")
def json_roundtrip(spark, d):
    """Records to JSON and back through the declared layout."""
    p = table(spark, d, "pull_requests", "pr_id", "number", "title", "tags")
    back = F.from_json(F.to_json(F.struct("number", "title", "tags")), "number bigint, title string, tags array<string>")
    return p.select("pr_id", back.alias("r")).select("pr_id", "r.number", "r.title", F.coalesce(F.array_join("r.tags", ","), F.lit("")).alias("tags"))


def _pages(spark, d):
    """Pages of issues, as a listing would have captured them, built from the rows: heading, labels, links, unclosed tags, scripts and comments."""
    esc = lambda c: F.replace(F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    i = table(spark, d, "issues", "issue_id", "repo_url", "number", "title", "state", "author", "tags")
    labels = F.array_join(F.transform(F.coalesce("tags", F.array()), lambda t: F.concat(F.lit('<a class="IssueLabel" href="/labels/'), t, F.lit('">'), t, F.lit("</a>"))), "")
    html = F.concat(
        F.lit("<html><head><title>Issue "), F.col("number").cast("string"), F.lit('</title><script>var x = "</p>";</script></head><body><nav><ul><li><a href="/explore">Explore</a></ul></nav><h1 class="gh-header-title">'), esc("title"), F.lit(" <b>#"), F.col("number").cast("string"),
        F.lit('</h1><!-- note --><span class="State State--'), F.coalesce(F.lower("state"), F.lit("open")), F.lit('">'), F.coalesce("state", F.lit("Open")), F.lit("</span><br>"), labels, F.lit('<p>See <a href="'), F.col("repo_url"), F.lit("/pull/"), F.col("number").cast("string"),
        F.lit('#top">this</a> and <a href="pull/'), (F.col("number") + 1).cast("string"), F.lit('/files?w=1">that</a></p></body></html>'),
    )
    return i.select("issue_id", "repo_url", "number", html.alias("html"))


_HTML = r"""
    pages as (select issue_id, repo_url, number, '<html><head><title>Issue ' || number || '</title><script>var x = "</p>";</script></head><body><nav><ul><li><a href="/explore">Explore</a></ul></nav><h1 class="gh-header-title">' ||
        replace(replace(coalesce(title, ''), '&', '&amp;'), '<', '&lt;') || ' <b>#' || number || '</h1><!-- note --><span class="State State--' || coalesce(lower(state), 'open') || '">' || coalesce(state, 'Open') || '</span><br>' ||
        coalesce(array_to_string([ '<a class="IssueLabel" href="/labels/' || t || '">' || t || '</a>' for t in tags ], ''), '') || '<p>See <a href="' || repo_url || '/pull/' || number || '#top">this</a> and <a href="pull/' || (number + 1) || '/files?w=1">that</a></p></body></html>' html
      from issues)"""


@query(f"""
    with {_HTML} select issue_id, trim(split_part(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<h1\\b[^>]*>(.*?)</h1>', 1), '<[^>]*>', '', 'g'), '\\s+', ' ', 'g'), '#', 1)) title from pages""")
def html_title_cascade(spark, d):
    return _pages(spark, d).select("issue_id", X.clean_title(H.title_of(F.col("html"))).alias("title"))


@query(f"""
    with {_HTML}, l as (select issue_id, repo_url, unnest(regexp_extract_all(html, '(?i)<a\\b[^>]*\\bhref="([^"]*)"', 1)) href from pages where html is not null),
    a as (select issue_id, repo_url, split_part(split_part(case when starts_with(href, '/') then regexp_extract(repo_url, '^(https?://[^/]+)', 1) || href when regexp_matches(href, '^https?://') then href else repo_url || '/' || href end, '#', 1), '?', 1) url from l)
    select issue_id, regexp_extract(url, '^(.*?/pull/\\d+)', 1) url, count(*) n from a where starts_with(url, repo_url || '/pull/') and regexp_matches(url, '/pull/\\d+') group by all""")
def html_links(spark, d):
    """Links of pages to requests of their own repository: absolute, canonical, counted."""
    links = _pages(spark, d).select("issue_id", "repo_url", F.explode(H.hrefs(F.col("html"))).alias("href"))
    urls = links.select("issue_id", "repo_url", X.without_suffix(X.absolute(F.col("href"), F.col("repo_url"))).alias("url"))
    return urls.where(X.belongs_to(F.col("url"), F.col("repo_url"))).groupBy("issue_id", X.canonical_pull(F.col("url")).alias("url")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""
    with {_HTML} select issue_id, array_to_string(list_distinct_order, ',') tags from (select issue_id, list_filter(t, lambda x, i: list_position(t, x) = i) list_distinct_order from (select issue_id, regexp_extract_all(lower(html), '<([a-z][a-z0-9]*)', 1) t from pages where html is not null))""")
def html_tags(spark, d):
    return _pages(spark, d).where("html is not null").select("issue_id", F.array_join(H.tags_of(F.col("html")), ",").alias("tags"))


@query(f"with {_HTML} select issue_id, 'Issue ' || p.number || 'Explore' || trim(coalesce(title, '')) || case when trim(coalesce(title, '')) = '' then '' else '' end || '#' || p.number || coalesce(state, 'Open') || coalesce(array_to_string(tags, ''), '') || 'Seethisandthat' as page_text from pages p join issues using (issue_id) where html is not null")
def html_text(spark, d):
    """The text nodes of pages through the tolerant tree, joined without separator."""
    return _pages(spark, d).where("html is not null").select("issue_id", H.html_text(F.col("html")).alias("page_text"))


@query()
def html_fields(spark, d):
    """All fields of a page at once, each by its cascade of selectors."""
    f = _pages(spark, d).withColumn("f", H.page_fields(F.col("html"), issue=True))
    return f.select("issue_id", "f.title", "f.state", "f.author", F.array_join("f.tags", ",").alias("tags"))


@query(r"""
    select pr_id, regexp_full_match(repo_url, 'https://[^/]+/[^/]+/[^/]+/?') valid_repo, starts_with(url, rtrim(repo_url, '/') || '/pull/') and regexp_matches(url, '/pull/\d+') own_pull, number between 1 and 50000 plausible from pull_requests""")
def url_validity(spark, d):
    p = table(spark, d, "pull_requests", "pr_id", "repo_url", "url", "number")
    return p.select("pr_id", X.is_repo_url(F.col("repo_url")).alias("valid_repo"), X.belongs_to(F.col("url"), F.col("repo_url")).alias("own_pull"), F.col("number").between(1, 50_000).alias("plausible"))


@query("""
    with a as (select repo_url, number, 'issue' kind, title from issues union all select repo_url, number, 'pr', title from pull_requests)
    select repo_url, number, count(distinct kind) n_kinds, min(title) first_title from a group by repo_url, number""")
def shared_numbers(spark, d):
    """Numbers of issues and requests side by side: which are used by both."""
    of = lambda t, k: table(spark, d, t, "repo_url", "number", "title").withColumn("kind", F.lit(k))
    return of("issues", "issue").unionByName(of("pull_requests", "pr")).groupBy("repo_url", "number").agg(F.count_distinct("kind").alias("n_kinds"), F.min("title").alias("first_title"))


@query("""
    select issue_id, list_aggregate(list_filter(tags, lambda x, i: list_position(tags, x) = i), 'string_agg', ',') tags, len(tags) n from issues where len(tags) > 0""")
def distinct_tags(spark, d):
    i = table(spark, d, "issues", "issue_id", "tags").where(F.size("tags") > 0)
    return i.select("issue_id", F.array_join(F.array_distinct("tags"), ",").alias("tags"), F.size("tags").cast("bigint").alias("n"))


@query("select repo_url, pr_number, issue_number from pr_issue qualify row_number() over (partition by repo_url, pr_number, issue_number order by link_pos) = 1")
def attached_issues(spark, d):
    """Each link of a request to an issue once; an issue is attached to every request that refers to it."""
    return first_rows(table(spark, d, "pr_issue"), ["repo_url", "pr_number", "issue_number"], ["link_pos"]).drop("link_pos")
