"""Embedded JSON: detection, path cascades and comments from variants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from forgelake.functions.text import shortened, strip


def scripts(html: Column) -> Column:
    """The texts of a page's scripts that look like one JSON object."""
    each = F.regexp_extract_all(html, F.lit(r"(?is)<script\b[^>]*>(.*?)</script>"), F.lit(1))
    return F.filter(F.transform(each, strip), lambda x: x.startswith("{") & x.endswith("}"))


def variants(html: Column) -> Column:
    """Those that parse, as variants."""
    return F.array_compact(F.transform(scripts(html), F.try_parse_json))


def at(v: Column, path: str, kind: str = "variant") -> Column:
    """A value by path; null where it is missing, null or of another type."""
    return F.try_variant_get(v, path, kind)


def timeline(v: Column) -> Column:
    """array<variant>: the entries of a page's timeline, by the first of four layouts that has a list.

    The queries of payload.preloadedQueries in order; then the first key of
    payload.preloaded_records with `timeline` in it; then timeline; then
    comments.
    """
    queries = at(v, "$.payload.preloadedQueries", "array<variant>")
    edges = F.filter(F.transform(queries, lambda q: at(q, "$.result.data.repository.issue.frontTimelineItems.edges", "array<variant>")), lambda x: x.isNotNull())
    records = at(v, "$.payload.preloaded_records", "map<string,variant>")
    named = F.filter(F.map_entries(records), lambda e: F.contains(F.lower(e["key"]), F.lit("timeline")) & at(e["value"], "$", "array<variant>").isNotNull())
    return F.coalesce(F.get(edges, F.lit(0)), at(F.get(named, F.lit(0))["value"], "$", "array<variant>"), at(v, "$.timeline", "array<variant>"), at(v, "$.comments", "array<variant>"))


def comment_of(item: Column) -> Column:
    """The variant that is the comment in a timeline entry, or null: its node if that is a comment, else itself, else its comment."""
    kind = lambda x: at(x, "$.__typename", "string")
    node = at(item, "$.node")
    itself = (kind(item) == "IssueComment") | at(item, "$.body").isNotNull()
    return F.when(node.isNotNull(), F.when(kind(node) == "IssueComment", node)).when(itself, item).otherwise(at(item, "$.comment"))


def comment_fields(c: Column, lowest: int = 5, most: int = 2000) -> Column:
    """author, timestamp, content of a comment variant; null if its text is too short."""
    body = strip(F.coalesce(at(c, "$.body", "string"), at(c, "$.bodyText", "string"), F.lit("")))
    author = F.coalesce(at(c, "$.author.login", "string"), at(c, "$.author.name", "string"), at(c, "$.author", "string"), F.lit("unknown"))
    when = F.coalesce(at(c, "$.createdAt", "string"), at(c, "$.created_at", "string"))
    return F.when(F.length(body) >= lowest, F.struct(author.alias("author"), when.alias("timestamp"), shortened(body, most).alias("content")))


def posting(v: Column) -> Column:
    """The comment of a schema.org DiscussionForumPosting, or null."""
    text = F.coalesce(at(v, "$.articleBody", "string"), at(v, "$.text", "string"))
    row = F.struct(F.coalesce(at(v, "$.author.name", "string"), F.lit("unknown")).alias("author"), at(v, "$.datePublished", "string").alias("timestamp"), text.alias("content"))
    return F.when((at(v, "$['@type']", "string") == "DiscussionForumPosting") & text.isNotNull(), row)


def page_comments(html: Column) -> Column:
    """array<struct<author,timestamp,content>>: the comments in a page's JSON, once by text, by written time."""
    def of(v: Column) -> Column:
        listed = F.transform(F.coalesce(timeline(v), F.expr("cast(array() as array<variant>)")), lambda i: comment_fields(comment_of(i)))
        return F.array_compact(F.concat(F.array(posting(v)), listed))

    every = F.flatten(F.transform(variants(html), of))
    numbered = F.transform(every, lambda x, i: F.struct(F.coalesce(x["timestamp"], F.lit("")).alias("t"), i.alias("i"), x.alias("c")))
    kept = F.filter(numbered, lambda x: ~F.exists(numbered, lambda y: (y["c"]["content"] == x["c"]["content"]) & (y["i"] < x["i"])))
    return F.transform(F.array_sort(kept), lambda x: x["c"])
