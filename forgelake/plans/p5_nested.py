"""Problem 5: deeply nested records to flat tables with links to their parents."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.operators.shredding import array_shapes, rebuild, shred
from forgelake.session import written
from forgelake.sources.tables import table

#: Share of an array's items that must have a shape.
MOST = 0.5


def arrays_by_shape(shapes: dict[str, dict[str, int]]) -> dict[str, str]:
    """kind -> pattern of the array paths of that kind, told by the shapes of their items over all records, whatever their keys are called.

    Pull requests: objects with a number at the top of the record that hold
    arrays or objects (any arrays of objects with a number, if none does).
    Below them, related issues are numbers or objects with a number; comments,
    below requests and issues, are objects with a text of several words and no
    number, or mostly texts of several words. Lists of single words, such as tags
    and commit ids, are none of these.
    """
    depth = lambda p: p.count("[]")
    share = lambda s, *names: sum(s[n] for n in names) / max(1, sum(s[n] for n in ("objects", "numbers", "prose", "words", "others")))
    numbered = {p for p, s in shapes.items() if s["objects"] and s["with_number"] >= MOST * s["objects"]}
    top = {p for p in numbered if depth(p) == 1 and share(shapes[p], "objects") >= MOST}
    pulls = {p for p in top if shapes[p]["with_below"]} or top
    below = lambda tops: {p for p in shapes if any(p.startswith(t + ".") and depth(p) == depth(t) + 1 for t in tops)}
    issues = {p for p in below(pulls) if share(shapes[p], "numbers", "objects") >= MOST and (p in numbered or shapes[p]["numbers"] and not shapes[p]["objects"])}

    def comment(p: str) -> bool:
        s = shapes[p]
        return p not in issues and p not in numbered and ((s["objects"] and s["with_prose"] >= MOST * s["objects"]) or share(s, "prose") >= MOST)

    kinds = {"pull_request": pulls, "pr_comment": {p for p in below(pulls) if comment(p)}, "related_issue": issues, "issue_comment": {p for p in below(issues) if comment(p)}}
    return {k: "|".join(re.escape(p) for p in sorted(paths)) for k, paths in kinds.items() if paths}


_PR_FIELDS = {
    "number": ["number"], "title": ["title"], "state": ["state"], "author": ["author", "author.login"], "created_at": ["created_at"], "updated_at": ["updated_at", "modified_at"], "url": ["url"],
    "commit_id": ["commit_id", "merge_commit"], "previous_commit_id": [f"{p}{x}" for p in ("previous_commit_id", "prev_commit", "previousCommitId", "parent_sha") for x in ("", ".sha")],
}


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "crawl_lines", "line_id", "raw_line")


def _links(rows: DataFrame, *more: str) -> DataFrame:
    """pr_pos, issue_pos, comment_pos from the positions; -1 where a level doesn't apply."""
    at = lambda i: F.get("pos", F.lit(i))
    none = F.lit(-1).cast("bigint")
    kind = F.col("kind")
    return rows.select(
        "line_id", kind.alias("child_kind"), at(0).alias("pr_pos"), F.when(kind.isin("related_issue", "issue_comment"), at(1)).otherwise(none).alias("issue_pos"),
        F.when(kind == "pr_comment", at(1)).when(kind == "issue_comment", at(2)).otherwise(none).alias("comment_pos"), *more,
    )


def _skeleton(spark: SparkSession, d: str) -> tuple[DataFrame, dict[str, str]]:
    """The item columns of all arrays, written once, and the patterns of the arrays' paths by kind."""
    shredded = written(shred(_lines(spark, d), ["line_id"], "raw_line", arrays_only=True), "p5-levels")
    return shredded, arrays_by_shape(array_shapes(shredded))


def _with_fields(spark: SparkSession, d: str, kinds: tuple[str, ...], fields: dict) -> DataFrame:
    """Rows of the kinds with the leaves right below their items; only those are shredded, once the arrays are known."""
    arrays = {k: p for k, p in _skeleton(spark, d)[1].items() if k in kinds}
    ways = {p.replace("\\", "")[:-2] for k in arrays for p in arrays[k].split("|")}
    steps = {re.escape(w[:i]) for w in ways for i in [*[m.start() for m in re.finditer(r"\[\]", w)], len(w)]}
    leaf = "|".join(f"{re.escape(w + '[]')}\\.[^\\[\\]]*" for w in ways)
    only = rf"(?:{'|'.join(sorted(steps))}|{leaf})$" if ways else r"(?!)"
    return rebuild(shred(_lines(spark, d), ["line_id"], "raw_line", only), ["line_id"], arrays, fields)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    shredded, arrays = _skeleton(spark, d)
    return _links(rebuild(shredded, ["line_id"], arrays)).distinct()


def p5_pull_requests(spark: SparkSession, d: str) -> DataFrame:
    """One row per nested pull request; (line_id, pr_pos) is its key."""
    rows = _with_fields(spark, d, ("pull_request",), _PR_FIELDS)
    return _links(rows, *_PR_FIELDS).drop("child_kind", "issue_pos", "comment_pos").withColumn("number", F.col("number").try_cast("bigint"))


def p5_issues(spark: SparkSession, d: str) -> DataFrame:
    """One row per related issue; (line_id, pr_pos) is its parent; an item that is only a number has no other field."""
    fields = {f: [f] for f in ("number", "title", "state", "author", "created_at", "updated_at", "url")}
    rows = _with_fields(spark, d, ("related_issue",), fields)
    return _links(rows, "item", *fields).select("line_id", "pr_pos", "issue_pos", F.coalesce("number", "item").try_cast("bigint").alias("number"), "title", "state", "author", "created_at", "updated_at", "url")


def p5_comments(spark: SparkSession, d: str) -> DataFrame:
    """One row per comment of a pull request or issue, with the positions of its parents; a bare text is its content."""
    fields = {"author": ["author"], "posted_at": ["timestamp"], "content": ["content"]}
    rows = _with_fields(spark, d, ("pr_comment", "issue_comment"), fields)
    return _links(rows, "author", "posted_at", F.coalesce("content", "item").alias("content"))


QUERIES = {"p5_found": p5_found, "p5_pull_requests": p5_pull_requests, "p5_issues": p5_issues, "p5_comments": p5_comments}
_PRS = """
    o as (select line_id, j from (select line_id, try_cast(raw_line as json) j from crawl_lines) where json_type(j) = 'OBJECT'),
    a as (select line_id, cast(json_extract(j, '$.pull_requests') as json[]) prs from o where json_type(j, '$.pull_requests') = 'ARRAY'),
    prs as (select line_id, unnest(prs) p, unnest(range(len(prs))) pr_pos from a)"""
_BELOW = """
    pc as (select line_id, pr_pos, unnest(cast(json_extract(p, '$.comments') as json[])) c, unnest(range(cast(json_array_length(p, '$.comments') as bigint))) comment_pos from prs where json_type(p, '$.comments') = 'ARRAY'),
    ri as (select line_id, pr_pos, unnest(cast(i as json[])) i, unnest(range(cast(json_array_length(i) as bigint))) issue_pos from (select line_id, pr_pos, coalesce(json_extract(p, '$.related_issues'), json_extract(p, '$.linked_issues')) i from prs) where json_type(i) = 'ARRAY'),
    ic as (select line_id, pr_pos, issue_pos, unnest(cast(json_extract(i, '$.comments') as json[])) c, unnest(range(cast(json_array_length(i, '$.comments') as bigint))) comment_pos from ri where json_type(i, '$.comments') = 'ARRAY')"""
SQL = {
    "p5_found": f"""
        with {_PRS}, {_BELOW}
        select line_id, 'pull_request' child_kind, cast(pr_pos as bigint) pr_pos, cast(-1 as bigint) issue_pos, cast(-1 as bigint) comment_pos from prs union all select line_id, 'pr_comment', pr_pos, -1, comment_pos from pc
        union all select line_id, 'related_issue', pr_pos, issue_pos, -1 from ri union all select line_id, 'issue_comment', pr_pos, issue_pos, comment_pos from ic""",
    "p5_pull_requests": f"""
        with {_PRS}, t as (select line_id, pr_pos, coalesce(nullif(json_extract_string(p, '$.author.login'), ''), case when json_type(p, '$.author') = 'VARCHAR' then json_extract_string(p, '$.author') end) author, p, coalesce(json_extract(p, '$.previous_commit_id'), json_extract(p, '$.prev_commit'), json_extract(p, '$.previousCommitId'), json_extract(p, '$.parent_sha')) v from prs)
        select line_id, pr_pos, cast(json_extract_string(p, '$.number') as bigint) number, json_extract_string(p, '$.title') title, json_extract_string(p, '$.state') state, author, json_extract_string(p, '$.created_at') created_at,
               coalesce(json_extract_string(p, '$.updated_at'), json_extract_string(p, '$.modified_at')) updated_at, json_extract_string(p, '$.url') url, coalesce(json_extract_string(p, '$.commit_id'), json_extract_string(p, '$.merge_commit')) commit_id,
               case json_type(v) when 'OBJECT' then json_extract_string(v, '$.sha') when 'VARCHAR' then json_extract_string(v, '$') end previous_commit_id from t""",
    "p5_issues": f"""
        with {_PRS}, {_BELOW}
        select line_id, pr_pos, issue_pos, case when json_type(i) = 'OBJECT' then cast(json_extract_string(i, '$.number') as bigint) else cast(json_extract_string(i, '$') as bigint) end number, json_extract_string(i, '$.title') title, json_extract_string(i, '$.state') state,
               json_extract_string(i, '$.author') author, json_extract_string(i, '$.created_at') created_at, json_extract_string(i, '$.updated_at') updated_at, json_extract_string(i, '$.url') url from ri""",
    "p5_comments": f"""
        with {_PRS}, {_BELOW}, c as (select line_id, 'pr_comment' child_kind, pr_pos, cast(-1 as bigint) issue_pos, comment_pos, c from pc union all select line_id, 'issue_comment', pr_pos, issue_pos, comment_pos, c from ic)
        select line_id, child_kind, pr_pos, issue_pos, comment_pos, json_extract_string(c, '$.author') author, json_extract_string(c, '$.timestamp') posted_at, case when json_type(c) = 'VARCHAR' then json_extract_string(c, '$') else json_extract_string(c, '$.content') end as content from c""",
}
