"""Problem 2: schemas that drift between files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.operators import drift
from forgelake.session import written
from forgelake.sources.tables import table

#: Objects whose keys count besides those at the top.
PARENTS = ("stats", "pull_requests")


def stats_of(spark: SparkSession, d: str, parents=PARENTS) -> DataFrame:
    return drift.path_stats(table(spark, d, "crawl_lines", "file_id", "raw_line"), "file_id", "raw_line", parents)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "crawl_files", "file_id", "series", "written_at")
    stats = written(stats_of(spark, d), "p2-stats")  # read three times; one row per file, path and kind
    return drift.changes(stats, files, "file_id", "series", "written_at").distinct()


def p2_path_stats(spark: SparkSession, d: str) -> DataFrame:
    """How many values of each raw kind each file has at each path ('' for nulls and empty arrays)."""
    return stats_of(spark, d).withColumn("kind", F.coalesce("kind", F.lit(""))).drop("n_broken")


def layout(spark: SparkSession, d: str) -> list[dict]:
    files = table(spark, d, "crawl_files", "file_id", "series", "written_at")
    stats = written(stats_of(spark, d), "p2-stats")
    return drift.layout_plan(stats, drift.changes(stats, files, "file_id", "series", "written_at"))


def p2_records(spark: SparkSession, d: str) -> DataFrame:
    """All complete records of all files in one layout; their pull requests, here as JSON text, are in p2_pull_requests."""
    plan = [c for c in layout(spark, d) if c["path"] != "stats" and not c["path"].startswith("pull_requests.")]
    return drift.typed_table(table(spark, d, "crawl_lines", "line_id", "file_id", "line_no", "raw_line"), ["line_id", "file_id", "line_no"], "raw_line", plan)


def p2_pull_requests(spark: SparkSession, d: str) -> DataFrame:
    """The pull requests of all complete records in one layout, by line_id and pr_pos."""
    plan = [c for c in layout(spark, d) if c["path"].startswith("pull_requests.")]
    return drift.typed_items(table(spark, d, "crawl_lines", "line_id", "file_id", "line_no", "raw_line"), ["line_id", "file_id", "line_no"], "raw_line", "pull_requests", "pr_pos", plan)


QUERIES = {"p2_found": p2_found, "p2_path_stats": p2_path_stats, "p2_records": p2_records, "p2_pull_requests": p2_pull_requests}

def _one(t: str) -> str:
    return f"case when {t} in ('BIGINT', 'UBIGINT', 'DOUBLE', 'HUGEINT') then 'number' when {t} = 'VARCHAR' then 'string' when {t} = 'BOOLEAN' then 'boolean' when {t} = 'OBJECT' then 'object' else '' end"


_STATS = f"""
    o as (select file_id, line_id, j from (select file_id, line_id, try_cast(raw_line as json) j from crawl_lines) where json_type(j) = 'OBJECT'),
    top as (select file_id, k path, json_extract(j, '$."' || k || '"') v from (select file_id, j, unnest(json_keys(j)) k from o)),
    inner_ as (select file_id, path, v o from top where path in ('stats', 'pull_requests') and json_type(v) = 'OBJECT' union all select file_id, path, unnest(cast(v as json[])) from top where path in ('stats', 'pull_requests') and json_type(v) = 'ARRAY'),
    pv as (select * from top union all select file_id, path || '.' || k, json_extract(o, '$."' || k || '"') from (select file_id, path, o, unnest(json_keys(o)) k from inner_ where json_type(o) = 'OBJECT')),
    kinds as (select file_id, path, case when json_type(v) = 'ARRAY' then coalesce('array<' || nullif(list_aggregate(list_sort(list_distinct(list_filter(list_transform(cast(v as json[]), lambda x: {_one("json_type(x)")}), lambda y: y <> ''))), 'string_agg', '+'), '') || '>', '') else {_one("json_type(v)")} end kind from pv),
    stats as (select file_id, path, kind, count(*) n from kinds group by all)"""
SQL = {
    "p2_path_stats": f"with {_STATS} select * from stats",
    "p2_found": f"""
        with {_STATS}, layout as (select file_id, path, string_agg(nullif(kind, ''), '|' order by kind) kind from stats group by file_id, path),
        pairs as (select file_id, lag(file_id) over (partition by series order by written_at, file_id) prev from crawl_files where file_id in (select file_id from layout)),
        d as (select file_id, path, max(o) o, max(n) n, bool_or(is_old) was, bool_or(not is_old) now_ from (select p.file_id, path, coalesce(kind, '') n, null o, false is_old from pairs p join layout l using (file_id) where prev is not null
              union all select p.file_id, path, null, coalesce(kind, ''), true from pairs p join layout l on l.file_id = p.prev) group by file_id, path),
        e as (select *, regexp_replace(path, '\\.?[^.]*$', '') parent from d),
        r as (select a.file_id, a.path old_path, b.path new_path from e a join e b on a.file_id = b.file_id and a.parent = b.parent and a.o = b.n where not a.now_ and not b.was)
        select file_id, 'renamed' change_kind, old_path, new_path from r union all select file_id, 'retyped', path, path from e where was and now_ and o <> '' and n <> '' and o <> n
        union all select file_id, 'removed', path, '' from e where not now_ and (file_id, path) not in (select file_id, old_path from r) union all select file_id, 'added', '', path from e where not was and (file_id, path) not in (select file_id, new_path from r)""",
}
