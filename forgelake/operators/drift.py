"""Schemas that drift between files: path statistics, changes, one typed table.

Rows become path-value maps with raw JSON kinds (variants, so no schema is
imposed on reading); kinds are counted per file and path; files of a series are
compared with the file written just before; and one table with typed columns is
projected, in which renamed paths share a column and failed casts are reported.
All work per record stays in the JVM; what is kept per file is as large as its
layout, not as its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.errors import LayoutError

#: Distinct renamed or typed paths that the projection may hold in its plan.
MAX_PATHS = 5000

#: Names must be this alike (1 - edit distance / longer length) for a rename if one side's kind is unknown.
ALIKE = 0.5


def parsed(lines: DataFrame, raw: str) -> DataFrame:
    """lines with `record`, the variant of `raw` where it holds one complete JSON object, else null."""
    v = F.try_parse_json(F.col(raw))
    return lines.withColumn("__v", v).withColumn("record", F.when(F.schema_of_variant("__v").startswith("OBJECT"), F.col("__v"))).drop("__v")


def raw_kind(v: Column) -> Column:
    """JSON kind of a variant: string, number, boolean, object, array<kinds of items>; null where nulls and empty arrays tell none."""
    s = F.schema_of_variant(v)
    one = lambda t: F.when(t.startswith("OBJECT"), "object").when(t.startswith("ARRAY"), "array").when(t == "STRING", "string").when(t == "BOOLEAN", "boolean").when(t.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), "number").when(t == "VARIANT", "mixed").when(t != "VOID", F.lower(t))
    item = F.substring(s, 7, 1 << 30)
    return F.when(s.startswith("ARRAY<"), F.concat(F.lit("array<"), one(F.regexp_replace(item, ">$", "")), F.lit(">"))).otherwise(one(s))


def path_values(records: DataFrame, keep: Sequence[str], parents: Sequence[str]) -> DataFrame:
    """keep..., path, value of every key at the top of `record`, and of the objects in `parents` (through arrays)."""
    entries = lambda v: F.try_variant_get(v, "$", "map<string,variant>")
    top = records.where("record is not null").select(*keep, F.explode(entries(F.col("record"))).alias("path", "value"))
    if not parents:
        return top
    s = F.schema_of_variant("value")
    inner = F.when(s.startswith("OBJECT"), F.array("value")).when(s.startswith("ARRAY"), F.try_variant_get("value", "$", "array<variant>"))
    below = top.where(F.col("path").isin(*parents)).select(*keep, "path", F.explode(inner).alias("o")).select(*keep, "path", F.explode(entries(F.col("o"))).alias("k", "value"))
    return top.unionByName(below.select(*keep, F.concat_ws(".", "path", "k").alias("path"), "value"))


def is_broken_number(v: Column) -> Column:
    """Whether a variant is a number that a bigint can't hold whole."""
    s = F.schema_of_variant(v)
    return s.rlike("^(DOUBLE|FLOAT)") | (s.startswith("DECIMAL") & F.coalesce(F.try_variant_get(v, "$", "decimal(38,18)") != F.try_variant_get(v, "$", "bigint"), F.lit(True)))


def path_stats(lines: DataFrame, file: str, raw: str, parents: Sequence[str]) -> DataFrame:
    """file, path, kind, n, n_broken: how many values of each raw kind each file has at each path, and how many of them are numbers that aren't whole."""
    values = path_values(parsed(lines, raw), [file], parents).select(file, "path", raw_kind(F.col("value")).alias("kind"), is_broken_number(F.col("value")).alias("broken"))
    return values.groupBy(file, "path", "kind").agg(F.count(F.lit(1)).alias("n"), F.count_if("broken").alias("n_broken"))


def changes(stats: DataFrame, files: DataFrame, file: str, series: str, written_at: str) -> DataFrame:
    """file, change_kind, old_path, new_path of every difference to the file of the series written just before.

    files: one row per file; ties in written_at go by the file's id. A file
    without a complete record has no layout and is passed over. Repeated rows
    count once; files with null series or time are no part of a sequence.
    """
    layout = stats.groupBy(file, "path").agg(F.array_join(F.array_sort(F.collect_set("kind")), "|").alias("kind"))
    known = files.where(F.col(series).isNotNull() & F.col(written_at).isNotNull()).groupBy(file).agg(F.min(series).alias("__s"), F.min(written_at).alias("__w")).join(stats.select(file).distinct(), file, "left_semi")
    known = known.selectExpr(f"`{file}` as __f", f"lag(`{file}`) over (partition by __s order by __w, `{file}`) as __p").where("__p is not null")
    side = lambda at, k: known.join(layout.withColumnRenamed(file, at), at).select("__f", "path", *[(F.col("kind") if x == k else F.lit(None).cast("string")).alias(x) for x in ("old", "new")])
    both = side("__f", "new").unionByName(side("__p", "old")).groupBy("__f", "path").agg(F.max("old").alias("old"), F.max("new").alias("new"))
    diff = both.where("old is null or new is null or old != new").withColumn("parent", F.regexp_replace("path", r"\.?[^.]*$", ""))
    # The unmatched keys of one object of one file: at most as many as its layout has.
    item = lambda c: F.when(c, F.struct("path", F.coalesce("old", "new").alias("kind")))
    objects = diff.groupBy("__f", "parent").agg(F.collect_list(item(F.col("new").isNull())).alias("gone"), F.collect_list(item(F.col("old").isNull())).alias("come"), F.collect_list(F.when(F.expr("old != '' and new != ''"), F.col("path"))).alias("typed"))
    leaf = lambda p: F.lower(F.substring_index(p, ".", -1))
    alike = lambda a, b: 1 - F.levenshtein(leaf(a), leaf(b)) / F.greatest(F.length(leaf(a)), F.length(leaf(b)))
    pair = lambda g, c: F.struct((-alike(g["path"], c["path"])).alias("score"), g["path"].alias("old"), c["path"].alias("new"), (g["kind"] == c["kind"]).alias("same"), ((g["kind"] == "") | (c["kind"] == "")).alias("dim"))
    fits = F.filter(F.flatten(F.transform("gone", lambda g: F.transform("come", lambda c: pair(g, c)))), lambda x: x["same"] | (x["dim"] & (x["score"] <= -ALIKE)))
    empty = F.expr("cast(array() as array<struct<old:string,new:string>>)")
    free = lambda acc, x: ~F.exists(acc, lambda y: (y["old"] == x["old"]) | (y["new"] == x["new"]))
    objects = objects.withColumn("fits", F.array_sort(fits)).withColumn("renamed", F.aggregate("fits", empty, lambda acc, x: F.when(free(acc, x), F.concat(acc, F.array(F.struct(x["old"].alias("old"), x["new"].alias("new"))))).otherwise(acc)))
    row = lambda kind, old, new: F.struct(F.lit(kind).alias("change_kind"), old.alias("old_path"), new.alias("new_path"))
    left = lambda c, f: F.filter(F.transform(c, lambda x: x["path"]), lambda p: ~F.exists("renamed", lambda r: r[f] == p))
    rows = F.concat(
        F.transform("renamed", lambda r: row("renamed", r["old"], r["new"])), F.transform(left(F.col("gone"), "old"), lambda p: row("removed", p, F.lit(""))),
        F.transform(left(F.col("come"), "new"), lambda p: row("added", F.lit(""), p)), F.transform("typed", lambda p: row("retyped", p, p)),
    )
    return objects.select(F.col("__f").alias(file), F.inline(rows))


def layout_plan(stats: DataFrame, changed: DataFrame) -> list[dict]:
    """The columns of the common table: path, its aliases and the type to read it with.

    Paths tied by renames share one column, named after the path most values
    have; its type is that of the most frequent kind, numbers being bigint
    where all are whole, else double. At most MAX_PATHS rows, one per path and
    kind, come to the driver: they describe layouts, not data.
    """
    seen = stats.groupBy("path", "kind").agg(F.sum("n").alias("n"), F.sum("n_broken").alias("n_broken")).limit(MAX_PATHS + 1).collect()
    tied = changed.where("change_kind = 'renamed'").select("old_path", "new_path").distinct().limit(MAX_PATHS + 1).collect()
    if max(len(seen), len(tied)) > MAX_PATHS:
        raise LayoutError(f"more than {MAX_PATHS} paths: not a drifting schema but keys that hold data")
    root: dict[str, str] = {}

    def find(p: str) -> str:
        while root.get(p, p) != p:
            p = root[p]
        return p

    for r in sorted(tied):
        a, b = find(r[0]), find(r[1])
        if a != b:
            root[max(a, b)] = min(a, b)
    groups: dict[str, dict] = {}
    for path, kind, n, broken in seen:
        g = groups.setdefault(find(path), {"paths": {}, "kinds": {}, "broken": 0})
        g["broken"] += broken
        g["paths"][path] = g["paths"].get(path, 0) + n
        if kind:
            g["kinds"][kind] = g["kinds"].get(kind, 0) + n
    out = []
    for g in groups.values():
        types = {"number": "double" if g["broken"] else "bigint", "boolean": "boolean", "string": "string"}
        names = sorted(g["paths"], key=lambda p: (-g["paths"][p], p))
        kind = min(g["kinds"], key=lambda k: (-g["kinds"][k], k)) if g["kinds"] else "string"
        out.append({"path": names[0], "aliases": names, "kind": kind, "type": types.get(kind, "array<string>" if kind == "array<string>" else "string")})
    return sorted(out, key=lambda c: c["path"])


def typed_table(lines: DataFrame, keep: Sequence[str], raw: str, plan: list[dict]) -> DataFrame:
    """keep..., one typed column per entry of plan (dots become __), and failed_casts.

    failed_casts lists the paths whose value is there but can't be read as the
    column's type without loss; the column is null then. Numbers and texts of
    numbers fit number columns as far as they are equal there (1.5 is no
    bigint, and neither is true), booleans and their texts boolean columns.
    Objects and arrays of anything but strings keep their JSON text. A column whose name clashes with one of keep
    gets `_` put behind it.
    """
    return _typed(parsed(lines, raw).where("record is not null"), keep, plan)


def typed_items(lines: DataFrame, keep: Sequence[str], raw: str, parent: str, pos: str, plan: list[dict]) -> DataFrame:
    """typed_table of the objects in the array `parent`: a row for each, with keep... and its position `pos`.

    plan has the paths below parent. An object in place of the array counts as
    its only item. Items that are no objects keep their row, with no value and
    with parent in failed_casts (nulls without); records without items have none.
    """
    v = F.try_variant_get("record", f"$['{parent}']", "variant")
    s = F.schema_of_variant(v)
    items = F.when(s.startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>")).when(v.isNotNull() & ~F.is_variant_null(v), F.array(v))
    rows = parsed(lines, raw).where("record is not null").select(*keep, F.posexplode(items).alias("__pos", "record")).select(*keep, F.col("__pos").cast("bigint").alias(pos), "record")
    odd = F.col("record").isNotNull() & ~F.is_variant_null("record") & ~F.schema_of_variant("record").startswith("OBJECT")
    below = [c | {"aliases": [p[len(parent) + 1:] for p in c["aliases"]]} for c in plan]
    return _typed(rows, [*keep, pos], below, F.when(odd, F.lit(parent)))


def _read(x: Column, to: str) -> Column:
    """The variant read as bigint, double, boolean or array<string>; null where that loses anything."""
    s, text = F.schema_of_variant(x), F.btrim(F.try_variant_get(x, "$", "string"))
    exact = text.try_cast("decimal(38,18)")
    if to == "bigint":
        whole = F.coalesce(text.try_cast("bigint"), F.when(exact == F.floor(exact), exact).try_cast("bigint"), F.when(text.try_cast("double") == F.floor(text.try_cast("double")), text.try_cast("double").try_cast("decimal(38,0)")).try_cast("bigint"))
        return F.when((s != "BOOLEAN") & (exact.isNull() | (exact == whole)), whole)
    if to == "double":
        near = text.try_cast("double")
        whole = text.try_cast("decimal(38,0)")
        return F.when((s != "BOOLEAN") & ~F.isnan(near) & (~text.rlike(r"^[+-]?\d+$") | (near.try_cast("decimal(38,0)") == whole)), near)
    if to == "boolean":
        return F.when((s == "BOOLEAN") | F.lower(text).isin("true", "false"), text.try_cast("boolean"))
    return F.when(s.startswith("ARRAY"), F.try_variant_get(x, "$", to))


def _typed(records: DataFrame, keep: Sequence[str], plan: list[dict], *failed: Column) -> DataFrame:
    taken, held, columns, fails = set(keep), [f.alias(f"__f{i}") for i, f in enumerate(failed)], [], [F.col(f"__f{i}") for i in range(len(failed))]
    for i, c in enumerate(plan):
        name = c["path"].replace(".", "__")
        while name in taken:
            name += "_"
        taken.add(name)
        found = F.coalesce(*[F.try_variant_get("record", "$" + "".join(f"['{k}']" for k in p.split(".")), "variant") for p in c["aliases"]])
        held.append(found.alias(f"__x{i}"))
        x = F.col(f"__x{i}")
        text = F.coalesce(F.try_variant_get(x, "$", "string"), F.to_json(x))
        value = text if c["type"] == "string" else _read(x, c["type"])
        there = x.isNotNull() & ~F.is_variant_null(x)
        columns.append(F.when(there, value).alias(name))
        fails.append(F.when(there & value.isNull(), F.lit(c["path"])))
    return records.select(*keep, *held).select(*keep, *columns, F.array_compact(F.array(*fails)).alias("failed_casts"))
