"""Filters, set joins, merges and limits over tables of records.

Joins are semi, anti, lookup or nest joins on keys. A side is only broadcast
when its size was checked (operators.lookup); Spark's adaptive execution
splits skewed sides.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.operators.lookup import sized
from forgelake.operators.ordered import first_rows


def at_least(df: DataFrame, column: str, threshold) -> DataFrame:
    """Rows whose value reaches the threshold; null never does. Filters of the same kind are merged by the optimiser."""
    return df.where(F.col(column) >= threshold)


def not_done(df: DataFrame, done: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key isn't in done; rows with a null key stay, as nothing is known of them."""
    return df.join(done.select(*on), list(on), "left_anti")


def already_done(df: DataFrame, done: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(done.select(*on), list(on), "left_semi")


def tiered_skips(df: DataFrame, key: str, tiers: Mapping[str, DataFrame], out: str = "skip_reason") -> DataFrame:
    """df with the name of the first tier (in order) that holds the key, else null: rows without a reason are still to do."""
    reason = F.lit(None).cast("string")
    for i, (name, done) in reversed(list(enumerate(tiers.items()))):
        flags = done.select(F.col(key).alias(f"__t{i}")).where(f"__t{i} is not null").distinct()
        df = df.join(flags, F.col(key) == F.col(f"__t{i}"), "left")
        reason = F.when(F.col(f"__t{i}").isNotNull(), name).otherwise(reason)
    return df.withColumn(out, reason).drop(*[f"__t{i}" for i in range(len(tiers))])


def split_by_cache(df: DataFrame, cache: DataFrame, key: Sequence[str], value: str, default) -> DataFrame:
    """df with the cached value (or the default) and hit, whether there was one; repeated cache keys count once, smallest value first."""
    one = cache.groupBy(*key).agg(F.min(value).alias(value)).withColumn("hit", F.lit(True))
    return df.join(one, list(key), "left").withColumns({"hit": F.coalesce("hit", F.lit(False)), value: F.coalesce(value, F.lit(default))})


def merge_new(old: DataFrame, new: DataFrame, key: Sequence[str], order: Sequence) -> DataFrame:
    """old, and of new the first row of each key that old lacks."""
    return old.unionByName(not_done(first_rows(new, key, order), old, key).select(*old.columns))


def union_keep_first(parts: Sequence[DataFrame], key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """All parts as one, one row per key: from the earliest part that has it, by order there."""
    every = parts[0].withColumn("part", F.lit(0))
    for i, p in enumerate(parts[1:], 1):
        every = every.unionByName(p.withColumn("part", F.lit(i)))
    return first_rows(every, key, ["part", *order])


def prefix_join(short: DataFrame, full: DataFrame, short_col: str, full_col: str, least: int = 7) -> DataFrame:
    """Each short id with the smallest full id that begins with it, else null.

    Ids meet on their first `least` characters, not pair by pair; shorter ids
    than that match nothing.
    """
    a = short.select(F.col(short_col)).where(F.length(short_col) >= least).distinct().withColumn("__p", F.substring(short_col, 1, least))
    b = full.select(F.col(full_col).alias("__full")).where(F.length("__full") >= least).distinct().withColumn("__p", F.substring("__full", 1, least))
    hits = a.join(b, "__p").where(F.startswith(F.col("__full"), F.col(short_col))).groupBy(short_col).agg(F.min("__full").alias(full_col))
    return short.select(short_col).distinct().join(hits, short_col, "left")


def nest(parents: DataFrame, children: DataFrame, on: Sequence[str], order: Sequence[str], fields: Sequence[str], out: str) -> DataFrame:
    """parents with the array of their children, in order; an empty array where there are none.

    The array is as long as a parent's children, who form one record; tables
    with unbounded children stay normalised.
    """
    grouped = children.groupBy(*on).agg(F.array_sort(F.collect_list(F.struct(*order, *[f for f in fields if f not in order]))).alias("__c"))
    listed = grouped.withColumn(out, F.transform("__c", lambda x: F.struct(*[x[f].alias(f) for f in fields]))).drop("__c")
    empty = F.filter(out, lambda x: F.lit(False))
    joined = parents.join(listed, list(on), "left")
    return joined.withColumn(out, F.coalesce(F.col(out), F.coalesce(empty, F.from_json(F.lit("[]"), joined.schema[out].dataType.simpleString()))))


def with_limit(df: DataFrame, overrides: DataFrame, key: str, default: int, out: str = "row_limit") -> DataFrame:
    """df with the limit configured for its key, or the default."""
    return df.join(sized(overrides.select(key, F.col("row_limit").alias(out))), key, "left").withColumn(out, F.coalesce(out, F.lit(default)))


def in_batches(rank: Column, size: int) -> Column:
    """The number of the fixed-size batch that a rank (from 1) falls into, from 0."""
    return F.floor((rank - 1) / size).cast("bigint")


def preview(df: DataFrame, order: Sequence, n: int = 10) -> DataFrame:
    """The first n rows in a total order, and how many more there are."""
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return df.orderBy(*order).limit(n).withColumn("n_more", F.greatest(total - n, F.lit(0)).cast("bigint"))


def still_needed(have: Column, target: Column, share: float = 0.9) -> Column:
    """How many rows are missing to the share of the target: rounded up, never negative."""
    return F.greatest(F.lit(0), F.ceil(F.round(F.lit(share) * target - have, 6))).cast("bigint")


def retry_limit(need: Column, attempt: Column, base: int = 100, step: float = 0.5, cap: int = 500) -> Column:
    """How many rows to look at in the next attempt."""
    return F.least(F.lit(cap), F.floor(F.greatest(need * 2, F.lit(base)) * (1 + F.lit(step) * attempt))).cast("bigint")


def backoff(attempt: Column, delay: float = 1.0, factor: float = 2.0, cap: float = 60.0) -> Column:
    return F.least(F.lit(cap), F.lit(delay) * F.pow(F.lit(factor), attempt))


def next_batch(failures: Column, full: int = 10) -> Column:
    return F.greatest(F.lit(1), F.lit(full) - failures)
