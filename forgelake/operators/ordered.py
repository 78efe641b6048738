"""Order within keys without one task per key: two levels, by an order-preserving bucket.

Every function takes `bucket`, a column that never falls where the order rises
(a day, a range of positions). Rows meet only within (key, bucket); what
crosses buckets is carried by one row per key and bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _within(key: Sequence[str], bucket: str, order: Sequence[str]):
    return Window.partitionBy(*key, bucket).orderBy(*[F.col(c).asc_nulls_first() for c in order])


def running_sums(df: DataFrame, key: Sequence[str], bucket: str, order: Sequence[str], value: str, out: str) -> DataFrame:
    """Adds out: the sum of value over the rows of the same key before each row. Null keys are a key."""
    sums = df.groupBy(*key, bucket).agg(F.sum(value).alias("__sum"))
    w = Window.partitionBy(*key).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(key)], F.col(bucket).alias("__b"), F.coalesce(F.sum("__sum").over(w), F.lit(0)).alias("__before"))
    on = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(key)] + [F.col(bucket).eqNullSafe(F.col("__b"))]
    inside = F.coalesce(F.sum(value).over(_within(key, bucket, order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return df.join(before, on).withColumn(out, F.col("__before") + inside).drop("__b", "__before", *[f"__k{i}" for i in range(len(key))])


def row_numbers(df: DataFrame, key: Sequence[str], bucket: str, order: Sequence[str], out: str) -> DataFrame:
    """Adds out: 1, 2, ... within each key."""
    return running_sums(df.withColumn("__one", F.lit(1).cast("bigint")), key, bucket, order, "__one", out).withColumn(out, F.col(out) + 1).drop("__one")


def next_values(df: DataFrame, key: Sequence[str], bucket: str, order: Sequence[str], value: str, out: str) -> DataFrame:
    """Adds out: value of the next row of the same key, null at the last."""
    first = df.groupBy(*key, bucket).agg(F.min_by(F.struct(value), F.struct(*order)).alias("__first"))
    w = Window.partitionBy(*key).orderBy(bucket)
    after = first.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(key)], F.col(bucket).alias("__b"), F.lead("__first").over(w).alias("__next"))
    on = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(key)] + [F.col(bucket).eqNullSafe(F.col("__b"))]
    inside = F.lead(F.struct(value)).over(_within(key, bucket, order))
    return df.withColumn("__in", inside).join(after, on).withColumn(out, F.coalesce("__in", "__next")[value]).drop("__in", "__next", "__b", *[f"__k{i}" for i in range(len(key))])


def run_lengths(df: DataFrame, key: Sequence[str], bucket: str, order: Sequence[str], counts: str, out: str) -> DataFrame:
    """Adds out: how many rows in a row, up to this one, have the boolean `counts` true; a row without it resets to 0."""
    df = df.withColumns({"__hit": F.coalesce(F.col(counts), F.lit(False)).cast("int"), "__reset": (~F.coalesce(F.col(counts), F.lit(False))).cast("bigint")})
    w = _within(key, bucket, order)
    df = df.withColumn("__island", F.sum("__reset").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    df = df.withColumn("__run", F.sum("__hit").over(Window.partitionBy(*key, bucket, "__island").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    ends = df.groupBy(*key, bucket).agg(F.max("__island").alias("__islands"), F.max_by("__run", F.struct("__island", "__run")).alias("__tail"))
    wk = Window.partitionBy(*key).orderBy(bucket)
    ends = ends.withColumn("__part", F.sum((F.col("__islands") > 0).cast("int")).over(wk))
    # What a bucket passes on: the tail behind its last reset, or all it got and had if nothing reset it.
    ends = ends.withColumn("__upto", F.sum("__tail").over(Window.partitionBy(*key, "__part").orderBy(bucket)))
    carried = ends.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(key)], F.col(bucket).alias("__b"), F.coalesce(F.lag("__upto").over(wk), F.lit(0)).alias("__carry"))
    on = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(key)] + [F.col(bucket).eqNullSafe(F.col("__b"))]
    made = df.join(carried, on).withColumn(out, F.col("__run") + F.when(F.col("__island") == 0, F.col("__carry")).otherwise(0))
    return made.drop("__hit", "__reset", "__island", "__run", "__carry", "__b", *[f"__k{i}" for i in range(len(key))])


def first_rows(df: DataFrame, key: Sequence[str], order: Sequence, keep: Sequence[str] | None = None) -> DataFrame:
    """One row per key, the first in order: an aggregate, so hot keys are combined before they are sent."""
    rest = [c for c in (keep or df.columns) if c not in key]
    best = df.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__best"))
    return best.select(*key, *[F.col(f"__best.{c}").alias(c) for c in rest])


def latest_rows(df: DataFrame, key: Sequence[str], order: Sequence, keep: Sequence[str] | None = None) -> DataFrame:
    """One row per key, the last in order."""
    rest = [c for c in (keep or df.columns) if c not in key]
    best = df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__best"))
    return best.select(*key, *[F.col(f"__best.{c}").alias(c) for c in rest])


def top_rows(df: DataFrame, key: Sequence[str], n, order: Sequence, groups: int = 32, out: str = "rank") -> DataFrame:
    """The first n rows of each key (n: a number or an int column that is equal within a key), ranked in out.

    Rows are ranked within hashed groups of a key first, so that at most
    groups * n of them meet in the second ranking.
    """
    limit = F.lit(n) if isinstance(n, int) else n
    df = df.withColumn("__group", F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(groups)))
    cut = df.withColumn("__r", F.row_number().over(Window.partitionBy(*key, "__group").orderBy(*order))).where(F.col("__r") <= limit)
    return cut.withColumn(out, F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col(out) <= limit).drop("__group", "__r")
