"""Aggregates over records: summaries, rates and cache statistics, guarded against empty input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def share(part: Column, whole: Column, scale: float = 1.0) -> Column:
    """part / whole * scale, 0 where whole is 0 or null."""
    return F.when(F.coalesce(whole, F.lit(0)) == 0, F.lit(0.0)).otherwise(part / whole * scale)


def mean_or_zero(value: Column) -> Column:
    return F.coalesce(F.avg(value), F.lit(0.0))


def coverage(done: Column, expected: Column) -> Column:
    """Percent of the expected that is done; nothing expected counts as one."""
    return done * 100.0 / F.greatest(expected, F.lit(1))


def summary(df: DataFrame, by: Sequence[str], key: str, value: str) -> DataFrame:
    """by..., n, total, average, top: count, sum, mean and the key with the highest value (the smallest key of equals)."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.avg(value).alias("average"), F.max_by(key, F.struct(F.col(value), -F.xxhash64(key))).alias("top"))


def megabytes(size: Column) -> Column:
    return size / 1_048_576


def density(df: DataFrame, page: str, key: str, valid: Column, sample: int = 10, warn: int = 5, good: int = 20) -> DataFrame:
    """One row: pages, rows per page, invalid and repeated rows of a sample, and the verdict of a listing.

    The sample is the first `sample` rows by key and page: a check of form, not
    a replacement for the counts, which cover all rows.
    """
    all_rows = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(page).alias("n_pages"))
    first = df.withColumn("__ok", valid).orderBy(key, page).limit(sample)
    seen = first.agg(F.count_if(~F.coalesce("__ok", F.lit(False))).alias("n_invalid"), (F.count(F.lit(1)) - F.count_distinct(key)).alias("n_repeated"))
    one = all_rows.withColumn("per_page", F.col("n_rows") / F.greatest("n_pages", F.lit(1)))
    one = one.withColumns({"n_invalid": seen.select("n_invalid").scalar(), "n_repeated": seen.select("n_repeated").scalar()})
    return one.withColumn("verdict", F.when((F.col("per_page") >= good) & (F.col("n_invalid") == 0), "good").when(F.col("per_page") < warn, "sparse").otherwise("fair"))
