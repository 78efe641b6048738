"""Per-key results without an overloaded reducer: multi-level tree aggregation.

Level 0 combines chunks of a fixed number of input rows (Spark's map-side
aggregation does so before anything is sent) into one state per key and chunk.
A key with few states is merged in one round. The states of a key with more
than fan_in of them pass through ceil(log_fan_in(chunks)) rounds: chunks are
numbered by their place in the input, and each round merges the states of
fan_in neighbouring numbers. However many rows a key has, and however many
chunks there are, no merge reads more than fan_in states.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.operators.lookup import sized
from forgelake.session import written

#: State kinds whose merge is associative, and how states merge.
MERGES = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max, "any": F.bool_or, "all": F.bool_and, "hll": F.hll_union_agg}


def _start(kind: str, value: Column) -> Column:
    if kind == "count":
        return F.count(value)
    return {"sum": F.sum, "min": F.min, "max": F.max, "any": F.bool_or, "all": F.bool_and, "hll": F.hll_sketch_agg}[kind](value)


def rounds_of(chunks: int, fan_in: int) -> int:
    """How often numbers below `chunks` must be divided by fan_in until one is left."""
    rounds = 0
    while chunks > 1:
        chunks, rounds = -(-chunks // fan_in), rounds + 1
    return rounds


def tree_aggregate(df: DataFrame, keys: Sequence[str], states: Mapping[str, tuple[str, Column]], fan_in: int = 16, chunk_rows: int = 1 << 16, widest: str | None = None) -> DataFrame:
    """One row per key: the keys and the merged states.

    states: output name to (kind, value), kind one of MERGES; hll states stay
    sketches (hll_sketch_estimate reads them). Null is a key of its own; an
    empty input gives no rows; counts skip null values as SQL does, and sums
    of only nulls are null. widest: name of a column with the most states that
    any merge of the key read. chunk_rows is a power of 2.

    Level 0 is written to the shared folder: it is as small as the number of
    states, the number of rounds follows from it, and no round is repeated
    when an executor is lost. The keys with more than fan_in states are told
    from the others by a join with their list, which holds at most one key for
    every fan_in states.
    """
    if fan_in < 2 or chunk_rows < 1 or chunk_rows & (chunk_rows - 1):
        raise ValueError("fan_in must be at least 2, chunk_rows a power of 2")
    names = list(states)
    values = {f"__v{i}": states[n][1] for i, n in enumerate(names)}
    place = F.monotonically_increasing_id()  # the partition from bit 33 on, the row below
    parts = {"__p": F.shiftright(place, 33), "__c": F.shiftright(place.bitwiseAND(F.lit((1 << 33) - 1)), chunk_rows.bit_length() - 1)}
    held = [f"__k{i}" for i in range(len(keys))]
    at = df.select(*[F.col(k).alias(h) for k, h in zip(keys, held)], *[v.alias(n) for n, v in values.items()], *[c.alias(n) for n, c in parts.items()])
    start = [_start(states[n][0], F.col(v)).alias(f"__s{i}") for i, (n, v) in enumerate(zip(names, values))]
    leaves = written(at.groupBy(*held, *parts).agg(*start), "tree")
    counted = leaves.groupBy(*held).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > fan_in).drop("__n")
    last_p, last_c = leaves.agg(F.max("__p"), F.max("__c")).first()
    merge = [MERGES[states[n][0]](f"__s{i}").alias(f"__s{i}") for i, n in enumerate(names)] + [F.greatest(F.count(F.lit(1)), F.max("__w")).alias("__w")]
    at = leaves.withColumns({"__at": F.col("__p") * ((last_c or 0) + 1) + F.col("__c"), "__w": F.lit(1).cast("bigint")}).drop(*parts)
    rounds = rounds_of(((last_p or 0) + 1) * ((last_c or 0) + 1), fan_in)
    if rounds > 1:
        wide = sized(counted.withColumn("__wide", F.lit(True)))
        same = [F.col(f"l.{h}").eqNullSafe(F.col(f"r.{h}")) for h in held]
        marked = at.alias("l").join(wide.alias("r"), reduce(and_, same), "left").select("l.*", "__wide") if held else at.withColumn("__wide", F.lit(True))
        cold, at = marked.where("__wide is null").drop("__wide"), marked.where("__wide").drop("__wide")
        for _ in range(rounds - 1):
            at = at.withColumn("__at", F.floor(F.col("__at") / fan_in).cast("bigint")).groupBy(*held, "__at").agg(*merge)
        at = at.unionByName(cold)
    at = at.groupBy(*held).agg(*merge)
    return at.select(*[F.col(h).alias(k) for h, k in zip(held, keys)], *[F.col(f"__s{i}").alias(n) for i, n in enumerate(names)], *([F.col("__w").alias(widest)] if widest else []))


def heavy_keys(counts: DataFrame, keys: Sequence[str], count: str, share: float) -> DataFrame:
    """The rows of counts (one per key) whose count is at least `share` of the sum of all.

    The total is a scalar of the counts, which are one row per key.
    """
    total = counts.agg(F.sum(count).alias("total")).scalar()
    return counts.where(F.col(count) >= F.lit(share) * total)
