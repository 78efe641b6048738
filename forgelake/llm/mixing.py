"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Every source is a stream of its texts in shuffled order, gone through again as
often as its cap allows. Slots of one size in tokens are handed to the sources
by golden-ratio points laid through the cumulative weights, so that every
stretch of the mixture, not only the whole, has the target shares. The j-th
slot of a source holds tokens j * block to (j + 1) * block of its stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake.operators.lookup import held
from forgelake.operators.ordered import running_sums

#: Fractional part of the golden ratio.
GOLDEN = 0.6180339887498949

#: Parts of the unit interval in which a source is looked up.
CELLS = 4096

#: Rows of one source that a single task orders, about.
BUCKET_ROWS = 50_000


def plan(sizes: DataFrame, targets: DataFrame, total_tokens: int | None = None, max_sources: int = 100_000) -> DataFrame:
    """source, target_share, max_repeats, available, planned: how many tokens each source is to give.

    sizes: source, available. targets: source, target_share, max_repeats
    (repeated rows count once; null or negative shares count as 0). The total
    is total_tokens, or else the tokens of all listed sources. Sources whose
    cap (available * max_repeats) is below their share give all they may, and
    the others share the rest in proportion to their targets, as far as their
    own caps allow. One row per target source, at most max_sources, is held on
    the driver.
    """
    spark = sizes.sparkSession
    one = targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    rows = one.join(sizes, "source", "left").limit(max_sources + 1).collect()
    if len(rows) > max_sources:
        raise ValueError(f"more than {max_sources} sources in the targets")
    rows = [(r["source"], max(0.0, r["target_share"] or 0.0), max(0, r["max_repeats"] or 0), r["available"] or 0) for r in sorted(rows)]
    total = sum(r[3] for r in rows) if total_tokens is None else total_tokens
    caps = {r[0]: r[2] * r[3] for r in rows}
    planned: dict[str, float] = {r[0]: 0.0 for r in rows}
    free = {r[0]: r[1] for r in rows if r[1] > 0 and caps[r[0]] > 0}
    left = float(total)
    while free and left > 0:
        weight = sum(free.values())
        full = [s for s, w in free.items() if left * w / weight >= caps[s]]
        if not full:
            planned |= {s: left * w / weight for s, w in free.items()}
            break
        for s in full:
            planned[s] = float(caps[s])
            del free[s]
        left = total - sum(planned.values())
    return spark.createDataFrame([(*r, int(planned[r[0]])) for r in rows], "source string, target_share double, max_repeats int, available bigint, planned bigint")


def mixture(docs: DataFrame, planned: DataFrame, key: str, source: str, tokens: str, block: int = 512, seed: str = "mix") -> DataFrame:
    """slot, source, key, repeat, from_token, to_token: which tokens of which text stand in each slot of the mixture.

    docs: key, source, tokens (bigint; null and 0 give nothing), one row per
    text; texts of unlisted and null sources and repeated keys are no trouble:
    the first are left out, the second are texts of their own. planned: as of
    plan. A slot has `block` tokens of one source; a text may begin in one slot
    and end in another. No text is used more than max_repeats times: slots
    past a source's cap stay empty. The key must not be called like another
    column of the result.
    """
    if key in ("slot", "source", "rank", "repeat", "from_token", "to_token"):
        raise ValueError(f"{key} is a name of the result")
    rows = planned.where("planned > 0").orderBy("source").collect()
    total = sum(r["planned"] for r in rows)
    slots = total // block
    spark = docs.sparkSession
    if not slots:
        return docs.limit(0).select(F.lit(0).cast("bigint").alias("slot"), F.col(source).alias("source"), key, F.lit(0).alias("repeat"), F.lit(0).cast("bigint").alias("from_token"), F.lit(0).cast("bigint").alias("to_token"))
    # The schedule: sources in turn, by points of the golden ratio in the cumulative weights.
    ranges, low = [], 0.0
    for r in rows:
        ranges.append((r["source"], low, low + r["planned"] / total))
        low = ranges[-1][2]
    ranges[-1] = (*ranges[-1][:2], 1.1)
    point = F.expr(f"(id + 0.5D) * {GOLDEN}D - floor((id + 0.5D) * {GOLDEN}D)")
    # The point is found in its cell first, so that the join is one of equal cells, not of all pairs.
    steps = held(spark.createDataFrame(ranges, "source string, low double, high double")).withColumn("__cell", F.explode(F.expr(f"sequence(cast(floor(low * {CELLS}) as int), cast(least({CELLS} - 1, floor(high * {CELLS})) as int))")))
    buckets = max(1, slots // BUCKET_ROWS + 1)
    schedule = spark.range(slots).withColumn("__at", point).withColumn("__cell", F.expr(f"cast(floor(__at * {CELLS}) as int)"))
    schedule = schedule.join(F.broadcast(steps), "__cell").where("__at >= low and __at < high")
    schedule = schedule.select("source", F.col("id").alias("slot"), F.lit(1).cast("bigint").alias("__one"), F.least(F.lit(buckets - 1), (F.col("id") / (slots / buckets)).cast("int")).alias("__bucket"))
    schedule = running_sums(schedule, ["source"], "__bucket", ["slot"], "__one", "rank").select("source", "rank", "slot")
    # The streams: texts in shuffled order, where each begins, and the blocks it reaches in each round.
    caps = held(spark.createDataFrame([(r["source"], r["available"], min(r["max_repeats"] * r["available"], (int(r["planned"] * 1.05) // block + 8) * block)) for r in rows], "source string, available bigint, upto bigint"))
    texts = docs.select(F.col(source).alias("source"), F.col(key).alias("__doc"), F.col(tokens).cast("bigint").alias("__n")).where("__n > 0").withColumn("__shuffled", F.xxhash64(F.lit(seed), "__doc"))
    n = max(1, max(r["available"] for r in rows) // (BUCKET_ROWS * 200) + 1)
    texts = texts.join(caps, "source").withColumn("__bucket", F.pmod("__shuffled", F.lit(n)).cast("int"))
    texts = running_sums(texts, ["source"], "__bucket", ["__shuffled", "__doc", "__n"], "__n", "__start")
    rounds = texts.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr("(upto - 1) div available"))).alias("repeat"))
    rounds = rounds.withColumn("__from", F.expr("repeat * available + __start")).withColumn("__to", F.expr("least(__from + __n, upto)")).where("__from < __to")
    pieces = rounds.select("source", "__doc", "repeat", "__from", "__to", F.explode(F.sequence(F.expr(f"__from div {block}"), F.expr(f"(__to - 1) div {block}"))).alias("rank"))
    cut = pieces.select("source", "rank", F.col("__doc").alias(key), F.col("repeat").cast("int").alias("repeat"), F.expr(f"greatest(0, rank * {block} - __from)").alias("from_token"), F.expr(f"least(__to, (rank + 1) * {block}) - __from").alias("to_token"))
    return cut.join(schedule, ["source", "rank"]).select("slot", "source", key, "repeat", "from_token", "to_token")


def report(mixed: DataFrame, planned: DataFrame) -> DataFrame:
    """source, target_share, max_repeats, available, planned, mixed, actual_share, repeats: the shares reached."""
    got = mixed.groupBy("source").agg(F.sum(F.expr("to_token - from_token")).alias("mixed"))
    total = got.agg(F.sum("mixed").alias("__total"))
    rows = planned.join(got, "source", "left").withColumn("mixed", F.coalesce("mixed", F.lit(0).cast("bigint"))).withColumn("__total", total.scalar())
    return rows.select("source", "target_share", "max_repeats", "available", "planned", "mixed", F.expr("mixed / __total").alias("actual_share"), F.expr("case when available > 0 then mixed / available end").alias("repeats"))
