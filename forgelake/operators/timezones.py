"""Mixed written times to UTC instants; zones of clocks that wrote none are estimated.

A clock's zone is chosen among candidate zones, each with its whole offset
history (daylight saving included): local times are converted by every
candidate and compared with times known for the same row, the ingestion time
(nothing is ingested before it happened) and the order of the row's own times
(an update is not earlier than the creation). The history with the fewest
violations wins; a declared zone keeps a source unless it is clearly worse.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake.functions.timeparse import first_shown, opaque, shown_once, with_read_time
from forgelake.operators.lookup import held, sized

#: A declared zone is given up only above this share of violations, and if another has less than half of them.
DECLARED_TRUST = 0.05


def estimate_zones(observed: DataFrame, declared: DataFrame, extra_zones: Sequence[str] = ()) -> DataFrame:
    """source, zone, basis, n, violations, declared_zone, declared_violations for each source.

    observed: source, local_us, not_before_us, not_after_us (either bound may
    be null). declared: source, zone_name. Candidates are the declared zones
    and extra_zones. One pass over the observations: each counts into its
    source's row once for every candidate, combined before the shuffle; the
    number of candidates is small and fixed, so states don't grow with data.
    basis is `declared` or `estimated`. A null source and a source without
    observations have no row. Ties go to the declared zone, then to the
    tightest one (least time to the upper bound), then to the name.
    """
    names = sorted({r[0] for r in declared.select("zone_name").where("zone_name is not null").distinct().limit(601).collect()} | set(extra_zones))
    if len(names) > 600:
        raise ValueError("more declared zones than there are zones")
    aggs = [F.count("local_us").alias("n")]
    for i, z in enumerate(names):
        u = F.unix_micros(F.to_utc_timestamp(F.timestamp_micros("local_us"), F.lit(z)))
        bad = (u > F.col("not_after_us")) | (u < F.col("not_before_us"))
        aggs += [F.count_if(F.coalesce(bad, F.lit(False))).alias(f"v{i}"), F.sum((F.col("not_after_us") - u) / 1e6).alias(f"l{i}")]
    counted = observed.where("source is not null").groupBy("source").agg(*aggs).where("n > 0")
    rows = counted.select("source", "n", F.explode(F.array(*[F.struct(F.lit(z).alias("zone"), F.col(f"v{i}").alias("violations"), F.col(f"l{i}").alias("lag")) for i, z in enumerate(names)])).alias("c")) if names else counted.select("source", "n", F.lit(None).cast("struct<zone string, violations bigint, lag double>").alias("c")).limit(0)
    one = declared.where("source is not null and zone_name is not null").groupBy("source").agg(F.min("zone_name").alias("declared_zone"))
    rows = rows.join(one, "source", "left").select("source", "n", "c.*", "declared_zone")
    best = rows.groupBy("source").agg(
        F.first("n").alias("n"), F.first("declared_zone").alias("declared_zone"),
        F.min_by(F.struct("zone", "violations"), F.struct("violations", F.coalesce(F.col("zone") != F.col("declared_zone"), F.lit(True)), F.when(F.col("lag").isNull(), 0).otherwise(F.abs("lag")), "zone")).alias("best"),
        F.max(F.when(F.col("zone") == F.col("declared_zone"), F.col("violations"))).alias("declared_violations"),
    )
    keep = F.col("declared_zone").isNotNull() & ~((F.col("declared_violations") > DECLARED_TRUST * F.col("n")) & (F.col("best.violations") * 2 < F.col("declared_violations")))
    return best.select(
        "source", F.when(keep, F.col("declared_zone")).otherwise(F.col("best.zone")).alias("zone"), F.when(keep, "declared").otherwise("estimated").alias("basis"),
        "n", F.when(keep, F.col("declared_violations")).otherwise(F.col("best.violations")).alias("violations"), "declared_zone", "declared_violations",
    )


def known_us(t: str):
    """UTC microseconds of a read time that carries its zone itself."""
    return F.when(F.col(f"{t}.kind") == "epoch", F.col(f"{t}.local_us")).when(F.col(f"{t}.kind") == "zoned", F.col(f"{t}.local_us") - F.col(f"{t}.offset_s") * F.lit(1_000_000).cast("bigint"))


def resolved_zones(observed: DataFrame, declared: DataFrame, extra_zones: Sequence[str] = ()) -> DataFrame:
    """estimate_zones, and the declared zone of sources that showed no local time; its rows are held once."""
    found = held(estimate_zones(observed, declared, extra_zones))
    return found


def to_instants(df: DataFrame, value: str, source: str, zones: DataFrame) -> DataFrame:
    """Adds utc_us and status to df for the text column `value`, read with the clock of `source`.

    status: `exact` (zone or epoch written), `declared` or `estimated` (zone
    of the source, from zones: source, zone, basis), `ambiguous` (shown twice
    or never by that clock), `no_zone` (nothing known of the source) or
    `unreadable` (null, blank, relative, impossible). utc_us is null for the
    last three. Rows are kept as they are, repeated ones too. Columns of df that
    are called utc_us or status are replaced; all others are left alone, as
    only names starting with `__` are used within.
    """
    z = zones.select(F.col("source").alias("__zs"), F.col("zone").alias("__zone"), F.col("basis").alias("__basis"))
    df = with_read_time(df, value, "__t").join(z, F.col(source) == F.col("__zs"), "left")
    kind = F.col("__t.kind")
    df = df.withColumn("__first", first_shown(F.col("__t.local_us"), F.col("__zone")))
    df = df.withColumn("__u", F.when(kind == "local", shown_once(F.col("__t.local_us"), F.col("__zone"), F.col("__first"))).otherwise(known_us("__t")))
    status = F.when(kind == "none", "unreadable").when(kind != "local", "exact").when(F.col("__zone").isNull(), "no_zone").when(F.col("__u").isNull(), "ambiguous").otherwise(F.col("__basis"))
    df = df.withColumn("__r", opaque(F.struct(F.col("__u").alias("utc_us"), status.alias("status"))))
    return df.withColumns({"utc_us": F.col("__r.utc_us"), "status": F.col("__r.status")}).drop("__r", "__t", "__first", "__u", "__zs", "__zone", "__basis")


def with_undeclared(zones: DataFrame, declared: DataFrame) -> DataFrame:
    """zones, and the declared rows of sources it lacks (no local time was seen of them)."""
    one = declared.where("source is not null and zone_name is not null").groupBy("source").agg(F.min("zone_name").alias("zone")).withColumn("basis", F.lit("declared"))
    return sized(zones.select("source", "zone", "basis").unionByName(one.join(zones, "source", "left_anti")))
