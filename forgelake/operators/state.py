"""State kept between runs, as tables: circuit breaking, expiry, keyed upserts, refinement rounds."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.operators.ordered import latest_rows
from forgelake.session import written


def breaker_step(state: tuple[int, float, int, int], t: float, ok: bool, failures: int, seconds: float) -> tuple[tuple[int, float, int, int], bool]:
    """(failures in a row, blocked until, skipped, trips) after an attempt, and whether it was let through.

    Attempts while blocked are skipped and change nothing else; the first
    attempt at or after the end of the block starts at zero; a success resets.
    """
    n, until, skipped, trips = state
    if until:
        if t < until:
            return (n, until, skipped + 1, trips), False
        n, until = 0, 0.0
    if ok:
        return (0, 0.0, skipped, trips), True
    n += 1
    if n >= failures:
        return (n, t + seconds, skipped, trips + 1), True
    return (n, 0.0, skipped, trips), True


def circuit_breaker(attempts: DataFrame, key: str, t: str, ok: str, tie: str, failures: int = 10, seconds: float = 300.0) -> DataFrame:
    """key, n_attempts, n_skipped, n_trips, n_failures (in a row at the end), blocked_until (epoch seconds, or null).

    The state after an attempt depends on all before it, so a key's attempts
    are read in order; rows are sorted by the shuffle and folded as they
    stream by, in constant memory: no group is ever collected.
    """
    rows = attempts.select(F.col(key).cast("string").alias("k"), F.unix_micros(F.col(t).cast("timestamp")).alias("t"), F.coalesce(F.col(ok), F.lit(False)).alias("ok"), F.col(tie).alias("tie")).where("k is not null and t is not null")
    ordered = rows.repartition("k").sortWithinPartitions("k", "t", "tie")

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state, n = None, (0, 0.0, 0, 0), 0
        row = lambda: (current, n, state[2], state[3], state[0], state[1] or None)
        names = ["k", "n_attempts", "n_skipped", "n_trips", "n_failures", "blocked_until"]
        for batch in batches:
            out = []
            for k, at, good in zip(batch["k"], batch["t"], batch["ok"]):
                if k != current:
                    if current is not None:
                        out.append(row())
                    current, state, n = k, (0, 0.0, 0, 0), 0
                n += 1
                state, _ = breaker_step(state, at / 1e6, bool(good), failures, seconds)
            if out:
                yield pd.DataFrame(out, columns=names)
        if current is not None:
            yield pd.DataFrame([row()], columns=names)

    made = ordered.mapInPandas(fold, "k string, n_attempts bigint, n_skipped bigint, n_trips bigint, n_failures bigint, blocked_until double")
    return made.withColumnRenamed("k", key)


def alive(written_at: Column, now: Column, ttl_seconds: int) -> Column:
    """Whether an entry hasn't expired: its age in seconds is below its life."""
    return (F.unix_timestamp(now.cast("timestamp")) - F.unix_timestamp(written_at.cast("timestamp"))) < ttl_seconds


def ttl_map(entries: Column, now_epoch: Column, ttl_seconds: int) -> Column:
    """A map of key to epoch seconds without its expired entries."""
    return F.map_filter(entries, lambda k, t: (now_epoch - t) < ttl_seconds)


def is_fresh(ok: Column, written_at: Column, now: Column, days: int) -> Column:
    """A success whose readable time is at most `days` old."""
    at = written_at.try_cast("timestamp")
    return F.coalesce(ok & (at >= now.cast("timestamp") - F.make_dt_interval(F.lit(days))), F.lit(False))


def keyed_upsert(old: DataFrame, new: DataFrame, key: Sequence[str], order: Sequence[str], deletes: DataFrame | None = None) -> DataFrame:
    """The table after writing new rows over old ones, the latest per key, and dropping the keys of deletes."""
    table = latest_rows(old.unionByName(new), key, order, old.columns).select(*old.columns)
    return table if deletes is None else table.join(deletes.select(*key), list(key), "left_anti")


def refine(start: DataFrame, satisfied: Callable[[DataFrame], bool], step: Callable[[DataFrame, int], DataFrame], rounds: int = 5, patience: int = 2) -> DataFrame:
    """At most `rounds` of steps until satisfied, or until no step from round `patience` on adds a row.

    Each round is written to the shared folder, so the plan doesn't grow and a
    lost executor doesn't repeat earlier rounds. The result comes back either way.
    """
    now = written(start, "refine")
    n = now.count()
    for attempt in range(rounds):
        if satisfied(now):
            break
        now = written(step(now, attempt), "refine")
        m = now.count()
        if m == n and attempt + 1 >= patience:
            break
        n = m
    return now
