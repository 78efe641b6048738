"""The circuit breaker as a stateful stream: the same fold as the batch operator, state kept by Spark."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from forgelake.operators.state import breaker_step


def breaker_stream(attempts: DataFrame, key: str, t: str, ok: str, failures: int = 10, seconds: float = 300.0, ttl_ms: int | None = None) -> DataFrame:
    """key, t, allowed for each attempt. Attempts of a batch are taken in order of time; with ttl_ms, a
    key without attempts for that long is forgotten; such a query must run by
    time, since one that takes in all there is would wait for the timeouts.

    Only the attempts of one key in one micro-batch are in memory at once;
    the number of files per batch bounds them.
    """
    def fold(k: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        now = tuple(state.get) if state.exists else (0, 0.0, 0, 0)
        rows = pd.concat(list(chunks)).sort_values("t", kind="stable")
        allowed = []
        for at, good in zip(rows["t"], rows["ok"]):
            now, let = breaker_step(now, at.timestamp(), bool(good), failures, seconds)
            allowed.append(let)
        state.update(now)
        if ttl_ms is not None:
            state.setTimeoutDuration(ttl_ms)
        yield pd.DataFrame({"k": k[0], "t": rows["t"].values, "allowed": allowed})

    rows = attempts.select(F.col(key).cast("string").alias("k"), F.col(t).cast("timestamp").alias("t"), F.coalesce(F.col(ok), F.lit(False)).alias("ok"))
    made = rows.groupBy("k").applyInPandasWithState(fold, "k string, t timestamp, allowed boolean", "n bigint, until double, skipped bigint, trips bigint", "append", GroupStateTimeout.NoTimeout if ttl_ms is None else GroupStateTimeout.ProcessingTimeTimeout)
    return made.withColumnRenamed("k", key)
