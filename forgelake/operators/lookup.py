"""Joins with a side that should be small, whose size is checked before it is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows up to which a lookup side may be broadcast.
BROADCAST_ROWS = 100_000


def sized(small: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """`small` with a broadcast hint if it is proven to have at most max_rows rows.

    The proof is a count of at most max_rows + 1 rows. A larger side comes
    back unchanged, so that the join shuffles both sides.
    """
    return F.broadcast(small) if small.limit(max_rows + 1).count() <= max_rows else small


def held(small: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Like sized, for a side that is costly to compute: its rows are fetched once.

    At most max_rows + 1 rows reach the driver; a larger side comes back
    unchanged and is joined by a shuffle.
    """
    rows = small.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return small
    return F.broadcast(small.sparkSession.createDataFrame(rows, small.schema))
