"""When a side of a join may be broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows that may be broadcast. Rows here are keys with a few values: tens of
# megabytes at most.
MAX_BROADCAST_ROWS = 500_000


def broadcast_if(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if it has few enough rows; else left to a
    shuffled join. ``rows`` is its size or a proven bound of it."""
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS else df
