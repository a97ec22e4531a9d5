"""How old the newest record of a source is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WARN_AFTER_DAYS = 8
ERROR_AFTER_DAYS = 30


def freshness(
    df: DataFrame,
    col: str,
    now: Column,
    warn_days: int = WARN_AFTER_DAYS,
    error_days: int = ERROR_AFTER_DAYS,
) -> DataFrame:
    """One row: the newest value, its age in whole days, and pass / warn / error.
    An empty source is an error."""
    age = F.timestamp_diff("SECOND", F.col("newest"), now)
    status = (
        F.when(F.col("newest").isNull() | (age > error_days * 86400), "error")
        .when(age > warn_days * 86400, "warn")
        .otherwise("pass")
    )
    newest = df.agg(F.max(col).alias("newest"))
    return newest.select("newest", F.floor(age / 86400).alias("age_days"), status.alias("status"))
