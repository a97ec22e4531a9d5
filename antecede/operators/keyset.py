"""Set differences on keys: what is still to do, what is new."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def landed_subset(landed: DataFrame, key: str) -> DataFrame:
    """Distinct non-null keys already landed; reads that one column only."""
    return landed.select(key).filter(F.col(key).isNotNull()).distinct()


def todo(df: DataFrame, landed: DataFrame, key: str) -> DataFrame:
    """Rows whose key has not landed yet, so an interrupted run can resume."""
    return df.join(landed_subset(landed, key), key, "left_anti")


def high_watermark(target: DataFrame, col: str) -> DataFrame:
    """One row: the newest value stored, NULL for an empty target."""
    return target.agg(F.max(col).alias("high_watermark"))


def since_watermark(df: DataFrame, target: DataFrame, col: str) -> DataFrame:
    """Rows strictly newer than the newest one stored; all rows when the target
    is empty. The watermark is a scalar subquery: computed once, then a plain
    filter on the scan."""
    mark = high_watermark(target, col).scalar()
    return df.filter(mark.isNull() | (F.col(col) > mark))
