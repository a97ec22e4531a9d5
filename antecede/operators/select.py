"""Bounded reads: date window with top-k, page of a list, point lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_window(
    df: DataFrame,
    on: str,
    since,
    until,
    limit: int | None = None,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Rows with ``since <= on <= until``, newest first, optionally the first
    ``limit``: a ``TakeOrderedAndProject``, no full sort."""
    rows = df.filter(F.col(on).between(F.lit(since), F.lit(until)))
    ordered = rows.orderBy(F.col(on).desc(), *tie_break)
    return ordered.limit(limit) if limit else ordered


def page_of(df: DataFrame, order: Sequence[str | Column], page: int, size: int = 25) -> DataFrame:
    """Page ``page`` (from 1) of a list. The order must be total, or pages are
    not stable."""
    return df.orderBy(*order).offset(size * (page - 1)).limit(size)


def point_lookup(df: DataFrame, key: str, value) -> DataFrame:
    """The row(s) with this key; the equality reaches the parquet scan."""
    return df.filter(F.col(key) == F.lit(value))
