"""Arithmetic shared by the pipeline. Ratios are double and NULL-safe."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from antecede.functions.text import parse_mmss_seconds

ROUND_SECONDS = 300
DAYS_PER_YEAR = 365.25


def safe_ratio(x: Column, y: Column) -> Column:
    """``x / y`` as double; NULL when ``y`` is zero or either side is NULL."""
    return F.try_divide(x.cast("double"), y.cast("double"))


def age_years(on: Column, born: Column) -> Column:
    """Years between two dates."""
    return F.date_diff(on, born).cast("double") / F.lit(DAYS_PER_YEAR)


def bout_seconds(finish_round: Column, finish_seconds: Column, round_seconds: int = ROUND_SECONDS) -> Column:
    """Every completed round plus the time into the last one."""
    return (finish_round - 1) * round_seconds + finish_seconds


def control_share(control_time: Column, minutes: Column) -> Column:
    """``"1:06"`` of control in a bout of ``minutes`` minutes -> share."""
    return safe_ratio(parse_mmss_seconds(control_time) / F.lit(60.0), minutes)


def indicator(condition: Column) -> Column:
    """1 when true, 0 otherwise; NULL counts as 0."""
    return F.when(condition, 1).otherwise(0)
