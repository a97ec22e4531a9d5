"""Parsers for rendered text.

The raw layer keeps every value as the site wrote it; these turn one such
string into a typed column. A value that does not parse becomes NULL, never an
error and never zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the site prints for "not recorded".
SENTINELS = ("--", "---", "")

# Date shapes, "September 05, 2026" and "Feb 13, 1990". A single
# `d` takes one- and two-digit days.
DATE_STYLES = {"long": "MMMM d, yyyy", "short": "MMM d, yyyy"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _part(c: Column, delimiter: str, n: int) -> Column:
    return F.split_part(c, F.lit(delimiter), F.lit(n))


def nullify_sentinels(c: Column | str) -> Column:
    """``--``, ``---`` and the empty string mean "not recorded"."""
    c = _col(c)
    return F.when(~c.isin(*SENTINELS), c)


def parse_count(c: Column | str) -> Column:
    """``"3"`` -> 3."""
    return _col(c).try_cast("int")


def parse_decimal(c: Column | str) -> Column:
    """``"3.14"`` -> decimal(6,2)."""
    return _col(c).try_cast("decimal(6,2)")


def parse_landed(c: Column | str) -> Column:
    """``"14 of 31"`` -> 14."""
    return _part(_col(c), " of ", 1).try_cast("int")


def parse_attempted(c: Column | str) -> Column:
    """``"14 of 31"`` -> 31."""
    return _part(_col(c), " of ", 2).try_cast("int")


def parse_percentage(c: Column | str) -> Column:
    """``"45%"`` -> 0.45 as double; a sentinel -> NULL, not zero."""
    digits = F.replace(nullify_sentinels(c), F.lit("%"), F.lit(""))
    return digits.try_cast("decimal(5,2)").cast("double") / F.lit(100.0)


def parse_mmss_seconds(c: Column | str) -> Column:
    """``"5:08"`` -> 308. Minutes are unbounded."""
    c = _col(c)
    return _part(c, ":", 1).try_cast("int") * 60 + _part(c, ":", 2).try_cast("int")


def parse_site_date(c: Column | str, style: str = "long") -> Column:
    """``"September 05, 2026"`` (long) or ``"Feb 13, 1990"`` (short) -> date."""
    return F.try_to_date(nullify_sentinels(c), DATE_STYLES[style])


def parse_inches(c: Column | str) -> Column:
    """``75"`` -> 75."""
    return F.replace(nullify_sentinels(c), F.lit('"'), F.lit("")).try_cast("int")


def parse_height(c: Column | str) -> Column:
    """``5' 11"`` -> 71; NULL when either part is missing."""
    c = _col(c)
    inches = F.replace(F.trim(_part(c, "'", 2)), F.lit('"'), F.lit(""))
    return _part(c, "'", 1).try_cast("int") * 12 + inches.try_cast("int")


def parse_unit_number(c: Column | str) -> Column:
    """``"155 lbs."`` -> 155."""
    return _part(nullify_sentinels(c), " ", 1).try_cast("int")


def split_location(c: Column | str) -> Column:
    """Location -> struct(city, state, country).

    City is the first part and country the last; a state exists only in the
    three-part form.
    """
    c = _col(c)
    three_parts = F.size(F.split(c, ",")) == 3
    return F.struct(
        F.trim(_part(c, ",", 1)).alias("city"),
        F.when(three_parts, F.trim(_part(c, ",", 2))).alias("state"),
        F.trim(_part(c, ",", -1)).alias("country"),
    )


def split_full_name(c: Column | str) -> Column:
    """Full name -> struct(first, last), cut at the first space; last is ''
    for a single name."""
    parts = F.split(_col(c), " ", 2)
    return F.struct(
        F.get(parts, F.lit(0)).alias("first"),
        F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("last"),
    )
