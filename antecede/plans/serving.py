"""Bounded reads: the two a front end makes, and the events a run works on."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from antecede.operators.select import page_of, point_lookup, select_window
from antecede.plans.staging import MODERN_ERA_START

PAGE_SIZE = 25


def fighter_list(fighters: DataFrame, page: int = 1, size: int = PAGE_SIZE) -> DataFrame:
    """One page of the fighter list, in key order."""
    columns = ["fighter_url", "first_name", "last_name", "date_of_birth"]
    return page_of(fighters.select(*columns), ["fighter_url"], page, size)


def fighter_lookup(fighters: DataFrame, fighter_url: str) -> DataFrame:
    """One fighter's profile."""
    return point_lookup(fighters, "fighter_url", fighter_url)


def select_events(
    events: DataFrame,
    since: dt.date = MODERN_ERA_START,
    until: dt.date | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Staged events that have happened, newest first. Listings hold upcoming
    cards too; ``until``, today by default, keeps those out."""
    until = until or dt.datetime.now(dt.UTC).date()
    return select_window(events, "event_date", since, until, limit, ["event_url"])
