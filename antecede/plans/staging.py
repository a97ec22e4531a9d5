"""Staging: the latest version of each record, text turned into typed columns.

Each function takes a raw table (all text, many versions per key, plus
``_ingested_at``) and keeps its grain.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from antecede.functions import (
    bout_seconds,
    is_finish,
    nullify_sentinels,
    outcome_of,
    parse_attempted,
    parse_count,
    parse_decimal,
    parse_height,
    parse_inches,
    parse_landed,
    parse_mmss_seconds,
    parse_percentage,
    parse_site_date,
    parse_unit_number,
    split_location,
    winner_key,
)
from antecede.functions.numbers import ROUND_SECONDS
from antecede.operators.latest import latest_per_key

MODERN_ERA_START = dt.date(2000, 9, 1)

SIDES = ("a", "b")


def _side_columns(side: str) -> list[Column]:
    """The typed box score of one side."""
    raw = f"fighter_{side}_{{}}".format
    typed = {
        "knockdowns": parse_count(raw("knockdowns")),
        "sig_strikes_landed": parse_landed(raw("sig_strikes")),
        "sig_strikes_attempted": parse_attempted(raw("sig_strikes")),
        "sig_strike_accuracy_pct": parse_percentage(raw("sig_strike_acc")),
        "total_strikes_landed": parse_landed(raw("total_strikes")),
        "total_strikes_attempted": parse_attempted(raw("total_strikes")),
        "takedowns_landed": parse_landed(raw("takedowns")),
        "takedowns_attempted": parse_attempted(raw("takedowns")),
        "takedown_accuracy_pct": parse_percentage(raw("takedown_acc")),
        "submission_attempts": parse_count(raw("sub_attempts")),
        "reversals": parse_count(raw("reversals")),
        "control_time_seconds": parse_mmss_seconds(raw("control_time")),
    }
    return [column.alias(raw(name)) for name, column in typed.items()]


def _latest(raw: DataFrame, key: str, tie_break: Sequence[str] | None) -> DataFrame:
    """The newest version of each record. Versions of the same instant are told
    apart by ``tie_break``, by default by what lineage there is, so that a re-run
    picks the same one."""
    if tie_break is None:
        tie_break = [c for c in ("_batch_id", "_raw_payload") if c in raw.columns]
    return latest_per_key(raw, [key], "_ingested_at", tie_break)


def stage_bouts(
    raw: DataFrame,
    round_seconds: int = ROUND_SECONDS,
    tie_break: Sequence[str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per bout, both corners side by side. ``keep`` passes further raw
    columns through."""
    latest = _latest(raw, "bout_url", tie_break)
    outcome = outcome_of(F.col("result"), F.col("winner_name"))
    finish_seconds = parse_mmss_seconds("finish_time")
    return latest.select(
        "bout_url",
        "event_url",
        "fighter_a_url",
        "fighter_b_url",
        "fighter_a_name",
        "fighter_b_name",
        winner_key(
            F.col("winner_name"),
            F.col("fighter_a_name"),
            F.col("fighter_a_url"),
            F.col("fighter_b_name"),
            F.col("fighter_b_url"),
        ).alias("winner_fighter_url"),
        (outcome == "nc").alias("is_no_contest"),
        (outcome == "draw").alias("is_draw"),
        "weight_class",
        "method",
        is_finish(F.col("method")).alias("is_finish"),
        parse_count("finish_round").alias("finish_round"),
        finish_seconds.alias("finish_time_seconds"),
        bout_seconds(parse_count("finish_round"), finish_seconds, round_seconds).alias("bout_duration_seconds"),
        *(column for side in SIDES for column in _side_columns(side)),
        "_ingested_at",
        *keep,
    )


def stage_events(raw: DataFrame, tie_break: Sequence[str] | None = None) -> DataFrame:
    """One row per event, upcoming ones included."""
    latest = _latest(raw, "event_url", tie_break)
    place = split_location("event_location")
    typed = latest.select(
        "event_url",
        "event_name",
        parse_site_date("event_date", "long").alias("event_date"),
        place["city"].alias("event_city"),
        place["state"].alias("event_state"),
        place["country"].alias("event_country"),
        F.col("event_location").alias("event_location_raw"),
        "_ingested_at",
    )
    modern = F.when(F.col("event_date") >= F.lit(MODERN_ERA_START), True).otherwise(False)
    return typed.withColumn("is_modern_era", modern)


def stage_fighters(raw: DataFrame, tie_break: Sequence[str] | None = None) -> DataFrame:
    """One row per fighter, as the latest scrape showed them."""
    latest = _latest(raw, "fighter_url", tie_break)
    return latest.select(
        "fighter_url",
        "fighter_name",
        "first_name",
        nullify_sentinels("last_name").alias("last_name"),
        parse_height("height").alias("height_inches"),
        parse_unit_number("weight").alias("weight_lbs"),
        parse_inches("reach").alias("reach_inches"),
        nullify_sentinels("stance").alias("stance"),
        parse_site_date("dob", "short").alias("date_of_birth"),
        parse_decimal("sig_strikes_landed_per_min").alias("sig_strikes_landed_per_min"),
        parse_decimal("sig_strikes_absorbed_per_min").alias("sig_strikes_absorbed_per_min"),
        parse_percentage("sig_strike_accuracy").alias("sig_strike_accuracy_pct"),
        parse_percentage("sig_strike_defense").alias("sig_strike_defense_pct"),
        parse_decimal("takedown_average").alias("takedowns_per_15_min"),
        parse_percentage("takedown_accuracy").alias("takedown_accuracy_pct"),
        parse_percentage("takedown_defense").alias("takedown_defense_pct"),
        parse_decimal("submission_average").alias("submissions_per_15_min"),
        "_ingested_at",
    )
