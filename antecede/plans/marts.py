"""The star schema, under enforced contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pyspark.sql import functions as F

from antecede.functions import surrogate_key, surrogate_key_or_null
from antecede.operators.contract import Contract, enforce_contract

# The columns, types and not-null rules of the published tables.

DIM_EVENT = Contract(
    "dim_event",
    """event_sk STRING NOT NULL, event_url STRING NOT NULL, event_name STRING NOT NULL,
    event_date DATE NOT NULL, event_city STRING NOT NULL, event_state STRING,
    event_country STRING NOT NULL, is_modern_era BOOLEAN NOT NULL""",
)
DIM_FIGHTER = Contract(
    "dim_fighter",
    """fighter_sk STRING NOT NULL, fighter_url STRING NOT NULL, fighter_name STRING NOT NULL,
    first_name STRING NOT NULL, last_name STRING, height_inches INT, weight_lbs INT, reach_inches INT,
    stance STRING, date_of_birth DATE, sig_strikes_landed_per_min DECIMAL(6,2) NOT NULL,
    sig_strikes_absorbed_per_min DECIMAL(6,2) NOT NULL, sig_strike_accuracy_pct DOUBLE NOT NULL,
    sig_strike_defense_pct DOUBLE NOT NULL, takedowns_per_15_min DECIMAL(6,2) NOT NULL,
    takedown_accuracy_pct DOUBLE NOT NULL, takedown_defense_pct DOUBLE NOT NULL,
    submissions_per_15_min DECIMAL(6,2) NOT NULL""",
)
FCT_BOUT = Contract(
    "fct_bout",
    """bout_sk STRING NOT NULL, bout_url STRING NOT NULL, event_sk STRING NOT NULL,
    fighter_a_sk STRING NOT NULL, fighter_b_sk STRING NOT NULL, winner_fighter_sk STRING,
    event_date DATE NOT NULL, weight_class STRING NOT NULL, method STRING NOT NULL, is_finish BOOLEAN,
    is_no_contest BOOLEAN NOT NULL, is_draw BOOLEAN NOT NULL, finish_round INT NOT NULL,
    finish_time_seconds INT NOT NULL, bout_duration_seconds INT NOT NULL""",
)
FCT_FIGHTER_BOUT = Contract(
    "fct_fighter_bout",
    """fighter_bout_sk STRING NOT NULL, bout_sk STRING NOT NULL, event_sk STRING NOT NULL,
    fighter_sk STRING NOT NULL, opponent_fighter_sk STRING NOT NULL, corner STRING NOT NULL,
    is_winner BOOLEAN, result STRING NOT NULL, age_at_bout_years DOUBLE, knockdowns INT NOT NULL,
    sig_strikes_landed INT NOT NULL, sig_strikes_attempted INT NOT NULL, sig_strike_accuracy_pct DOUBLE,
    total_strikes_landed INT NOT NULL, total_strikes_attempted INT NOT NULL, takedowns_landed INT NOT NULL,
    takedowns_attempted INT NOT NULL, takedown_accuracy_pct DOUBLE, submission_attempts INT NOT NULL,
    reversals INT NOT NULL, control_time_seconds INT NOT NULL, sig_strikes_absorbed INT NOT NULL,
    takedowns_conceded INT NOT NULL""",
)


def _publish(df: DataFrame, keys: dict, contract: Contract, check_nulls: bool) -> DataFrame:
    shaped = df.withColumns(keys).select(*contract.schema.fieldNames())
    return enforce_contract(shaped, contract, check_nulls)


def dim_event(events: DataFrame, check_nulls: bool = True) -> DataFrame:
    """One row per event."""
    return _publish(events, {"event_sk": surrogate_key("event_url")}, DIM_EVENT, check_nulls)


def dim_fighter(fighters: DataFrame, check_nulls: bool = True) -> DataFrame:
    """One row per fighter, as of the latest scrape."""
    return _publish(fighters, {"fighter_sk": surrogate_key("fighter_url")}, DIM_FIGHTER, check_nulls)


def fct_bout(bouts: DataFrame, events: DataFrame, check_nulls: bool = True) -> DataFrame:
    """One row per bout, with the event's date copied in so that date filters
    need no join."""
    keys = {
        "bout_sk": surrogate_key("bout_url"),
        "event_sk": surrogate_key("event_url"),
        "fighter_a_sk": surrogate_key("fighter_a_url"),
        "fighter_b_sk": surrogate_key("fighter_b_url"),
        "winner_fighter_sk": surrogate_key_or_null("winner_fighter_url"),
    }
    dated = bouts.join(events.select("event_url", "event_date"), "event_url")
    return _publish(dated, keys, FCT_BOUT, check_nulls)


def fct_fighter_bout(rows: DataFrame, check_nulls: bool = True) -> DataFrame:
    """One row per fighter per bout. ``rows`` carries the profile columns of
    :func:`antecede.plans.participants.with_profile`."""
    keys = {
        "fighter_bout_sk": surrogate_key("bout_url", "fighter_url"),
        "bout_sk": surrogate_key("bout_url"),
        "event_sk": surrogate_key("event_url"),
        "fighter_sk": surrogate_key("fighter_url"),
        "opponent_fighter_sk": surrogate_key("opponent_fighter_url"),
    }
    return _publish(rows, keys, FCT_FIGHTER_BOUT, check_nulls)
