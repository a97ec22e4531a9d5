"""The declared data tests of every layer, as one list of rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from antecede.operators import quality as q
from antecede.operators.prior import MAX_ROWS_PER_TASK, Heavy
from antecede.plans import career, marts

# What the declared tests accept.

RAW_RESULTS = ["win", "draw", "nc"]
RESULTS = ["win", "loss", "draw", "no_contest"]
STANCES = ["Orthodox", "Southpaw", "Switch", "Open Stance", "Sideways"]
ROUNDS = [1, 2, 3, 4, 5]

LANDED_ATTEMPTED = [
    ("sig_strikes_landed", "sig_strikes_attempted"),
    ("takedowns_landed", "takedowns_attempted"),
    ("total_strikes_landed", "total_strikes_attempted"),
]

RATES = ["prior_win_rate", "prior_finish_rate"]
VOLUME = [
    "prior_avg_fight_minutes",
    "prior_sig_strike_diff_per_min",
    "prior_takedown_diff_per_15",
    "prior_control_share",
]


Rules = dict[str, DataFrame | q.RowRules]


def source_rules(raw_events: DataFrame, raw_bouts: DataFrame, raw_fighters: DataFrame) -> Rules:
    """What the raw layer promises."""
    bout_keys = ["bout_url", "event_url", "fighter_a_url", "fighter_b_url"]
    return {
        "raw_events": q.RowRules(raw_events, {"raw_events_not_null": q.is_missing("event_url", "event_date")}),
        "raw_bouts": q.RowRules(
            raw_bouts,
            {
                "raw_bouts_not_null": q.is_missing(*bout_keys),
                "raw_bouts_result": q.is_outside("result", RAW_RESULTS),
            },
        ),
        "raw_fighters": q.RowRules(raw_fighters, {"raw_fighters_not_null": q.is_missing("fighter_url")}),
    }


def staging_rules(events: DataFrame, bouts: DataFrame, fighters: DataFrame) -> Rules:
    """What staging promises."""
    event_columns = ["event_url", "event_date", "event_city", "event_country", "is_modern_era"]
    bout_columns = [
        "bout_url",
        "event_url",
        "fighter_a_url",
        "fighter_b_url",
        "is_no_contest",
        "is_draw",
        "finish_round",
        "finish_time_seconds",
        "bout_duration_seconds",
        "method",
    ]
    return {
        "stg_events": q.RowRules(events, {"stg_events_not_null": q.is_missing(*event_columns)}),
        "stg_bouts": q.RowRules(
            bouts,
            {
                "stg_bouts_not_null": q.is_missing(*bout_columns),
                "stg_bouts_round": q.is_outside("finish_round", ROUNDS),
            },
        ),
        "stg_fighters": q.RowRules(
            fighters,
            {
                "stg_fighters_not_null": q.is_missing("fighter_url", "fighter_name"),
                "stg_fighters_stance": q.is_outside("stance", STANCES),
            },
        ),
        "stg_events_unique": q.unique(events, "event_url"),
        "stg_bouts_unique": q.unique(bouts, "bout_url"),
        "stg_fighters_unique": q.unique(fighters, "fighter_url"),
        "stg_bouts_event": q.relationships(bouts, "event_url", events, "event_url"),
        "stg_bouts_fighter_a": q.relationships(bouts, "fighter_a_url", fighters, "fighter_url"),
        "stg_bouts_fighter_b": q.relationships(bouts, "fighter_b_url", fighters, "fighter_url"),
    }


def career_rules(rows: DataFrame, order: Sequence[str] = career.ORDER) -> Rules:
    """What the career features promise. ``rows`` carries the order columns."""
    filled = ["bout_url", "fighter_url", "event_date", "prior_bouts", "prior_wins", "prior_losses", "prior_draws"]
    shares = {"win_rate": "prior_win_rate", "finish_rate": "prior_finish_rate", "control_share": "prior_control_share"}
    return {
        "career": q.RowRules(
            rows,
            {
                "career_not_null": q.is_missing(*filled, "prior_win_streak", "prior_minutes_fought"),
                **{f"career_{name}_range": q.is_out_of_range(col, 0, 1) for name, col in shares.items()},
            },
        ),
        "career_grain": q.unique_combination(rows, ["bout_url", "fighter_url"]),
        "career_order": q.unique_combination(rows, ["fighter_url", order[0]]),
    }


def _undecided() -> Column:
    return F.greatest("is_draw", "is_no_contest")


def mart_rules(events: DataFrame, fighters: DataFrame, bouts: DataFrame, fighter_bouts: DataFrame) -> Rules:
    """What the star schema promises, beyond its contracts."""
    rules: Rules = {
        "fct_bout": q.RowRules(
            bouts,
            {
                "fct_bout_winner_filled": _undecided() != F.col("winner_fighter_sk").isNull(),
                "fct_bout_duration": q.is_false("bout_duration_seconds > 0"),
                "winner_is_a_participant": q.is_stranger("winner_fighter_sk", ["fighter_a_sk", "fighter_b_sk"]),
            },
        ),
        "fct_fighter_bout": q.RowRules(
            fighter_bouts,
            {
                "fct_fighter_bout_corner": q.is_outside("corner", ["a", "b"]),
                "fct_fighter_bout_result": q.is_outside("result", RESULTS),
                "landed_not_above_attempted": q.exceeds(LANDED_ATTEMPTED),
            },
        ),
        "dim_event_sk": q.unique(events, "event_sk"),
        "dim_event_url": q.unique(events, "event_url"),
        "dim_fighter_sk": q.unique(fighters, "fighter_sk"),
        "dim_fighter_url": q.unique(fighters, "fighter_url"),
        "fct_bout_sk": q.unique(bouts, "bout_sk"),
        "fct_bout_url": q.unique(bouts, "bout_url"),
        "fct_bout_event": q.relationships(bouts, "event_sk", events, "event_sk"),
        "fct_fighter_bout_sk": q.unique(fighter_bouts, "fighter_bout_sk"),
        "fct_fighter_bout_grain": q.unique_combination(fighter_bouts, ["bout_sk", "corner"]),
        "fct_fighter_bout_bout": q.relationships(fighter_bouts, "bout_sk", bouts, "bout_sk"),
        "fct_fighter_bout_event": q.relationships(fighter_bouts, "event_sk", events, "event_sk"),
        "two_rows_per_bout": q.children_per_parent(bouts, "bout_sk", fighter_bouts, "bout_sk", 2),
        "control_within_duration": control_within_duration(fighter_bouts, bouts),
    }
    for key in ("fighter_a_sk", "fighter_b_sk", "winner_fighter_sk"):
        rules[f"fct_bout_{key}"] = q.relationships(bouts, key, fighters, "fighter_sk")
    for key in ("fighter_sk", "opponent_fighter_sk"):
        rules[f"fct_fighter_bout_{key}"] = q.relationships(fighter_bouts, key, fighters, "fighter_sk")
    return rules


def contract_nulls(fct_fighter_bout: DataFrame) -> DataFrame:
    """(column, n) of NULLs in the columns the contract says are filled."""
    return q.null_counts(fct_fighter_bout, marts.FCT_FIGHTER_BOUT.not_null)


def control_within_duration(fighter_bouts: DataFrame, bouts: DataFrame) -> DataFrame:
    return q.within_parent(fighter_bouts, "bout_sk", bouts, "control_time_seconds", "bout_duration_seconds")


def debuts(rows: DataFrame) -> DataFrame:
    """A debut, and only a debut, has an empty history."""
    results = (F.col("prior_wins") + F.col("prior_losses") + F.col("prior_draws")).alias("prior_results")
    return q.debut_is_empty(
        rows.select("*", results),
        "prior_bouts",
        zero=["prior_results", "prior_win_streak", "prior_minutes_fought"],
        null=[*RATES, *VOLUME],
        volume=VOLUME,
    ).drop("prior_results")


def ordinals(
    rows: DataFrame,
    order: Sequence[str] = career.ORDER,
    heavy: Heavy | None = None,
    max_rows: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """``prior_bouts`` starts at 0 and rises by one."""
    return q.rises_by_one(rows, career.ENTITY, order, "prior_bouts", heavy, max_rows)


def leakage(rows: DataFrame, fighter_bouts: DataFrame, order: Sequence[str] = career.ORDER) -> DataFrame:
    """Career rows that do not follow from the bout before: counts, minutes,
    both differentials, control time and the streak."""
    minutes = F.col("prior_minutes_fought")

    def total(rate: str, per: float) -> Column:
        return F.col(rate) * minutes / F.lit(per)

    model = rows.withColumns(
        {
            "sig_strike_total": total("prior_sig_strike_diff_per_min", 1.0),
            "takedown_total": total("prior_takedown_diff_per_15", 15.0),
            "control_total": total("prior_control_share", 1.0),
        }
    )
    result = F.col("result")
    return q.no_leakage(
        model,
        fighter_bouts,
        career.ENTITY,
        order,
        "prior_bouts",
        totals={
            "prior_wins": (result == "win").cast("int"),
            "prior_losses": (result == "loss").cast("int"),
            "prior_draws": (result == "draw").cast("int"),
            "prior_minutes_fought": F.col("bout_duration_seconds") / F.lit(60.0),
            "sig_strike_total": F.col("sig_strikes_landed") - F.col("sig_strikes_absorbed"),
            "takedown_total": F.col("takedowns_landed") - F.col("takedowns_conceded"),
            "control_total": F.col("control_time_seconds") / F.lit(60.0),
        },
        streaks={"prior_win_streak": (result == "win", result.isin("loss", "draw"))},
    )
