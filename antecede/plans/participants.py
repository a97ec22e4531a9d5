"""One row per fighter per bout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from antecede.functions import age_years, perspective_result, perspective_won
from antecede.operators.sides import unpivot_pairs

# This side's own numbers ...
OWN = (
    "knockdowns",
    "sig_strikes_landed",
    "sig_strikes_attempted",
    "sig_strike_accuracy_pct",
    "total_strikes_landed",
    "total_strikes_attempted",
    "takedowns_landed",
    "takedowns_attempted",
    "takedown_accuracy_pct",
    "submission_attempts",
    "reversals",
    "control_time_seconds",
)
# ... and the opponent's, as seen from here.
CONCEDED = {"sig_strikes_absorbed": "sig_strikes_landed", "takedowns_conceded": "takedowns_landed"}


def fighter_bouts(bouts: DataFrame, events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Staged bouts unpivoted, with the event's date; a bout without an event
    row is dropped. ``keep`` carries further bout columns.

    The date is joined at bout grain, before the unpivot, so half as many rows
    go through the join. Events may be large and unevenly used, so the join
    strategy is left to the optimizer (a runtime-checked broadcast, else a sort
    merge join with skewed partitions split).
    """
    dated = bouts.join(events.select("event_url", "event_date"), "event_url")

    def won(me: str, other: str):
        return perspective_won(
            F.col("winner_fighter_url"), F.col(f"fighter_{me}_url"), F.col(f"fighter_{other}_url"), F.col("is_draw")
        )

    def result(me: str, other: str):
        return perspective_result(
            F.col("winner_fighter_url"),
            F.col(f"fighter_{me}_url"),
            F.col(f"fighter_{other}_url"),
            F.col("is_draw"),
            F.col("is_no_contest"),
        )

    return unpivot_pairs(
        dated,
        common=["bout_url", "event_url", "event_date", "is_finish", "bout_duration_seconds", *keep],
        side_cols={
            "fighter_url": "fighter_{side}_url",
            "fighter_name": "fighter_{side}_name",
            **{name: f"fighter_{{side}}_{name}" for name in OWN},
        },
        cross_cols={
            "opponent_fighter_url": "fighter_{side}_url",
            **{name: f"fighter_{{side}}_{source}" for name, source in CONCEDED.items()},
        },
        derived={"is_winner": won, "result": result},
    )


def with_profile(rows: DataFrame, fighters: DataFrame) -> DataFrame:
    """Adds stance and age at the bout. A fighter with no profile keeps their
    bouts; a date of birth never changes, so the age is point-in-time safe."""
    profile = fighters.select("fighter_url", "date_of_birth", "stance")
    joined = rows.join(profile, "fighter_url", "left")
    age = age_years(F.col("event_date"), F.col("date_of_birth"))
    return joined.withColumn("age_at_bout_years", age).drop("date_of_birth")
