"""Career-to-date features: a fighter as they entered each bout.

Everything comes from strictly earlier bouts. On a debut counts are 0 and
averages NULL. No contests count toward volume, not toward results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from antecede.functions import safe_ratio
from antecede.operators.prior import (
    MAX_ROWS_PER_TASK,
    Heavy,
    Measure,
    prior_count,
    prior_measures,
    prior_streak,
    prior_sum,
)

ENTITY = ["fighter_url"]
ORDER = ["event_date", "bout_url"]

COLUMNS = (
    "bout_url",
    "fighter_url",
    "event_date",
    "prior_bouts",
    "prior_wins",
    "prior_losses",
    "prior_draws",
    "prior_win_streak",
    "prior_win_rate",
    "prior_finish_rate",
    "prior_minutes_fought",
    "prior_avg_fight_minutes",
    "prior_sig_strike_diff_per_min",
    "prior_takedown_diff_per_15",
    "prior_control_share",
)


def _result(value: str) -> Column:
    return F.col("result") == value


def win_streak() -> Measure:
    """A loss or a draw ends the streak; a no contest is invisible to it."""
    return prior_streak(_result("win"), F.col("result").isin("loss", "draw"))


def win_streak_legacy() -> Measure:
    """Anything but a win ends the streak, a no contest included."""
    return prior_streak(_result("win"), ~F.coalesce(_result("win"), F.lit(False)))


def career_to_date(
    rows: DataFrame,
    order: Sequence[str] = ORDER,
    heavy: Heavy | None = None,
    max_rows: int = MAX_ROWS_PER_TASK,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The 12 career features per fighter and bout. ``rows`` is
    :func:`antecede.plans.participants.fighter_bouts`; ``order`` must be total
    per fighter. ``keep`` carries further columns of ``rows``."""
    narrow = rows.select(
        *dict.fromkeys(["bout_url", "fighter_url", "event_date", *order, *keep]),
        "result",
        "is_finish",
        "bout_duration_seconds",
        "control_time_seconds",
        (F.col("sig_strikes_landed") - F.col("sig_strikes_absorbed")).alias("sig_strike_diff"),
        (F.col("takedowns_landed") - F.col("takedowns_conceded")).alias("takedown_diff"),
    )
    measures = {
        "prior_bouts": prior_count(),
        "prior_wins": prior_count(_result("win")),
        "prior_losses": prior_count(_result("loss")),
        "prior_draws": prior_count(_result("draw")),
        "prior_finish_wins": prior_count(_result("win") & F.col("is_finish")),
        "prior_seconds": prior_sum(F.col("bout_duration_seconds"), default=0),
        "prior_strike_diff": prior_sum(F.col("sig_strike_diff")),
        "prior_takedown_diff": prior_sum(F.col("takedown_diff")),
        "prior_control_seconds": prior_sum(F.col("control_time_seconds")),
        "prior_win_streak": win_streak(),
    }
    state = prior_measures(narrow, ENTITY, order, measures, heavy=heavy, max_rows=max_rows, costly=True)

    c = F.col
    minutes = c("prior_seconds").cast("double") / F.lit(60.0)
    quarters = c("prior_seconds").cast("double") / F.lit(900.0)
    features = {
        "prior_win_rate": safe_ratio(c("prior_wins"), c("prior_wins") + c("prior_losses") + c("prior_draws")),
        "prior_finish_rate": safe_ratio(c("prior_finish_wins"), c("prior_wins")),
        "prior_minutes_fought": minutes,
        "prior_avg_fight_minutes": safe_ratio(minutes, c("prior_bouts")),
        "prior_sig_strike_diff_per_min": safe_ratio(c("prior_strike_diff"), minutes),
        "prior_takedown_diff_per_15": safe_ratio(c("prior_takedown_diff"), quarters),
        "prior_control_share": safe_ratio(c("prior_control_seconds"), c("prior_seconds")),
    }
    return state.withColumns(features).select(*COLUMNS, *keep)
