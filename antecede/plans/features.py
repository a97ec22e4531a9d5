"""The wide per-bout feature matrix: both fighters side by side, with label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from antecede.functions import indicator, safe_ratio
from antecede.operators.prior import (
    MAX_ROWS_PER_TASK,
    Heavy,
    prior_avg,
    prior_count,
    prior_measures,
    prior_sum,
)
from antecede.operators.sides import pivot_sides
from antecede.plans.career import ENTITY, ORDER, win_streak, win_streak_legacy


def _won() -> Column:
    return F.col("result") == "win"


def _finish_win() -> Column:
    return _won() & F.col("is_finish")


def bout_control_share() -> Column:
    """Share of the bout this fighter was in control."""
    return safe_ratio(F.col("control_time_seconds") / F.lit(60.0), F.col("bout_duration_seconds") / F.lit(60.0))


def fighter_features(
    rows: DataFrame,
    order: Sequence[str] = ORDER,
    legacy: bool = False,
    heavy: Heavy | None = None,
    max_rows: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """Per fighter and bout: the matrix's columns before the pivot.

    All of them come from one window over one exchange, where joining ten
    separately computed frames would shuffle the fights ten times.

    ``legacy`` picks the older rules for two features: finish rate over all prior
    bouts with 0 on a debut (default: per prior win, NULL before the first), and
    a win streak that a no contest ends (default: does not).
    """
    c = F.col
    measures = {
        "num_bouts": prior_count(),
        "win_percentage": prior_avg(indicator(_won())),
        # Whole seconds by 60, and a ratio of two of these: their magnitudes have bounds.
        "avg_fight_minutes": prior_avg(c("bout_duration_seconds") / F.lit(60.0), within=(2.0**-7, 2.0**32)),
        "wins": prior_count(_won()),
        "finish_wins": prior_count(_finish_win()),
        "strikes_landed": prior_sum(c("sig_strikes_landed")),
        "strikes_absorbed": prior_sum(c("sig_strikes_absorbed")),
        "takedowns_for": prior_sum(c("takedowns_landed")),
        "takedowns_against": prior_sum(c("takedowns_conceded")),
        "win_streak": win_streak_legacy() if legacy else win_streak(),
        "avg_control_share": prior_avg(c("control_share"), within=(2.0**-33, 2.0**33)),
    }
    with_share = rows.withColumn("control_share", bout_control_share())
    state = prior_measures(with_share, ENTITY, order, measures, heavy=heavy, max_rows=max_rows, costly=True)
    over_bouts = F.coalesce(safe_ratio(c("finish_wins"), c("num_bouts")), F.lit(0.0))
    return state.withColumns(
        {
            "finish_rate": over_bouts if legacy else safe_ratio(c("finish_wins"), c("wins")),
            "strike_ratio": safe_ratio(c("strikes_landed"), c("strikes_absorbed")),
            "takedown_ratio": safe_ratio(c("takedowns_for"), c("takedowns_against")),
        }
    ).drop("wins", "finish_wins", "strikes_landed", "strikes_absorbed", "takedowns_for", "takedowns_against")


MATRIX_MEASURES = (
    "fighter_url",
    "fighter_name",
    "avg_control_share",
    "num_bouts",
    "win_percentage",
    "avg_fight_minutes",
    "age",
    "finish_rate",
    "strike_ratio",
    "takedown_ratio",
    "weight_class",
    "stance",
    "win_streak",
)


def feature_matrix(
    rows: DataFrame,
    order: Sequence[str] = ORDER,
    include_current: bool = False,
    legacy: bool = False,
    heavy: Heavy | None = None,
    max_rows: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """One row per bout: every feature of corner a and corner b, and the label
    ``winner`` (the winner's name, or ``draw`` / ``nc``).

    ``rows`` carries profile columns and ``weight_class``. ``include_current``
    adds the control share of the bout itself; that is the target's side of the
    line, so it is off by default. Two shuffles on the facts: by fighter for the
    windows, by bout for the pivot.
    """
    features = fighter_features(rows, order, legacy, heavy, max_rows).withColumn("age", F.col("age_at_bout_years"))
    measures = [*MATRIX_MEASURES, *(["control_share"] if include_current else [])]
    label = (
        F.when(F.col("result") == "win", F.col("fighter_name"))
        .when(F.col("result") == "draw", "draw")
        .when(F.col("result") == "no_contest", "nc")
    )
    labelled = features.withColumn("winner", label)
    return pivot_sides(labelled, ["bout_url"], "corner", measures, constant=["event_url", "winner"])
