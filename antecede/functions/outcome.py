"""How a bout ended, and what that means from one side's point of view."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The site's method strings.
FINISH_METHODS = ("KO/TKO", "Submission", "TKO - Doctor's Stoppage")
DECISION_PREFIX = "Decision"


def outcome_of(result: Column, winner_name: Column) -> Column:
    """win / draw / nc. Old rows have no ``result``: there a no contest stands
    in the winner's place and everything else is a win."""
    return F.coalesce(result, F.when(winner_name == "nc", "nc").otherwise("win"))


def winner_key(winner: Column, name_a: Column, key_a: Column, name_b: Column, key_b: Column) -> Column:
    """The winner's key, resolved from its name inside the row; else NULL."""
    return F.when(winner == name_a, key_a).when(winner == name_b, key_b)


def is_finish(method: Column) -> Column:
    """True / false / NULL: an overturned or disqualified bout is neither."""
    return F.when(method.isin(*FINISH_METHODS), True).when(method.startswith(DECISION_PREFIX), False)


def perspective_won(winner: Column, mine: Column, theirs: Column, draw: Column) -> Column:
    """Did this side win? False for a draw, NULL for a no contest."""
    return F.when(winner == mine, True).when(draw, False).when(winner == theirs, False)


def perspective_result(winner: Column, mine: Column, theirs: Column, draw: Column, no_contest: Column) -> Column:
    """win / loss / draw / no_contest for this side; NULL if none of them."""
    return (
        F.when(no_contest, "no_contest")
        .when(draw, "draw")
        .when(winner == mine, "win")
        .when(winner == theirs, "loss")
    )
