"""Reusable DataFrame operators."""

from antecede.operators.attach import attach_columns
from antecede.operators.contract import Contract, ContractError, enforce_contract
from antecede.operators.keyset import high_watermark, landed_subset, since_watermark, todo
from antecede.operators.latest import latest_per_key
from antecede.operators.prior import (
    heavy_keys,
    prior_avg,
    prior_count,
    prior_last,
    prior_max,
    prior_measures,
    prior_streak,
    prior_sum,
)
from antecede.operators.select import page_of, point_lookup, select_window
from antecede.operators.sides import distinct_participants, pivot_sides, unpivot_pairs

__all__ = [
    "Contract",
    "ContractError",
    "attach_columns",
    "distinct_participants",
    "enforce_contract",
    "heavy_keys",
    "high_watermark",
    "landed_subset",
    "latest_per_key",
    "page_of",
    "pivot_sides",
    "point_lookup",
    "prior_avg",
    "prior_count",
    "prior_last",
    "prior_max",
    "prior_measures",
    "prior_streak",
    "prior_sum",
    "select_window",
    "since_watermark",
    "todo",
    "unpivot_pairs",
]
