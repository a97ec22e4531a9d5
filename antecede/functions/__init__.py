"""Column functions. Everything here stays inside Catalyst: no UDFs."""

from antecede.functions.keys import surrogate_key, surrogate_key_or_null
from antecede.functions.numbers import (
    age_years,
    bout_seconds,
    control_share,
    indicator,
    safe_ratio,
)
from antecede.functions.outcome import (
    is_finish,
    outcome_of,
    perspective_result,
    perspective_won,
    winner_key,
)
from antecede.functions.text import (
    nullify_sentinels,
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
    split_full_name,
    split_location,
)

__all__ = [
    "age_years",
    "bout_seconds",
    "control_share",
    "indicator",
    "is_finish",
    "nullify_sentinels",
    "outcome_of",
    "parse_attempted",
    "parse_count",
    "parse_decimal",
    "parse_height",
    "parse_inches",
    "parse_landed",
    "parse_mmss_seconds",
    "parse_percentage",
    "parse_site_date",
    "parse_unit_number",
    "perspective_result",
    "perspective_won",
    "safe_ratio",
    "split_full_name",
    "split_location",
    "surrogate_key",
    "surrogate_key_or_null",
    "winner_key",
]
