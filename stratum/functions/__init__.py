"""Column expressions shared by the operators (all built-in, JVM side)."""

from stratum.functions.columns import (
    entity_label,
    exact_mean,
    number,
    goal_hit,
    normalized_region,
    out_of_range,
    share_pct,
    to_double_or_null,
    weighted_share_pct,
    year_from_suffix,
)

__all__ = [
    "entity_label",
    "exact_mean",
    "number",
    "goal_hit",
    "normalized_region",
    "out_of_range",
    "share_pct",
    "to_double_or_null",
    "weighted_share_pct",
    "year_from_suffix",
]
