from hubflow.functions.exprs import (
    bias_corrected_skew,
    day_name,
    finite_or_null,
    hash_order,
    hash_percent,
    risk_level,
    route_insight,
    route_lane,
    safe_ratio,
    weekday_monday0,
)

__all__ = [
    "bias_corrected_skew", "day_name", "finite_or_null", "hash_order", "hash_percent",
    "risk_level", "route_insight", "route_lane", "safe_ratio", "weekday_monday0",
]
