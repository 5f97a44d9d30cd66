from daystrata.plans.derived import (
    first_max_kept,
    hottest_kept,
    keep_extremes,
    max_per_day_kept,
    settle_days,
)
from daystrata.plans.increments import Increment, land_increments
from daystrata.plans.layers import LayerRun, land_to_raw, raw_to_clean, run

__all__ = [
    "Increment",
    "LayerRun",
    "first_max_kept",
    "hottest_kept",
    "keep_extremes",
    "land_increments",
    "land_to_raw",
    "max_per_day_kept",
    "raw_to_clean",
    "run",
    "settle_days",
]
