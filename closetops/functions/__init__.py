"""Column-level helpers: all are native Spark expressions (no Python UDF)."""

from .predicates import any_in, exclude_prefix_digits, flag, months_back
from .temporal import (day_boundaries, elapsed_days, epoch_to_ntz, hour_boundaries,
                       month_boundaries, shift_zone, to_eastern, week_start)

__all__ = ["any_in", "exclude_prefix_digits", "flag", "months_back", "day_boundaries",
           "elapsed_days", "epoch_to_ntz", "hour_boundaries", "month_boundaries",
           "shift_zone", "to_eastern", "week_start"]
