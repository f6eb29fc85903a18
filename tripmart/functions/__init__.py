from .datetime import (date_key, date_key_from_parts, default_period_cols, epoch_seconds,
                       in_date_range, key_range, legacy_date_key, legacy_time_key,
                       month_label, seconds_to_minutes, time_key, trip_minutes, trip_parts)
from .numeric import growth, pct_label, ratio

__all__ = [
    "date_key", "date_key_from_parts", "default_period_cols", "epoch_seconds",
    "in_date_range", "key_range", "legacy_date_key", "legacy_time_key", "month_label",
    "seconds_to_minutes", "time_key", "trip_minutes", "trip_parts", "growth",
    "pct_label", "ratio",
]
