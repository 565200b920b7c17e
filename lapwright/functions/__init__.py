from lapwright.functions.measures import exact_mean, mean_of, mean_of_parts, rounded, spread_of_parts
from lapwright.functions.wording import fixed_point, rain_label, session_label, track_temperature_band
from lapwright.functions.scoring import championship_points
from lapwright.functions.periods import since_days

__all__ = [
    "championship_points",
    "exact_mean",
    "fixed_point",
    "mean_of",
    "mean_of_parts",
    "rain_label",
    "rounded",
    "session_label",
    "since_days",
    "spread_of_parts",
    "track_temperature_band",
]
