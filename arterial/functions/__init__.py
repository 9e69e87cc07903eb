"""Column functions."""

from arterial.functions.geo import distance_from, haversine, within_bounds
from arterial.functions.temporal import temporal_columns, temporal_features
from arterial.functions.traffic import level_right, severity_left, severity_rank, travel_time_minutes

__all__ = [
    "distance_from", "haversine", "within_bounds", "temporal_columns", "temporal_features",
    "level_right", "severity_left", "severity_rank", "travel_time_minutes",
]
