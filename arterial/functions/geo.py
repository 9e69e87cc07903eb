"""Great-circle distance and bounding boxes (GEO-1 to GEO-5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0
EARTH_RADIUS_M = 6_371_000.0
# Default city centre (latitude, longitude).
CITY_CENTER = (40.7128, -74.0060)

Number = Column | str | float


def _column(value: Number) -> Column:
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(float(value))


def haversine(
    lat1: Number, lon1: Number, lat2: Number, lon2: Number, radius: float = EARTH_RADIUS_KM
) -> Column:
    """Great-circle distance in the unit of ``radius``; strings are column names."""
    lat1, lon1, lat2, lon2 = (_column(v) for v in (lat1, lon1, lat2, lon2))
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    # rounding can push the two roots a hair outside [0, 1] for antipodal points
    a = F.least(F.lit(1.0), F.greatest(F.lit(0.0), a))
    return F.lit(2.0 * radius) * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def distance_from(df: DataFrame, lat: float = CITY_CENTER[0], lon: float = CITY_CENTER[1]) -> DataFrame:
    """GEO-3: ``distance_from_center`` in km."""
    return df.withColumn("distance_from_center", haversine("latitude", "longitude", lat, lon))


def within_bounds(
    df: DataFrame, min_lat: float, max_lat: float, min_lon: float, max_lon: float
) -> DataFrame:
    """GEO-4: rows inside the box, borders included."""
    return df.filter(
        F.col("latitude").between(min_lat, max_lat) & F.col("longitude").between(min_lon, max_lon)
    )


def select_locations(
    df: DataFrame,
    location_ids: Sequence[str] | None = None,
    bounding_box: Sequence[float] | str | None = None,
) -> DataFrame:
    """GEO-5: keep given ids and/or a ``min_lat,min_lon,max_lat,max_lon`` box."""
    if location_ids is not None:
        df = df.filter(F.col("location_id").isin(list(location_ids)))
    if bounding_box is not None:
        box = bounding_box.split(",") if isinstance(bounding_box, str) else bounding_box
        min_lat, min_lon, max_lat, max_lon = (float(v) for v in box)
        df = within_bounds(df, min_lat, max_lat, min_lon, max_lon)
    return df
