"""Alerts, route recommendations and travel advisories (ALR-1 to ALR-3, STR-2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arterial.functions.traffic import SEVERITIES, severity_rank

# Message and advice per severity; %s is the location. The last entry is for unknown severities.
TEXTS = {
    "severe": ("Traffic nearly at a standstill at %s: long delays", "Stay away from this road"),
    "high": ("Heavy traffic at %s: delays likely", "Another road will probably be quicker"),
    "medium": ("Slow traffic at %s: short delays possible", "Allow some extra time"),
    "low": ("Slightly slower traffic at %s", "No change of plans needed"),
    "none": ("Free flow at %s", "Nothing to do"),
    "unknown": ("Traffic report for %s", "Watch the situation"),
}
NEUTRAL_RANK = SEVERITIES.index("medium")


def _text(severity: Column, position: int) -> Column:
    text = F.when(severity == "severe", F.lit(TEXTS["severe"][position]))
    for name in ("high", "medium", "low", "none"):
        text = text.when(severity == name, F.lit(TEXTS[name][position]))
    return text.otherwise(F.lit(TEXTS["unknown"][position]))


def alert_message(severity: Column, location: Column) -> Column:
    return F.replace(_text(severity, 0), F.lit("%s"), location.cast("string"))


def recommendation(severity: Column) -> Column:
    return _text(severity, 1)


def traffic_alerts(df: DataFrame, threshold: str = "high", at: Column | None = None) -> DataFrame:
    """ALR-1: an alert for each row at or above ``threshold``; unknown thresholds mean medium.

    The five texts are part of the projection, so alerts need no join and run on streams.
    """
    names = set(df.columns)
    least = threshold.lower()
    least_rank = SEVERITIES.index(least) if least in SEVERITIES else NEUTRAL_RANK
    severity = F.coalesce(F.col("severity"), F.lit("none")) if "severity" in names else F.lit("none")

    def given(name: str, default: object) -> Column:
        return F.coalesce(F.col(name), F.lit(default)) if name in names else F.lit(default)

    location = given("location_id", "unknown")
    place = F.struct(
        given("latitude", 0.0).alias("latitude"),
        given("longitude", 0.0).alias("longitude"),
        location.alias("location_id"),
    )
    return df.filter(severity_rank(severity) >= least_rank).select(
        F.lit("congestion").alias("type"),
        severity.alias("severity"),
        place.alias("location"),
        alert_message(severity, location).alias("message"),
        (at if at is not None else F.current_timestamp()).alias("timestamp"),
        recommendation(severity).alias("recommendation"),
    )


def _entries(*entries: tuple[Column, dict[str, str]]) -> Column:
    """The entries whose conditions hold, in order."""
    return F.array_compact(
        F.array(
            *[F.when(condition, F.struct(*[F.lit(v).alias(k) for k, v in fields.items()])) for condition, fields in entries]
        )
    )


def route_recommendations(df: DataFrame) -> DataFrame:
    """ALR-2: ``recommendations`` per route from ``congestion_level`` and ``priority``.

    A route without ``priority`` is meant to be the fastest.
    """
    names = set(df.columns)
    level = F.coalesce(F.col("congestion_level"), F.lit("none")) if "congestion_level" in names else F.lit("none")
    priority = F.coalesce(F.col("priority"), F.lit("fastest")) if "priority" in names else F.lit("fastest")
    advice = _entries(
        (
            level.isin("high", "severe"),
            {"type": "alternative_route", "message": "The usual road is crowded; others are open", "priority": "high"},
        ),
        (
            priority == "fastest",
            {"type": "route_optimization", "message": "Looking for the quickest way", "priority": "medium"},
        ),
    )
    return df.withColumn("recommendations", advice)


def travel_advisory(df: DataFrame) -> DataFrame:
    """ALR-3: ``alerts`` and ``recommendations`` per route from traffic, weather and travel time.

    Weather columns (``precipitation``, ``visibility``) are optional, as are their values.
    """
    names = set(df.columns)

    def given(name: str, default: object) -> Column:
        return F.coalesce(F.col(name), F.lit(default)) if name in names else F.lit(default)

    alerts = _entries(
        (
            given("congestion_level", "none").isin("high", "severe"),
            {"type": "congestion", "message": "Expect heavy traffic on the way"},
        ),
        (given("precipitation", 0.0) > 0, {"type": "weather", "message": "Rain: drive slower, keep more distance"}),
        (given("visibility", 10.0) < 5, {"type": "weather", "message": "Poor visibility: drive carefully"}),
    )
    advice = _entries(
        (given("travel_time_minutes", 0.0) > 60, {"type": "planning", "message": "Long trip: plan a break"}),
    )
    return df.select(
        given("route_id", "unknown").alias("route_id"),
        given("travel_time_minutes", 0.0).alias("travel_time_minutes"),
        given("distance_km", 0.0).alias("distance_km"),
        given("traffic_conditions", "unknown").alias("traffic_conditions"),
        alerts.alias("alerts"),
        advice.alias("recommendations"),
    )
