"""GPS trajectories: speed, acceleration, stops (WIN-6 to WIN-9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from arterial.functions.geo import EARTH_RADIUS_M, haversine
from arterial.operators.features import seconds_between
from arterial.operators.ordering import ROWS_PER_TASK, OrderedRows


def _ordered(df, by, ts, tiebreak, rows_per_task) -> OrderedRows:
    ties = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
    return OrderedRows(df, by, [ts, *ties], rows_per_task)


def _speed(rows: DataFrame, w: WindowSpec, ts: str, align: str) -> DataFrame:
    leg = haversine(
        "latitude", "longitude", F.lead("latitude").over(w), F.lead("longitude").over(w), EARTH_RADIUS_M
    )
    if align == "reference":
        # the distance to the next fix over the time since the previous one
        elapsed = seconds_between(F.col(ts), F.lag(ts).over(w))
    else:
        elapsed = seconds_between(F.lead(ts).over(w), F.col(ts))
    rows = rows.withColumn("distance_meters", F.coalesce(leg, F.lit(0.0)))
    return rows.withColumn(
        "speed_kmh", F.coalesce(F.try_divide(F.col("distance_meters"), elapsed) * 3.6, F.lit(0.0))
    )


def gps_speed(
    df: DataFrame,
    by: Sequence[str] | str | None = "vehicle_id",
    ts: str = "timestamp",
    tiebreak: Sequence[str] | str = (),
    align: str = "leg",
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """WIN-6/7: ``distance_meters`` to the next fix and ``speed_kmh``.

    ``align="leg"`` divides the leg by its own duration; ``align="reference"`` divides it by the
    time since the previous fix. Unknown and undefined speeds are 0.
    """
    if align not in ("leg", "reference"):
        raise ValueError(f"align must be 'leg' or 'reference', not {align!r}")
    if not {"latitude", "longitude"} <= set(df.columns):
        return df
    ordered = _ordered(df, by, ts, tiebreak, rows_per_task)
    return ordered.rows(lambda rows, w: _speed(rows, w, ts, align), behind=1, ahead=1).result()


def gps_acceleration(
    df: DataFrame,
    by: Sequence[str] | str | None = "vehicle_id",
    ts: str = "timestamp",
    tiebreak: Sequence[str] | str = (),
    align: str = "leg",
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """WIN-8: ``acceleration`` in km/h per second, 0 for the first fix and for equal times."""
    derive = "speed_kmh" not in df.columns

    def build(rows: DataFrame, w: WindowSpec) -> DataFrame:
        if derive:
            rows = _speed(rows, w, ts, align)
        change = F.col("speed_kmh") - F.lag("speed_kmh").over(w)
        elapsed = seconds_between(F.col(ts), F.lag(ts).over(w))
        return rows.withColumn("acceleration", F.coalesce(F.try_divide(change, elapsed), F.lit(0.0)))

    return _ordered(df, by, ts, tiebreak, rows_per_task).rows(build, behind=2, ahead=1).result()


def detect_stops(
    df: DataFrame,
    speed_threshold: float = 5.0,
    min_duration: float = 60.0,
    by: Sequence[str] | str | None = "vehicle_id",
    ts: str = "timestamp",
    tiebreak: Sequence[str] | str = (),
    duration: str = "time",
    align: str = "leg",
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """WIN-9: ``is_stopped``, ``stop_duration`` of the run the row belongs to, ``is_significant_stop``.

    ``duration="time"`` measures a run by its first and last timestamps, ``duration="rows"`` counts
    a minute between rows. A run may be as long as the whole trajectory: its ends are carried along
    the rows, and no run is gathered.
    """
    if duration not in ("time", "rows"):
        raise ValueError(f"duration must be 'time' or 'rows', not {duration!r}")
    derive = "speed_kmh" not in df.columns

    def build(rows: DataFrame, w: WindowSpec) -> DataFrame:
        if derive:
            rows = _speed(rows, w, ts, align)
        rows = rows.withColumn("is_stopped", F.coalesce(F.col("speed_kmh") < speed_threshold, F.lit(False)))
        state = F.col("is_stopped")
        first = F.coalesce(F.lag("is_stopped").over(w) != state, F.lit(True))
        last = F.coalesce(F.lead("is_stopped").over(w) != state, F.lit(True))
        return rows.withColumns({"_first": first, "_last": last})

    ordered = _ordered(df, by, ts, tiebreak, rows_per_task)
    if duration == "rows":
        ordered = ordered.index("_mark")
    ordered = ordered.rows(build, behind=2, ahead=2)
    mark = F.col("_mark") if duration == "rows" else F.col(ts)
    ordered = ordered.carry_both({"_start": F.when(F.col("_first"), mark)}, {"_end": F.when(F.col("_last"), mark)})
    if duration == "rows":
        length = ((F.col("_end") - F.col("_start")) * 60).cast("double")
    else:
        length = seconds_between(F.col("_end"), F.col("_start"))
    out = ordered.result().withColumn(
        "stop_duration", F.when(F.col("is_stopped"), length).otherwise(F.lit(0.0))
    )
    return out.withColumn(
        "is_significant_stop", F.col("is_stopped") & (F.col("stop_duration") >= min_duration)
    ).drop("_first", "_last", "_start", "_end", "_mark")
