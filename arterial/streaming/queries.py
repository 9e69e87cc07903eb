"""Streaming queries: windows, alert feed, live stops (STM-1 to STM-9)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from arterial.operators.alerts import traffic_alerts
from arterial.operators.clean import ensure_timestamp, parse_payload
from arterial.operators.congestion import detect_congestion
from arterial.operators.windows import window_aggregate

WATERMARK = "10 minutes"  # fixed value
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
}


def process_stream(
    df: DataFrame, window: str = "5 minutes", slide: str | None = "1 minute", watermark: str = WATERMARK
) -> DataFrame:
    """PRJ-5, PRJ-4, then AGG-1; the same plan serves batch tables."""
    return window_aggregate(ensure_timestamp(parse_payload(df)), window, slide, watermark)


def alert_feed(
    df: DataFrame,
    window: str = "5 minutes",
    slide: str | None = "1 minute",
    threshold: str = "high",
    speed_limit: float | None = None,
) -> DataFrame:
    """STM-8: windowed averages, rated like single readings, as alerts with their window."""
    windows = process_stream(df, window, slide)
    rated = windows.withColumnsRenamed({"avg_speed": "speed", "avg_occupancy": "occupancy"})
    if speed_limit is not None:
        rated = rated.withColumn("speed_limit", F.lit(float(speed_limit)))
    rated = detect_congestion(rated).withColumn("severity", F.col("congestion_severity"))
    alerts = traffic_alerts(
        rated.withColumns({"latitude": F.lit(0.0), "longitude": F.lit(0.0)}), threshold, at=F.col("window_end")
    )
    return alerts.select(
        F.col("location.location_id").alias("location_id"), F.col("timestamp").alias("window_end"),
        "severity", "message", "recommendation",
    )


# -- live stops (STM-9)

STOP_SCHEMA = (
    "vehicle_id STRING, stop_start TIMESTAMP, stop_end TIMESTAMP, fixes BIGINT, stop_duration DOUBLE, "
    "is_significant_stop BOOLEAN"
)


def slow_runs(
    open_run: tuple[int, int, int] | None, us: np.ndarray, slow: np.ndarray, max_gap_us: float
) -> tuple[list[tuple[int, int, int]], tuple[int, int, int] | None]:
    """Runs of slow fixes, each (first, last, fixes), that ended, and the run still open.

    ``us`` are ascending times that follow the open run.
    """
    if len(us) == 0:
        return [], open_run
    cut = np.flatnonzero((slow[1:] != slow[:-1]) | (np.diff(us) > max_gap_us)) + 1
    starts, ends = np.concatenate(([0], cut)), np.concatenate((cut, [len(us)])) - 1
    keep = slow[starts]
    starts, ends = starts[keep], ends[keep]
    runs = list(zip(us[starts].tolist(), us[ends].tolist(), (ends - starts + 1).tolist()))
    if open_run is not None:
        if slow[0] and us[0] - open_run[1] <= max_gap_us:
            runs[0] = (open_run[0], runs[0][1], open_run[2] + runs[0][2])
        else:
            runs.insert(0, open_run)
    still_open = runs.pop() if slow[-1] else None
    return runs, still_open


class StopProcessor(StatefulProcessor):
    """Stops of a group of vehicles, each in event-time order.

    Fixes wait in the state until the watermark passes them, so the order of arrival does not matter;
    beside them the state holds the open run, three numbers however long it lasts. A run is emitted
    when a faster fix ends it, or after ``max_gap`` seconds of event time without a fix. What waits and what one
    micro-batch brings for a group is held in memory (9 bytes a fix): limit the input per trigger.
    Calls to the state cost more than the fixes of most vehicles do, so a group has one list: a row per vehicle, further
    rows where more than ``CHUNK`` of its fixes wait.
    """

    CHUNK = 10_000
    ROWS_PER_CALL = 1_000

    def __init__(self, speed_threshold: float, min_duration: float, max_gap: float):
        self.speed_threshold, self.min_duration, self.max_gap_us = speed_threshold, min_duration, max_gap * 1e6

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.vehicles = handle.getListState(
            "vehicles", "vehicle_id STRING, first_us BIGINT, last_us BIGINT, fixes BIGINT, us BINARY, slow BINARY"
        )

    def _advance(self, news: dict, watermark_ms: int) -> Iterator[pd.DataFrame]:
        """Take in waiting and new fixes up to the watermark and keep the others waiting."""
        runs, times, flags = {}, {}, {}
        for vehicle, first, last, fixes, us, slow in self.vehicles.get():
            if first is not None:
                runs[vehicle] = (first, last, fixes)
            times.setdefault(vehicle, []).append(np.frombuffer(us, dtype="int64"))
            flags.setdefault(vehicle, []).append(np.frombuffer(slow, dtype=bool))
        had = len(times) > 0
        for vehicle, (us, slow) in news.items():
            times.setdefault(vehicle, []).append(us)
            flags.setdefault(vehicle, []).append(slow)
        done, rows, timers = [], [], []
        for vehicle in times:
            us, slow = np.concatenate(times[vehicle]), np.concatenate(flags[vehicle])
            order = np.argsort(us, kind="stable")
            us, slow = us[order], slow[order]
            due = int(np.searchsorted(us // 1000, watermark_ms, side="right"))
            ended, run = slow_runs(runs.get(vehicle), us[:due], slow[:due], self.max_gap_us)
            if run is not None and run[1] + self.max_gap_us <= watermark_ms * 1000 and due == len(us):
                ended, run = [*ended, run], None
            done += [(vehicle, *stop) for stop in ended]
            us, slow = us[due:], slow[due:]
            for i in range(0, max(len(us), run is not None), self.CHUNK):
                chunk = us[i : i + self.CHUNK].tobytes(), slow[i : i + self.CHUNK].tobytes()
                rows.append((vehicle, *(run or (None, None, None)), *chunk))
            if len(us):
                timers.append(int(us[0]) // 1000)
            elif run is not None:
                timers.append(int(run[1] + self.max_gap_us) // 1000 + 1)
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        if rows:
            self.vehicles.put(rows[: self.ROWS_PER_CALL])
            for i in range(self.ROWS_PER_CALL, len(rows), self.ROWS_PER_CALL):
                self.vehicles.appendList(rows[i : i + self.ROWS_PER_CALL])
            self.handle.registerTimer(min(timers))
        elif had:
            self.vehicles.clear()
        if done:
            names, *numbers = zip(*done)
            first, last, fixes = (np.array(v, dtype="int64") for v in numbers)
            seconds = (last - first) / 1e6
            yield pd.DataFrame(
                {
                    "vehicle_id": names,
                    "stop_start": pd.to_datetime(first, unit="us"),
                    "stop_end": pd.to_datetime(last, unit="us"),
                    "fixes": fixes,
                    "stop_duration": seconds,
                    "is_significant_stop": seconds >= self.min_duration,
                }
            )

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        names, times, flags = [], [], []
        for batch in rows:
            names.append(batch["vehicle_id"])
            times.append(batch["us"].to_numpy("int64"))
            flags.append((batch["speed_kmh"] < self.speed_threshold).to_numpy(bool))
        us, slow = np.concatenate(times), np.concatenate(flags)
        codes, vehicles = pd.factorize(pd.concat(names))  # fixes without a vehicle have code -1
        order = np.argsort(codes, kind="stable")
        cuts = np.flatnonzero(np.diff(codes[order])) + 1
        news = {vehicles[codes[at[0]]] if codes[at[0]] >= 0 else None: (us[at], slow[at]) for at in np.split(order, cuts)}
        yield from self._advance(news, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._advance({}, timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def live_stops(
    df: DataFrame,
    speed_threshold: float = 5.0,
    min_duration: float = 60.0,
    max_gap: float = 1800.0,
    watermark: str = WATERMARK,
    groups: int = 1024,
) -> DataFrame:
    """STM-9: finished stops of a stream of ``(vehicle_id, timestamp, speed_kmh)`` fixes.

    Needs the RocksDB state store provider (:data:`STATE_STORE`). Vehicles share their state in ``groups`` groups; take
    more of them for more than some hundred million waiting fixes, and a new checkpoint with another number.
    """
    group = F.pmod(F.xxhash64("vehicle_id"), F.lit(groups)).cast("int").alias("_group")
    fixes = df.withWatermark("timestamp", watermark).select(
        group, "vehicle_id", "timestamp", F.unix_micros("timestamp").alias("us"), "speed_kmh"
    )
    return fixes.groupBy("_group").transformWithStateInPandas(
        statefulProcessor=StopProcessor(speed_threshold, min_duration, max_gap),
        outputStructType=STOP_SCHEMA,
        outputMode="Append",
        timeMode="EventTime",
    )
