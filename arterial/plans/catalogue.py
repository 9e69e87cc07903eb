"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Names start with the operator id of the survey. Doubles are rounded to six places (fewer where the
values are large), so that engines that add in another order agree.
"""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arterial.functions import traffic
from arterial.functions.geo import EARTH_RADIUS_M, distance_from, haversine, select_locations, within_bounds
from arterial.functions.temporal import batch_features, temporal_features
from arterial.operators import (
    alerts, clean, congestion, features, forecast, joins, metrics, network, normalize, quality, quantiles, resample,
    sequences, signals, spatial, trajectory, windows,
)
from arterial.operators.bellman_ford import bellman_ford
from arterial.operators.ordering import OrderedRows
from arterial.plans import views
from arterial.session import pin, scratch_path
from arterial.sources import files, sinks
from arterial.streaming import queries as stream_queries
from arterial.streaming import sinks as stream_sinks
from arterial.streaming import sources as stream_sources

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 6, **other: int) -> DataFrame:
    """Round the double columns; ``other`` gives columns their own number of digits."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(c, other.get(c, digits)) for c in doubles})


def hundredths(array: str):
    """Numbers with two decimals as text, alike in every engine."""
    return F.array_join(F.transform(array, lambda v: F.round(v * 100).cast("long").cast("string")), ",")


# -- aggregates and congestion ---------------------------------------------------------------------


@query
def agg1_sliding(spark, sf):
    return rounded(windows.window_aggregate(views.readings(spark, sf)))


@query
def agg1_rollup(spark, sf):
    """By type, sensor and hour, and all of them rolled up from the right."""
    return rounded(windows.rollup_aggregate(views.readings(spark, sf), ["sensor_type", "sensor_id", "hour"]), 9)


@query
def agg1_tumbling(spark, sf):
    return rounded(windows.window_aggregate(views.readings(spark, sf), "1 hour", None))


@query
def agg2_hourly(spark, sf):
    return rounded(windows.mean_by_hour(views.readings(spark, sf)))


@query
def cng1_flags(spark, sf):
    flags = congestion.detect_congestion(views.readings(spark, sf))
    return rounded(
        flags.select("event_id", "speed_ratio", "congested_by_speed", "congested_by_occupancy", "is_congested", "congestion_severity")
    )


@query
def cng1_density(spark, sf):
    """With density, and the default limit because there is no limit column."""
    r = features.traffic_features(views.readings(spark, sf).drop("speed_limit"), tiebreak="event_id")
    flags = congestion.detect_congestion(r.drop("is_congested"))
    return rounded(flags.select("event_id", "speed_ratio", "congested_by_speed", "congested_by_density", "is_congested", "congestion_severity"))


@query
def top1_hotspots(spark, sf):
    flags = congestion.detect_congestion(views.readings(spark, sf)).withColumn("location_id", F.col("sensor_id"))
    return rounded(congestion.hotspots(flags, 10))


@query
def agg6_summary(spark, sf):
    return congestion.congestion_summary(congestion.detect_congestion(views.readings(spark, sf)))


def _latest(r: DataFrame) -> DataFrame:
    """The last reading of each sensor; the maximum is taken before the shuffle."""
    last = r.groupBy("sensor_id").agg(F.max_by(F.struct(*r.columns), F.struct("timestamp", "event_id")).alias("r"))
    return last.select("r.*").withColumn("location_id", F.col("sensor_id"))


def _predicted(spark, sf) -> DataFrame:
    current = _latest(views.readings(spark, sf))
    predictions = views.readings(spark, sf).groupBy(F.col("sensor_id").alias("location_id")).agg(F.avg("speed").alias("predicted_speed"))
    return congestion.predicted_congestion(current, predictions)


@query
def cng2_predicted(spark, sf):
    return rounded(_predicted(spark, sf))


@query
def cng2_summary(spark, sf):
    return congestion.congestion_summary(_predicted(spark, sf), "severity")


@query
def geo5_select(spark, sf):
    r = views.readings(spark, sf).withColumn("location_id", F.col("sensor_id"))
    chosen = select_locations(r, [f"S{i}" for i in range(1, 90, 2)], "40.72,-74.02,40.78,-73.96")
    return congestion.detect_congestion(chosen).select("event_id", "location_id", "congestion_severity")


# -- scalar features -------------------------------------------------------------------------------


@query
def dt8_temporal(spark, sf):
    return rounded(temporal_features(views.readings(spark, sf).select("event_id", "timestamp")).drop("timestamp"))


@query
def dt9_batch(spark, sf):
    return batch_features(views.readings(spark, sf).select("event_id", "timestamp"))


@query
def geo3_center(spark, sf):
    r = views.readings(spark, sf).drop("speed_limit")
    return rounded(
        features.spatial_features(r).select("event_id", "road_type", "num_lanes", "speed_limit", "distance_from_center")
    )


@query
def geo2_meters(spark, sf):
    r = views.readings(spark, sf)
    return r.select("event_id", F.round(haversine("latitude", "longitude", 40.75, -73.99, EARTH_RADIUS_M), 3).alias("meters"))


@query
def geo4_bbox(spark, sf):
    return within_bounds(views.readings(spark, sf), 40.72, 40.76, -74.0, -73.96).select("event_id", "latitude", "longitude")


@query
def trf_levels(spark, sf):
    r = views.readings(spark, sf)
    ratio = traffic.speed_ratio(F.col("speed"), F.col("speed_limit"))
    severity = traffic.severity_left(ratio)
    return rounded(
        r.select(
            "event_id", ratio.alias("speed_ratio"), traffic.level_right(ratio).alias("level"),
            severity.alias("severity"), traffic.severity_rank(severity).alias("severity_rank"),
            traffic.occupancy_normalized(F.col("occupancy")).alias("occupancy_normalized"),
            traffic.is_high_occupancy(F.col("occupancy")).alias("is_high_occupancy"),
            traffic.density(F.col("vehicle_count") * 60.0, F.col("speed")).alias("density"),
            traffic.travel_time_minutes(F.lit(2.5), F.col("speed") - 20).alias("minutes"),
        )
    )


# -- cleaning, validation, profile -----------------------------------------------------------------


@query
def cln1_travel(spark, sf):
    return clean.clean_travel_times(views.travel_times_raw(spark, sf)).drop("datetime")


@query
def cln2_sensor(spark, sf):
    return clean.clean_city_sensors(views.city_sensor_raw(spark, sf)).drop("created_date")


@query
def prj1_aliases(spark, sf):
    raw = views.readings(spark, sf).select(
        "event_id", F.col("latitude").cast("string").alias("lat"), F.col("longitude").cast("string").alias("lng"),
        F.when(F.col("event_id") % 2 == 0, F.col("timestamp").cast("string")).alias("time"),
        F.col("timestamp").cast("string").alias("datetime"),
    )
    return rounded(clean.clean_trajectory(raw))


def _payloads(spark, sf) -> DataFrame:
    r = views.readings(spark, sf)
    fields = [c for c in ("sensor_id", "timestamp", "latitude", "longitude", "speed", "vehicle_count", "occupancy")]
    broken = F.concat(F.lit("{broken "), F.col("event_id").cast("string"))
    body = F.to_json(F.struct(*fields))
    return r.select(F.when(F.col("event_id") % 19 == 0, broken).otherwise(body).alias("value"))


@query
def prj5_json(spark, sf):
    parsed = clean.parse_payload(_payloads(spark, sf), keep_corrupt=True)
    return rounded(parsed.withColumnRenamed("_corrupt", "payload"))


@query
def prj5_quarantine(spark, sf):
    good, bad = clean.split_corrupt(clean.parse_payload(_payloads(spark, sf), keep_corrupt=True))
    return good.agg(F.count("*").alias("n")).withColumn("part", F.lit("good")).unionByName(
        bad.agg(F.count("*").alias("n")).withColumn("part", F.lit("bad"))
    )


def _dubious(spark, sf) -> DataFrame:
    """City records whose time is missing or unreadable now and then."""
    raw = views.city_sensor_raw(spark, sf)
    text = F.when(F.col("event_id") % 31 == 0, F.lit("soon")).otherwise(F.col("created_date"))
    return raw.select("event_id", text.alias("timestamp"), "speed", F.col("occupancy").cast("double").alias("occupancy"))


@query
def val1_checks(spark, sf):
    return quality.validate_readings(_dubious(spark, sf), ["timestamp", "speed", "volume"]).select("check_name", "passed", "n_bad")


@query
def val2_range(spark, sf):
    checks = quality.validate_timestamp_range(
        views.readings(spark, sf), datetime(2024, 1, 5), datetime(2024, 1, 25), now=datetime(2024, 1, 20)
    )
    return checks.select("check_name", "passed", "n_bad")


@query
def val3_geo(spark, sf):
    return quality.validate_geographic_bounds(views.readings(spark, sf), 40.71, 40.79, -74.01, -73.95).select("check_name", "passed", "n_bad")


@query
def val4_quarantine(spark, sf):
    r = views.readings(spark, sf).withColumn("latitude", F.when(F.col("event_id") % 37 == 0, 95.0).otherwise(F.col("latitude")))
    good, bad = quality.quarantine(r, datetime(2024, 1, 5), datetime(2024, 1, 25), now=datetime(2024, 1, 20))
    return good.select("event_id", F.lit("").alias("errors")).unionByName(
        bad.select("event_id", F.array_join("errors", ",").alias("errors"))
    )


@query
def val4_stream(spark, sf):
    """The same rules on a stream that is stopped and started again: valid rows to one sink, the others to a second one."""
    good, bad = scratch_path(spark, "val4-good"), scratch_path(spark, "val4-bad")
    rules = {"min_ts": datetime(2024, 1, 5), "max_ts": datetime(2024, 1, 25), "now": datetime(2024, 1, 20)}
    for stream in _arriving(spark, sf, "val4-in", [F.col("event_id") % 2 == part for part in range(2)]):
        stream = stream.withColumn("latitude", F.when(F.col("event_id") % 37 == 0, 95.0).otherwise(F.col("latitude")))
        stream_sinks.write_validated(stream, good, bad, trigger=NOW, **rules).awaitTermination()
    return spark.read.parquet(good).select("event_id", F.lit("").alias("errors")).unionByName(
        spark.read.parquet(bad).select("event_id", F.array_join("errors", ",").alias("errors"))
    )


def _uncapped(spark, sf) -> DataFrame:
    """Readings with the raw measurement, which has a long tail."""
    raw = views.table(spark, sf, "events").select("event_id", "value")
    return raw.withColumn("occupancy", ((F.col("event_id") * 37) % 101).cast("double"))


@query
def out1_iqr(spark, sf):
    return quality.detect_outliers(_uncapped(spark, sf), ["value", "occupancy"]).select("event_id", "is_outlier")


@query
def out1_sketch(spark, sf):
    """Quantiles of three weeks from sketches per day, held against the ranks they should have."""
    readings = views.readings(spark, sf)
    sketches = pin(quality.daily_sketches(readings, ["speed", "occupancy"]))
    first, last, ranks = date(2024, 1, 5), date(2024, 1, 25), (0.25, 0.5, 0.75)
    found = quality.merged_quantiles(sketches, ranks, first, last).select("name", F.posexplode("quantiles").alias("at", "quantile"))
    found = found.select("name", F.array(*[F.lit(r) for r in ranks])[F.col("at")].alias("rank"), "quantile")
    days = readings.filter(F.to_date("timestamp").between(F.lit(first), F.lit(last)))
    values = days.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in ("speed", "occupancy")])).alias("p"))
    met = values.select("p.*").filter("value is not null").join(F.broadcast(found), "name").groupBy("name", "rank").agg(
        F.count("*").alias("n"), F.count_if(F.col("value") < F.col("quantile")).alias("below"), F.count_if(F.col("value") <= F.col("quantile")).alias("upto")
    )
    slack = quality.SKETCH_ERROR
    within = (F.col("below") / F.col("n") - slack <= F.col("rank")) & (F.col("rank") <= F.col("upto") / F.col("n") + slack)
    return met.select("name", "rank", "n", within.alias("within"))


@query
def out2_zscore(spark, sf):
    return quality.detect_outliers(_uncapped(spark, sf), ["value", "occupancy"], "zscore").select("event_id", "is_outlier")


@query
def out3_removed(spark, sf):
    return quality.remove_outliers(_uncapped(spark, sf), ["value"]).select("event_id", "value")


@query
def qlt1_missing(spark, sf):
    return rounded(quality.missing_report(views.readings(spark, sf)))


@query
def qlt2_types(spark, sf):
    return quality.type_report(views.readings(spark, sf))


@query
def qlt3_profile(spark, sf):
    return rounded(quality.numeric_profile(views.readings(spark, sf), ["speed", "occupancy", "vehicle_count", "latitude"]))


@query
def qlt4_extent(spark, sf):
    return rounded(quality.timestamp_extent(views.readings(spark, sf)))


@query
def set1_union(spark, sf):
    r = views.readings(spark, sf)
    kept = {
        "loop_detector": ["event_id", "sensor_id", "speed", "occupancy", "lane"],
        "camera": ["event_id", "sensor_id", "vehicle_count", "latitude", "longitude"],
        "radar": ["event_id", "sensor_id", "speed"],
    }
    frames = [r.filter(F.col("sensor_type") == t).select(*c).withColumn("sensor_type", F.lit(t)) for t, c in kept.items()]
    return rounded(files.union_all(frames))


@query
def flt1_range(spark, sf):
    return files.time_range(views.readings(spark, sf), datetime(2024, 1, 10), datetime(2024, 1, 12)).select("event_id", "timestamp")


@query
def cln3_filled(spark, sf):
    return clean.fill_missing(views.readings(spark, sf), ["occupancy", "vehicle_count"]).select("event_id", "occupancy", "vehicle_count")


# -- windows ---------------------------------------------------------------------------------------


@query
def win1_flow(spark, sf):
    r = views.readings(spark, sf).select("event_id", "sensor_id", "timestamp", "vehicle_count")
    return rounded(features.traffic_features(r, tiebreak="event_id").select("event_id", "flow_rate"), 3)


@query
def win2_rolling(spark, sf):
    r = views.readings(spark, sf).select("event_id", "sensor_id", "timestamp", "speed", "occupancy")
    out = features.traffic_features(r, tiebreak="event_id")
    return rounded(out.select("event_id", *[f"{c}_rolling_{s}" for c in ("speed", "occupancy") for s in ("mean_5", "std_5", "mean_10")]))


@query
def win2_training(spark, sf):
    """Rolling columns that end one row before the reading."""
    r = views.readings(spark, sf).select("event_id", "sensor_id", "timestamp", "speed")
    out = features.traffic_features(r, tiebreak="event_id", exclude_current=True)
    return rounded(out.select("event_id", "speed_rolling_mean_5", "speed_rolling_std_5", "speed_rolling_mean_10"))


@query
def win4_traffic(spark, sf):
    out = features.traffic_features(views.readings(spark, sf), tiebreak="event_id")
    return rounded(
        out.select(
            "event_id", "flow_rate", "density", "speed_ratio", "is_congested", "congestion_level", "occupancy_normalized",
            "is_high_occupancy", "speed_rolling_mean_5", "vehicle_count_rolling_mean_10", "flow_rate_rolling_mean_5",
            "occupancy_rolling_std_5",
        ),
        flow_rate=3, density=3, flow_rate_rolling_mean_5=3,
    )


@query
def win4_global(spark, sf):
    """The whole table as one series, as the reference orders it."""
    out = features.traffic_features(views.readings(spark, sf), by=None, tiebreak="event_id")
    return rounded(out.select("event_id", "flow_rate", "speed_rolling_mean_5", "speed_rolling_mean_10"), flow_rate=3)


@query
def win5_lags(spark, sf):
    out = features.lag_features(views.readings(spark, sf), ["speed", "vehicle_count"], tiebreak="event_id")
    return out.select("event_id", *[f"{c}_lag_{k}" for c in ("speed", "vehicle_count") for k in features.LAGS])


@query
def win7_speed(spark, sf):
    out = trajectory.gps_speed(views.gps_points(spark, sf), tiebreak="event_id")
    return rounded(out.select("event_id", "distance_meters", "speed_kmh"), 4)


@query
def win7_speed_reference(spark, sf):
    out = trajectory.gps_speed(views.gps_points(spark, sf), tiebreak="event_id", align="reference")
    return rounded(out.select("event_id", "distance_meters", "speed_kmh"), 4)


@query
def win8_accel(spark, sf):
    out = trajectory.gps_acceleration(views.gps_points(spark, sf), tiebreak="event_id")
    return rounded(out.select("event_id", "acceleration"), 4)


@query
def win9_stops(spark, sf):
    out = trajectory.detect_stops(views.gps_points(spark, sf), tiebreak="event_id")
    return rounded(out.select("event_id", "is_stopped", "stop_duration", "is_significant_stop"), 4)


@query
def win9_stops_rows(spark, sf):
    out = trajectory.detect_stops(views.gps_points(spark, sf), tiebreak="event_id", duration="rows", align="reference")
    return rounded(out.select("event_id", "is_stopped", "stop_duration", "is_significant_stop"))


@query
def win10_sequences(spark, sf):
    out = sequences.with_sequences(views.readings(spark, sf), ["speed"], "speed", 10, tiebreak="event_id")
    flat = out.withColumn("x", F.flatten("x"))
    return flat.select("event_id", "y", hundredths("x").alias("x"))


@query
def win10_blocks(spark, sf):
    """The samples of stored blocks."""
    blocks = sequences.sequence_blocks(views.readings(spark, sf), ["speed"], "speed", 10, 32, tiebreak="event_id")
    out = sequences.samples(pin(blocks), 10, 32)
    return out.withColumn("x", F.flatten("x")).select("event_id", "y", hundredths("x").alias("x"))


@query
def win11_blocks(spark, sf):
    out = sequences.block_sequences(views.readings(spark, sf), ["speed"], "speed", 10, tiebreak="event_id")
    flat = out.withColumn("x", F.flatten("x"))
    return flat.select("sensor_id", "block", "y", hundredths("x").alias("x"))


@query
def win12_split(spark, sf):
    return sequences.chronological_split(views.readings(spark, sf)).select("event_id", "split")


@query
def srt1_index(spark, sf):
    """Position of each reading in time over the whole table."""
    out = OrderedRows(views.readings(spark, sf).select("event_id", "timestamp"), None, ["timestamp", "event_id"]).index().result()
    return clean.in_time_order(out, tiebreak=["event_id"]).select("event_id", "row_index")


@query
def win12_by_key(spark, sf):
    return sequences.split_by_key(views.readings(spark, sf), tiebreak="event_id").select("event_id", "split")


@query
def rsm1_resample(spark, sf):
    return rounded(resample.resample(views.readings(spark, sf), "1 hour", "sensor_id", columns=["speed", "occupancy"]))


def _hourly(spark, sf) -> DataFrame:
    return resample.resample(views.readings(spark, sf), "1 hour", "sensor_id", columns=["speed"])


@query
def rsm2_fill(spark, sf):
    points = resample.grid_size(views.readings(spark, sf), "1 hour", "sensor_id")
    return rounded(resample.fill_gaps(_hourly(spark, sf), ["speed"], "interpolate", "sensor_id", counts=points), 9)


@query
def rsm2_forward(spark, sf):
    r = views.readings(spark, sf).select("event_id", "sensor_id", "timestamp", "occupancy")
    return resample.fill_gaps(r, ["occupancy"], "forward_fill", "sensor_id", tiebreak="event_id").select("event_id", "occupancy")


@query
def rsm2_backward(spark, sf):
    r = views.readings(spark, sf).select("event_id", "sensor_id", "timestamp", "occupancy")
    return resample.fill_gaps(r, ["occupancy"], "backward_fill", "sensor_id", tiebreak="event_id").select("event_id", "occupancy")


@query
def rsm2_drop(spark, sf):
    return resample.fill_gaps(views.readings(spark, sf), ["occupancy"], "drop").select("event_id", "occupancy")


# -- normalisation and metrics ---------------------------------------------------------------------

SCALED = ["speed", "occupancy", "vehicle_count"]


def _normalized(method):
    def run(spark, sf):
        scaled, _ = normalize.normalize(views.readings(spark, sf), SCALED, method)
        return rounded(scaled.select("event_id", *SCALED))

    return run


QUERIES["nrm1_minmax"] = _normalized("min_max")
QUERIES["nrm2_standard"] = _normalized("standard")
QUERIES["nrm3_robust"] = _normalized("robust")


@query
def agg3_fit(spark, sf):
    r = views.readings(spark, sf)
    stats = [normalize.fit_normalizer(r, SCALED, m) for m in normalize.METHODS]
    return rounded(files.union_all(stats))


@query
def nrm4_constant(spark, sf):
    """A column without spread: 0 when fitting, unchanged when only transforming."""
    r = views.readings(spark, sf).withColumn("flat", F.lit(7.0))
    stats = normalize.fit_normalizer(r, ["flat"])
    zero = normalize.apply_normalizer(r, stats).select("event_id", F.col("flat").alias("fitted"))
    kept = normalize.apply_normalizer(r, stats, "keep").select("event_id", F.col("flat").alias("transformed"))
    return zero.join(kept, "event_id")


@query
def nrm5_defaults(spark, sf):
    """Default columns: calendar numbers are not scaled."""
    r = temporal_features(views.readings(spark, sf)).select("event_id", "sensor_id", "hour", "month", "speed", "hour_sin")
    r = r.withColumn("id", F.col("event_id").cast("string"))
    scaled, _ = normalize.normalize(r)
    return rounded(scaled.select("id", "event_id", "hour", "month", "speed", "hour_sin"))


@query
def nrm6_transform(spark, sf):
    """Statistics of the loop detectors, stored, read back and applied to all readings."""
    r = views.readings(spark, sf)
    path = scratch_path(spark, "stats")
    normalize.fit_normalizer(r.filter("sensor_type = 'loop_detector'"), SCALED, "standard").write.parquet(path)
    return rounded(normalize.apply_normalizer(r, spark.read.parquet(path)).select("event_id", *SCALED))


@query
def agg4_metrics(spark, sf):
    return rounded(metrics.error_metrics(views.forecasts(spark, sf)), 4)


@query
def agg4_by_sensor(spark, sf):
    return rounded(metrics.error_metrics(views.forecasts(spark, sf), by="sensor_id"), 4)


def _history(spark, sf) -> DataFrame:
    per = metrics.error_metrics(views.forecasts(spark, sf), by="sensor_id")
    return metrics.metric_rows(per, F.lit("run"), F.ascii("sensor_id"))


@query
def agg5_history(spark, sf):
    history = _history(spark, sf)
    average = metrics.average_metrics(history).withColumn("kind", F.lit("average"))
    return rounded(average.unionByName(metrics.latest_metrics(history).withColumn("kind", F.lit("latest"))), 4)


@query
def agg5_store(spark, sf):
    """Three appends, the second of them repeated, then a new run with one."""
    store = metrics.MetricStore(spark, scratch_path(spark, "metrics"))
    of = lambda sensor: metrics.error_metrics(views.forecasts(spark, sf).filter(F.col("sensor_id") == sensor))
    for sensor, attempt in (("A", "first"), ("N", "second"), ("N", "second"), ("R", "third")):
        store.append(of(sensor), attempt)
    store.reset()
    store.append(of("A"), "first")
    parts = [store.average(0).withColumn("kind", F.lit("average")), store.latest(0).withColumn("kind", F.lit("latest")),
             store.average().withColumn("kind", F.lit("average"))]
    counts = store.history(0).unionByName(store.history()).groupBy("run_id").agg(F.countDistinct("seq").alias("updates"))
    return rounded(files.union_all(parts).join(counts, "run_id"), 4)


@query
def str3_summary(spark, sf):
    return metrics.metrics_summary(metrics.average_metrics(_history(spark, sf)))


# -- alerts and signals ----------------------------------------------------------------------------


def _rated(spark, sf) -> DataFrame:
    rated = congestion.detect_congestion(views.readings(spark, sf))
    return rated.withColumns({"location_id": F.col("sensor_id"), "severity": F.col("congestion_severity")})


@query
def alr1_alerts(spark, sf):
    rated = _rated(spark, sf)
    out = alerts.traffic_alerts(rated.withColumn("location_id", F.concat("location_id", F.lit("/"), "event_id")), at=clean.moment(datetime(2024, 2, 1)))
    return rounded(
        out.select("type", "severity", "location.location_id", "location.latitude", "location.longitude", "message", "timestamp", "recommendation")
    )


@query
def alr1_threshold(spark, sf):
    """An unknown threshold means medium."""
    return alerts.traffic_alerts(_rated(spark, sf), "whatever").groupBy("severity").agg(F.count("*").alias("n"))


@query
def alr2_recommend(spark, sf):
    priority = F.when(F.col("event_id") % 3 == 0, "shortest").when(F.col("event_id") % 3 == 1, "fastest")
    routes = _rated(spark, sf).select("event_id", F.col("severity").alias("congestion_level"), priority.alias("priority"))
    out = alerts.route_recommendations(routes)
    return out.select(
        "event_id",
        F.array_join(F.transform("recommendations", lambda r: F.concat(r["type"], F.lit(":"), r["priority"])), ",").alias("recommendations"),
    )


@query
def alr3_advisory(spark, sf):
    routes = _rated(spark, sf).select(
        "event_id", F.col("event_id").cast("string").alias("route_id"), F.col("severity").alias("congestion_level"),
        F.col("speed").alias("travel_time_minutes"), (F.col("speed") / 2).alias("distance_km"),
    )
    observed = views.weather(spark, sf).select("event_id", "precipitation", "visibility")
    out = alerts.travel_advisory(routes.join(observed, "event_id", "left"))
    return rounded(
        out.select(
            "route_id", "travel_time_minutes", "distance_km", "traffic_conditions",
            F.array_join(F.transform("alerts", lambda a: a["message"]), ";").alias("alerts"),
            F.array_join(F.transform("recommendations", lambda a: a["type"]), ";").alias("recommendations"),
        )
    )


@query
def sig1_timing(spark, sf):
    flows = views.intersection_flow(spark, sf).withColumn("has_timing", F.col("intersection_id") % 2 == 0)
    return signals.timing_rows(signals.signal_timing(flows))


def _patchy_flow(spark, sf) -> DataFrame:
    """Flows that are missing at some approaches, and some rows without an approach."""
    flow = F.when((F.col("intersection_id") % 7 == 0) & (F.col("approach") == "north"), F.lit(None)).otherwise(F.col("flow"))
    approach = F.when((F.col("intersection_id") % 11 == 0) & (F.col("approach") == "south"), F.lit(None)).otherwise(F.col("approach"))
    return views.intersection_flow(spark, sf).select("intersection_id", approach.alias("approach"), flow.alias("flow"))


@query
def sig1_missing(spark, sf):
    flows = _patchy_flow(spark, sf).withColumn("has_timing", F.col("intersection_id") % 2 == 0)
    return signals.timing_rows(signals.signal_timing(flows))


@query
def sig3_missing(spark, sf):
    """From maps with missing flows, empty maps and missing maps."""
    named = _patchy_flow(spark, sf).filter("approach is not null")
    maps = named.groupBy("intersection_id").agg(F.map_from_entries(F.collect_list(F.struct("approach", "flow"))).alias("traffic_flows"))
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>"))
    holes = F.when(F.col("intersection_id") % 13 == 0, F.lit(None)).when(F.col("intersection_id") % 17 == 0, none).otherwise(F.col("traffic_flows"))
    return signals.timing_rows(signals.signal_timing(signals.explode_flows(maps.withColumn("traffic_flows", holes))))


@query
def sig2_default(spark, sf):
    timings = signals.signal_timing(views.intersection_flow(spark, sf))
    return signals.timing_rows(timings.filter("recommendation = 'maintain'"))


@query
def sig3_maps(spark, sf):
    """From one map of flows per intersection, as a signal request carries them."""
    maps = views.intersection_flow(spark, sf).groupBy("intersection_id").agg(
        F.map_from_entries(F.collect_list(F.struct("approach", "flow"))).alias("traffic_flows")
    )
    timings = signals.signal_timing(signals.explode_flows(maps))
    north = F.col("timing")["north"]
    return timings.select(
        "intersection_id", "cycle_time", "recommendation", north["green"].alias("north_green"), F.size("timing").alias("approaches")
    )


@query
def sig4_delay(spark, sf):
    timings = signals.signal_timing(views.intersection_flow(spark, sf))
    cycles = timings.select(
        "intersection_id", (F.lit(80) + F.col("intersection_id") % 41).alias("current_cycle_time"),
        F.col("cycle_time").alias("optimized_cycle_time"),
    )
    return rounded(signals.delay_reduction(cycles))


@query
def agg7_flows(spark, sf):
    return rounded(signals.flow_totals(views.intersection_flow(spark, sf)))


# -- space and graphs ------------------------------------------------------------------------------


@query
def jon3_nearest(spark, sf):
    points = views.readings(spark, sf).select("event_id", "latitude", "longitude")
    found = spatial.nearest_node(points, views.road_nodes(spark, sf), "event_id")
    return found.select("event_id", "node_id", F.round("distance_m", 3).alias("distance_m"))


@query
def jon4_knn(spark, sf):
    return rounded(spatial.knn_graph(views.road_nodes(spark, sf)), 3)


def _with_unknown_ends(spark, sf) -> DataFrame:
    """Edges, every seventh of which leads to a node that does not exist."""
    edges = views.road_edges(spark, sf)
    return edges.withColumn("dst", F.when((F.col("src") + F.col("dst")) % 7 == 0, -F.col("dst")).otherwise(F.col("dst")))


@query
def grf1_build(spark, sf):
    return network.known_edges(_with_unknown_ends(spark, sf), views.road_nodes(spark, sf)).select("src", "dst", "weight")


@query
def agg8_counts(spark, sf):
    return network.graph_counts(views.road_nodes(spark, sf), _with_unknown_ends(spark, sf))


def _pairs(spark, sf) -> DataFrame:
    """Every node to the node two rows on; those of the last rows do not exist."""
    nodes = views.road_nodes(spark, sf)
    return nodes.select(F.col("id").alias("src"), (F.col("id") + 100).alias("dst"))


@query
def grf2_paths(spark, sf):
    found = network.shortest_paths(views.road_edges(spark, sf), _pairs(spark, sf), with_path=False)
    return found.select("src", "dst", "success", "cost")


@query
def grf2_directed(spark, sf):
    """The same search, directed by the places of the nodes."""
    found = network.shortest_paths(views.road_edges(spark, sf), _pairs(spark, sf), with_path=False, nodes=views.road_nodes(spark, sf))
    return found.select("src", "dst", "success", "cost")


@query
def grf2_landmarks(spark, sf):
    """The same search, directed by costs from and to the first and the last node."""
    edges = pin(views.road_edges(spark, sf))
    corners = views.road_nodes(spark, sf).agg(F.min("id"), F.max("id")).first()
    table = pin(network.landmark_table(edges, list(corners), reach=4))
    found = network.shortest_paths(edges, _pairs(spark, sf), with_path=False, landmarks=table)
    return found.select("src", "dst", "success", "cost")


@query
def grf3_walks(spark, sf):
    """Paths of the two-row trips, checked against the edges: costs along the path."""
    edges = views.road_edges(spark, sf)
    found = pin(network.shortest_paths(edges, _pairs(spark, sf)))
    hops = found.select("src", "dst", F.posexplode("path").alias("pos", "node"))
    w = W.partitionBy("src", "dst").orderBy("pos")
    steps = hops.select(
        F.col("src").alias("from"), F.col("dst").alias("to"), F.col("node").alias("dst"), F.lag("node").over(w).alias("src")
    )
    along = steps.filter("src is not null").join(edges, ["src", "dst"], "left").groupBy("from", "to").agg(F.sum("weight").alias("path_cost"))
    checked = found.join(along.withColumnsRenamed({"from": "src", "to": "dst"}), ["src", "dst"], "left")
    ends = (F.element_at("path", 1) == F.col("src")) & (F.element_at("path", -1) == F.col("dst"))
    return checked.select("src", "dst", "success", F.when(ends, F.col("path_cost")).alias("path_cost"))


def _length(coordinates: str) -> Column:
    """Kilometres along a list of places."""
    legs = F.zip_with(
        F.slice(coordinates, 1, F.size(coordinates) - 1), F.slice(coordinates, 2, F.size(coordinates) - 1),
        lambda a, b: haversine(a["latitude"], a["longitude"], b["latitude"], b["longitude"]),
    )
    return F.when(F.size(coordinates) > 1, F.aggregate(legs, F.lit(0.0), lambda total, leg: total + leg)).otherwise(0.0)


@query
def grf4_routes(spark, sf):
    routes = network.find_routes(views.requests(spark, sf), views.road_nodes(spark, sf), views.road_edges(spark, sf))
    return routes.select(
        "request_id", "success", "algorithm", F.element_at("path", 1).alias("src"), F.element_at("path", -1).alias("dst"), "cost",
        (F.size("coordinates") == F.col("num_segments") + 1).alias("complete"),
        # paths of equal cost differ, so what is compared of the shape are its ends and whether its legs add up
        F.round(F.element_at("coordinates", 1)["latitude"], 6).alias("from_latitude"), F.round(F.element_at("coordinates", -1)["longitude"], 6).alias("to_longitude"),
        (F.abs(F.col("distance_km") - _length("coordinates")) < 1e-6).alias("measured"),
    )


@query
def agg9_distance(spark, sf):
    """Length of given node paths: along each row of the grid for three segments."""
    nodes = views.road_nodes(spark, sf)
    paths = nodes.select(
        F.col("id").alias("src"), F.sequence(F.col("id"), F.col("id") + 150, F.lit(50)).alias("path")
    ).join(nodes.select((F.col("id") - 150).alias("src")), "src", "left_semi")
    out = network.route_geometry(paths, nodes, ["src"])
    return rounded(out.select("src", "distance_km", "num_segments"))


@query
def grf5_traffic(spark, sf):
    """Edge weights in minutes at the mean speed measured at the start node."""
    r = views.readings(spark, sf)
    speeds = r.groupBy(F.substring("sensor_id", 2, 20).cast("long").alias("id")).agg(F.avg("speed").alias("avg_speed"))
    return rounded(network.traffic_weights(views.road_edges(spark, sf), speeds, views.road_nodes(spark, sf)))


@query
def grf5_negative(spark, sf):
    """Bellman-Ford on the roads with a height at each node: climbing costs, driving down earns."""
    height = lambda c: (F.col(c) * 13 % 7).cast("double")
    edges = views.road_edges(spark, sf).withColumn("weight", F.col("weight") + height("dst") - height("src"))
    routes, _ = bellman_ford(edges, _pairs(spark, sf), max_rounds=11)  # no way of two rows takes more segments than it costs
    return routes.select("src", "dst", "success", "cost", "negative_cycle")


def _loops(spark, sf) -> tuple[DataFrame, DataFrame]:
    """A ring of three segments per nation with a way in, a way out and a way past it; every other ring is negative."""
    base = (F.col("n_nationkey") * 10).cast("long")
    closing = F.when(F.col("n_nationkey") % 2 == 0, -3.0).otherwise(-2.0)
    arcs = [(0, 1, F.lit(1.0)), (1, 2, F.lit(1.0)), (2, 3, F.lit(1.0)), (3, 1, closing), (2, 4, F.lit(2.0)), (0, 5, F.lit(1.0))]
    parts = F.array(*[F.struct((base + a).alias("src"), (base + b).alias("dst"), w.alias("weight")) for a, b, w in arcs])
    ends = F.array(*[F.struct((base + a).alias("src"), (base + b).alias("dst")) for a, b in ((0, 4), (0, 5), (4, 0))])
    nations = views.table(spark, sf, "nation")
    return nations.select(F.explode(parts).alias("e")).select("e.*"), nations.select(F.explode(ends).alias("e")).select("e.*")


@query
def grf5_cycle_routes(spark, sf):
    routes, _ = bellman_ford(*_loops(spark, sf))
    return routes


@query
def grf5_cycles(spark, sf):
    _, cycles = bellman_ford(*_loops(spark, sf))
    return cycles.withColumn("nodes", F.array_join(F.col("nodes").cast("array<string>"), ","))


def _balances(spark, sf) -> DataFrame:
    return views.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), "c_acctbal", "c_nationkey")


@query
def grf6_propagate(spark, sf):
    return rounded(network.propagate(views.road_edges(spark, sf), _balances(spark, sf), ["c_acctbal"], hops=2), 4)


@query
def grf6_pool(spark, sf):
    h = network.propagate(views.road_edges(spark, sf), _balances(spark, sf), ["c_acctbal"])
    graphs = _balances(spark, sf).select("id", "c_nationkey")
    return rounded(network.pool_features(h.join(graphs, "id"), ["c_acctbal"], "c_nationkey"), 4)


@query
def grf7_traveltime(spark, sf):
    out = network.travel_times(views.requests(spark, sf))
    return rounded(out.select("request_id", "distance_km", "travel_time_minutes"))


@query
def jon9_asof(spark, sf):
    r = views.readings(spark, sf).select("event_id", "timestamp", "sensor_id")
    out = joins.asof_join(r, views.weather(spark, sf), None, values=["precipitation", "visibility"], tiebreak="event_id")
    return rounded(out.select("event_id", "timestamp_right", "precipitation", "visibility"))


@query
def jon9_asof_by(spark, sf):
    """As-of join per sensor type."""
    r = views.readings(spark, sf).select("event_id", "timestamp", "sensor_type")
    seen = views.readings(spark, sf).filter("occupancy is not null").select("event_id", "timestamp", "sensor_type", "occupancy")
    out = joins.asof_join(r, seen, "sensor_type", tiebreak="event_id")
    return out.select("event_id", "occupancy", "timestamp_right")


@query
def jon9_holiday(spark, sf):
    holidays = views.table(spark, sf, "orders").select(F.make_date(F.lit(2024), F.lit(1), F.dayofmonth("o_orderdate")).alias("date"))
    odd = holidays.distinct().filter(F.dayofmonth("date") % 3 == 0)
    return joins.holiday_flag(views.readings(spark, sf), odd).select("event_id", "is_holiday")


# -- forecasting -----------------------------------------------------------------------------------


@query
def ml1_training_set(spark, sf):
    r = views.readings(spark, sf).drop("speed_limit", "sensor_type", "lane")
    out, names, _ = forecast.training_set(r)
    return rounded(out.select("event_id", "speed", *names))


@query
def ml3_ensemble(spark, sf):
    f = views.forecasts(spark, sf)
    three = f.select(
        "l_orderkey", "l_linenumber", (F.col("y_pred") * 0.9).alias("lstm"),
        F.when(F.col("l_linenumber") != 3, F.col("y_pred")).alias("cnn_lstm"), (F.col("y_pred") * 1.1).alias("gnn"),
    )
    out = forecast.ensemble(three, forecast.ENSEMBLE_WEIGHTS)
    return rounded(out.select("l_orderkey", "l_linenumber", "prediction"), 8)


@query
def ml6_targets(spark, sf):
    return rounded(forecast.horizon_targets(views.readings(spark, sf), grid="15 minutes"))


@query
def ml8_vote(spark, sf):
    r = views.readings(spark, sf)
    ratio = traffic.speed_ratio(F.col("speed"), F.col("speed_limit"))
    votes = r.select(
        "event_id", traffic.severity_left(ratio).alias("a"), traffic.severity_left(ratio * 1.3).alias("b"),
        traffic.severity_left(F.col("occupancy") / 100).alias("c"),
    )
    return forecast.majority_vote(votes, ["a", "b", "c"]).select("event_id", "vote")


@query
def ml8_accuracy(spark, sf):
    r = views.readings(spark, sf)
    ratio = traffic.speed_ratio(F.col("speed"), F.col("speed_limit"))
    both = r.select(traffic.severity_left(ratio).alias("truth"), traffic.severity_left(ratio * 1.3).alias("guess"))
    return rounded(forecast.accuracy(both, "truth", "guess"))


@query
def ml8_folds(spark, sf):
    return forecast.time_folds(views.readings(spark, sf)).select("event_id", "fold")


def _simple(spark, sf):
    """Speed against occupancy: a model that SQL can fit too, split in time."""
    r = views.readings(spark, sf).filter("speed is not null and occupancy is not null")
    return pin(sequences.chronological_split(r.select("event_id", "timestamp", "sensor_type", "speed", "occupancy")))


@query
def ml5_predict(spark, sf):
    """ML-2, ML-5, ML-7: train on the first 80 % in time, store, load, predict the rest."""
    table, names = _simple(spark, sf), ["occupancy"]
    path = scratch_path(spark, "model")
    forecast.save_model(forecast.train(table.filter("split = 'train'"), names, regularization=0.0), path)
    later = table.filter("split = 'validation'")
    return rounded(forecast.predict(forecast.load_model(path), later, names).select("event_id", "speed", "prediction"), 4)


@query
def ml4_evaluate(spark, sf):
    """ML-4 per sensor type, on rows the model has not seen."""
    table, names = _simple(spark, sf), ["occupancy"]
    model = forecast.train(table.filter("split = 'train'"), names, regularization=0.0)
    predicted = forecast.predict(model, table.filter("split = 'validation'"), names)
    return rounded(forecast.evaluate(predicted, by="sensor_type").select("sensor_type", "mae", "rmse", "r2"), 4)


def _shaped(spark, sf) -> DataFrame:
    """Readings whose speed follows the hour and the occupancy, so that there is something to learn."""
    r = views.readings(spark, sf).drop("sensor_type").filter("occupancy is not null")
    wave = F.sin(F.lit(2.0) * F.pi() * F.hour("timestamp") / 24.0)
    return r.withColumn("speed", F.lit(50.0) + 10.0 * wave - 0.2 * F.col("occupancy"))


@query
def ml2_forecasters(spark, sf):
    """ML-1 to ML-4: both kinds of forecaster on all features, scaled by the training part, row by row and against the mean."""
    table, names, _ = forecast.training_set(_shaped(spark, sf), lags=(1, 2, 3), holdout=0.2)
    table = pin(table)
    known, later = table.filter("split = 'train'"), table.filter("split = 'validation'")
    out = later.withColumn("mean", F.lit(known.agg(F.avg("speed")).first()[0]))
    for kind in ("linear", "gbt"):
        out = forecast.predict(forecast.train(known, names, kind=kind), out, names, kind)
    out = pin(out.select("event_id", "speed", "mean", "linear", "gbt"))
    rmse = lambda c: F.sqrt(F.avg((F.col("speed") - F.col(c)) ** 2))
    linear, gbt, mean = out.agg(rmse("linear"), rmse("gbt"), rmse("mean")).first()
    near = F.abs(F.col("linear") - F.col("speed")) < 0.5  # the speed is linear in two of the features
    return out.select(
        "event_id", F.round("speed", 4).alias("speed"), near.alias("linear_near"), F.lit(linear < mean).alias("linear_better"),
        F.lit(2 * gbt < mean).alias("gbt_halves"),
    )


@query
def ml5_outside(spark, sf):
    """ML-5: a model from elsewhere, loaded once per task, scores batches of features."""
    def load():
        return lambda features: 2.0 * features["speed"].to_numpy() - features["vehicle_count"].to_numpy()

    r = views.readings(spark, sf).select("event_id", "speed", "vehicle_count")
    return rounded(forecast.score_with(r, ["speed", "vehicle_count"], load))


@query
def prj4_processing_time(spark, sf):
    """Rows without a time get the current one; rows with one keep it."""
    r = views.readings(spark, sf).select("event_id", "timestamp")
    now = clean.ensure_timestamp(r.drop("timestamp"))
    fresh = now.select("event_id", (F.abs(F.unix_seconds("timestamp") - F.unix_seconds(F.current_timestamp())) < 3600).alias("fresh"))
    kept = clean.ensure_timestamp(r.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")))
    return fresh.join(kept, "event_id")


@query
def ml6_horizons(spark, sf):
    """ML-6: one model per horizon on bucket means of the first 80 % in time, for the rest."""
    targets = forecast.horizon_targets(views.readings(spark, sf), grid="15 minutes").filter("speed is not null")
    targets = pin(sequences.chronological_split(pin(targets), tiebreak="sensor_id"))
    models = forecast.train_horizons(targets.filter("split = 'train'"), ["speed"], regularization=0.0)
    out = forecast.predict_horizons(models, targets.filter("split = 'validation'"), ["speed"])
    return rounded(out.select("sensor_id", "timestamp", *[f"predicted_in_{h}" for h in forecast.HORIZONS]), 4)


@query
def ml8_cross_validation(spark, sf):
    """ML-8: mean error over five folds in time for two regularizations, and which of them wins."""
    folds = pin(forecast.time_folds(_simple(spark, sf)))
    tried = (0.0, 1000.0)  # so strong that only the mean is left
    model = forecast.cross_validate(folds, ["occupancy"], regularizations=tried)
    n = folds.agg(F.count("*").alias("n"), F.countDistinct("fold").cast("int").alias("folds"))
    errors = F.array(*[F.struct(F.lit(r).alias("regularization"), F.lit(float(e)).alias("rmse")) for r, e in zip(tried, model.avgMetrics)])
    winner, least = float(model.bestModel.getRegParam()), float(min(model.avgMetrics))
    chosen = (F.col("e.regularization") == winner) == (F.col("e.rmse") == least)
    return n.select("n", "folds", F.explode(errors).alias("e")).select(
        "n", "folds", "e.regularization", F.round("e.rmse", 2).alias("rmse"), chosen.alias("chosen_by_error")
    )


# -- large keys and tables: the same results with limits so low that the test tables exceed them ------

FEW_ROWS = 500


@query
def far_traffic(spark, sf):
    out = features.traffic_features(views.crowded_readings(spark, sf), tiebreak="event_id", rows_per_task=FEW_ROWS)
    return rounded(
        out.select(
            "event_id", "flow_rate", "density", "speed_ratio", "is_congested", "congestion_level", "occupancy_normalized",
            "is_high_occupancy", "speed_rolling_mean_5", "vehicle_count_rolling_mean_10", "flow_rate_rolling_mean_5",
            "occupancy_rolling_std_5",
        ),
        flow_rate=3, density=3, flow_rate_rolling_mean_5=3,
    )


@query
def far_lags(spark, sf):
    readings = views.crowded_readings(spark, sf)
    out = features.lag_features(readings, ["speed", "vehicle_count"], tiebreak="event_id", rows_per_task=FEW_ROWS)
    return out.select("event_id", *[f"{c}_lag_{k}" for c in ("speed", "vehicle_count") for k in features.LAGS])


@query
def far_global(spark, sf):
    out = features.traffic_features(views.readings(spark, sf), by=None, tiebreak="event_id", rows_per_task=FEW_ROWS)
    return rounded(out.select("event_id", "flow_rate", "speed_rolling_mean_5", "speed_rolling_mean_10"), flow_rate=3)


@query
def far_index(spark, sf):
    rows = views.readings(spark, sf).select("event_id", "timestamp")
    return OrderedRows(rows, None, ["timestamp", "event_id"], FEW_ROWS).index().result().select("event_id", "row_index")


@query
def far_asof(spark, sf):
    r = views.readings(spark, sf).select("event_id", "timestamp", "sensor_id")
    out = joins.asof_join(
        r, views.weather(spark, sf), None, values=["precipitation", "visibility"], tiebreak="event_id", rows_per_task=FEW_ROWS
    )
    return rounded(out.select("event_id", "timestamp_right", "precipitation", "visibility"))


@query
def far_sequences(spark, sf):
    readings = views.crowded_readings(spark, sf)
    out = sequences.with_sequences(readings, ["speed"], "speed", 10, tiebreak="event_id", rows_per_task=FEW_ROWS)
    return out.withColumn("x", F.flatten("x")).select("event_id", "y", hundredths("x").alias("x"))


@query
def far_stops(spark, sf):
    fixes = views.gps_points(spark, sf).withColumn("vehicle_id", F.when(F.col("event_id") % 3 == 0, "HOT").otherwise(F.col("vehicle_id")))
    out = trajectory.detect_stops(fixes, tiebreak="event_id", rows_per_task=FEW_ROWS)
    return rounded(out.select("event_id", "is_stopped", "stop_duration", "is_significant_stop"), 4)


@query
def far_fill(spark, sf):
    readings = views.crowded_readings(spark, sf)
    points = resample.grid_size(readings, "1 hour", "sensor_id")
    hourly = resample.resample(readings, "1 hour", "sensor_id", columns=["speed"])
    return rounded(resample.fill_gaps(hourly, ["speed"], "interpolate", "sensor_id", rows_per_task=FEW_ROWS, counts=points), 9)


@query
def far_quartiles(spark, sf):
    """QLT-3's and OUT-1's quartiles by narrowing brackets."""
    r = views.readings(spark, sf)
    found = quantiles.exact_quantiles(r, ["speed", "occupancy", "vehicle_count"], (0.25, 0.5, 0.75), max_values=50)
    rows = [(name, *values) for name, values in found.items()]
    return rounded(spark.createDataFrame(rows, "name STRING, q1 DOUBLE, q2 DOUBLE, q3 DOUBLE"))


@query
def far_knn(spark, sf):
    return rounded(spatial.knn_graph(views.road_nodes(spark, sf), broadcast_cells=0), 3)


@query
def far_salted(spark, sf):
    """Readings of a sensor against its readings of the first two days, a third of all at one sensor.

    A reading meets the sums of a day, not each of its readings: pairs would grow with the square of a sensor's readings.
    """
    r = views.crowded_readings(spark, sf)
    early = r.filter("timestamp < '2024-01-03'").groupBy("sensor_id", F.to_date("timestamp").alias("day")).agg(
        F.count("*").alias("n"), F.count("speed").alias("measured"), F.sum("speed").alias("early_speed")
    )
    met = joins.salted_join(r.select("sensor_id", "event_id", "speed"), early, "sensor_id", ["event_id"], FEW_ROWS)
    gap = F.col("measured") * F.col("speed") - F.col("early_speed")
    return met.groupBy("sensor_id").agg(F.sum("n").alias("n"), F.round(F.sum(gap), 2).alias("gap"))


# -- sources and sinks over data derived from the tables ---------------------------------------------

EVER = (datetime(2000, 1, 1), datetime(2100, 1, 1))


def _sensor_folder(spark, sf) -> str:
    """The readings as CSV files named like device exports: odd rows in another column order, with a column more and, for
    radars, one less."""
    r = views.readings(spark, sf)
    path = scratch_path(spark, "sensors")
    shapes = {
        "loop_detector": r.select("event_id", "timestamp", "sensor_id", "vehicle_count", F.col("speed").alias("average_speed"), "occupancy", "lane"),
        "camera": r.select("event_id", "timestamp", F.col("sensor_id").alias("camera_id"), "vehicle_count", F.lit("low").alias("congestion_level"), "latitude", "longitude"),
        "radar": r.select("event_id", "timestamp", F.col("sensor_id").alias("radar_id"), "speed", F.lit("N").alias("direction"), F.lit("car").alias("vehicle_type")),
    }
    for kind, rows in shapes.items():
        even = F.col("event_id") % 2 == 0
        other = [c for c in reversed(rows.columns) if c not in ("event_id", "vehicle_type")]
        parts = {"even": rows.filter(even).drop("event_id"), "odd": rows.filter(~even).select("*", F.lit("a, b").alias("note")).select("note", *other)}
        for name, part in parts.items():
            writer = part.write.option("header", True).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
            writer.csv(f"{path}/{kind}_{name}.csv")
    return path


@query
def src5_loop_detector(spark, sf):
    out = files.read_loop_detector(spark, _sensor_folder(spark, sf), None, datetime(2024, 1, 10), datetime(2024, 1, 12))
    return rounded(out)


@query
def src6_camera(spark, sf):
    return rounded(files.read_camera(spark, _sensor_folder(spark, sf), None, *EVER))


@query
def src7_radar(spark, sf):
    return rounded(files.read_radar(spark, _sensor_folder(spark, sf), None, *EVER))


@query
def src8_all_sensors(spark, sf):
    out = files.read_all_sensors(spark, _sensor_folder(spark, sf), *EVER)
    return out.groupBy("sensor_type", "sensor_id").agg(
        F.count("*").alias("n"), F.round(F.sum("speed"), 2).alias("speed"), F.sum("vehicle_count").alias("vehicles")
    )


@query
def src9_travel_files(spark, sf):
    """Two exports by year; the later one is read."""
    raw = views.travel_times_raw(spark, sf).filter("datetime is not null")
    path = scratch_path(spark, "travel")
    fields = raw.select("datetime", "travel_time", "distance", "speed")
    turned = raw.select("speed", "distance", F.lit("7").alias("origin_id"), "travel_time", F.col("datetime").alias("timestamp"))
    for name, rows, part in (
        ("nyc_1995.csv", fields, "datetime < '1996'"), ("nyc_1996.csv", turned, "timestamp >= '1996'"), ("la_1999.csv", fields, "true"),
    ):
        rows.filter(part).write.option("header", True).csv(f"{path}/{name}")
    latest = clean.clean_travel_times(files.read_travel_times(spark, path, "nyc", days=1))
    by_day = latest.filter("origin_id = '7'").groupBy(F.to_date("timestamp").alias("day"))
    return rounded(by_day.agg(F.count("*").alias("n"), F.sum("travel_time").alias("travel_time")), 2)


@query
def src10_gpx(spark, sf):
    points = views.gps_points(spark, sf)
    path = scratch_path(spark, "gpx")
    points.select(
        F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon"), F.col("event_id").cast("double").alias("ele"),
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("time"),
    ).write.format("xml").option("rootTag", "trkseg").option("rowTag", "trkpt").save(path)
    return rounded(files.read_gpx(spark, path))


def _in_two_orders(df: DataFrame, path: str, odd: Column) -> str:
    """CSV files with the columns as they are, and for ``odd`` rows in the opposite order after a further column."""
    df.filter(~odd).write.option("header", True).csv(f"{path}/even.csv")
    turned = df.filter(odd).select(F.lit("a, b").alias("note"), *reversed(df.columns))
    turned.write.option("header", True).csv(f"{path}/odd.csv")
    return f"{path}/*.csv"


@query
def src11_trajectory(spark, sf):
    """Two exports with other names and orders of their columns."""
    path = scratch_path(spark, "trajectory")
    points = views.gps_points(spark, sf).select(
        "event_id", F.col("latitude").alias("lat"), F.col("longitude").alias("lon"),
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("date_time"),
    )
    odd = F.col("event_id") % 2 == 1
    points.filter(~odd).write.option("header", True).csv(f"{path}/a.csv")
    points.filter(odd).select(F.col("date_time").alias("time"), "lat", F.col("lon").alias("lng"), "event_id").write.option("header", True).csv(f"{path}/b.csv")
    out = files.read_trajectory(spark, f"{path}/*.csv")
    return rounded(out.withColumn("event_id", F.col("event_id").cast("long")))


CITY_RECORD = "event_id BIGINT, created_date STRING, speed STRING, occupancy STRING"


@query
def src12_city(spark, sf):
    path = scratch_path(spark, "city")
    views.city_sensor_raw(spark, sf).write.json(path)
    return clean.clean_city_sensors(files.read_city_sensors(spark, path, schema=CITY_RECORD)).drop("created_date")


@query
def src12_city_csv(spark, sf):
    path = _in_two_orders(views.city_sensor_raw(spark, sf), scratch_path(spark, "city"), F.col("event_id") % 2 == 1)
    return clean.clean_city_sensors(files.read_city_sensors(spark, path, "csv", schema=CITY_RECORD)).drop("created_date")


@query
def top2_limit(spark, sf):
    """TOP-2: as many landed records as are asked for, and all of them without a limit."""
    path = scratch_path(spark, "city")
    views.city_sensor_raw(spark, sf).write.json(path)
    asked = [("some", 100), ("all", None)]
    counts = [files.read_city_sensors(spark, path, limit=n, schema=CITY_RECORD).agg(F.count("*").alias("n")).select(F.lit(name).alias("asked"), "n") for name, n in asked]
    return files.union_all(counts)


def _incidents(spark, sf) -> DataFrame:
    return views.readings(spark, sf).select("event_id", F.col("timestamp").cast("string").alias("created_date"))


@query
def src13_incidents(spark, sf):
    path = scratch_path(spark, "incidents")
    _incidents(spark, sf).write.json(path)
    return files.read_incidents(spark, path, hours=36, now=datetime(2024, 1, 20), schema="event_id BIGINT, created_date STRING")


@query
def src13_incidents_csv(spark, sf):
    path = _in_two_orders(_incidents(spark, sf), scratch_path(spark, "incidents"), F.col("event_id") % 2 == 1)
    return files.read_incidents(spark, path, "csv", hours=36, now=datetime(2024, 1, 20), schema="event_id BIGINT, created_date STRING")


def _segments(spark, sf) -> DataFrame:
    nodes, edges = views.road_nodes(spark, sf), views.road_edges(spark, sf)
    for end, name in (("src", "from"), ("dst", "to")):
        place = nodes.select(
            F.col("id").alias(end), F.col("latitude").cast("string").alias(name + "_lat"), F.col("longitude").cast("string").alias(name + "_lon")
        )
        edges = edges.join(place, end)
    return edges.withColumnsRenamed({"src": "from_id", "dst": "to_id"})


def _degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    degree = edges.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("degree"), F.sum("weight").alias("weight"))
    return rounded(nodes.join(degree, "id", "left"))


SEGMENT = "from_id BIGINT, from_lat STRING, from_lon STRING, to_id BIGINT, to_lat STRING, to_lon STRING, weight DOUBLE"


@query
def src14_roads(spark, sf):
    path = scratch_path(spark, "roads")
    _segments(spark, sf).write.json(path)
    return _degrees(*files.read_road_network(spark, path, schema=SEGMENT))


@query
def src14_roads_csv(spark, sf):
    path = _in_two_orders(_segments(spark, sf), scratch_path(spark, "roads"), F.col("from_id") % 2 == 1)
    return _degrees(*files.read_road_network(spark, path, "csv", schema=SEGMENT))


@query
def src15_range(spark, sf):
    """SNK-7, then the landed partitions of ten days."""
    path = scratch_path(spark, "landing")
    r = views.readings(spark, sf).select("event_id", "timestamp", "speed")
    sinks.write_landed(r, path, "nyc")
    sinks.write_landed(r.withColumn("speed", F.lit(0.0)), path, "la")
    return files.read_travel_time_range(spark, path, "nyc", date(2024, 1, 10), date(2024, 1, 19)).select("event_id", "speed", "date")


@query
def src16_latest(spark, sf):
    """The local table ends early, so the landed one is taken."""
    raw = views.travel_times_raw(spark, sf)
    local = raw.filter("datetime < '1996-01-01'")
    return files.latest_data(local, raw, now=datetime(1998, 12, 1)).drop("datetime")


@query
def snk6_batch(spark, sf):
    path = scratch_path(spark, "batch")
    sinks.write_batch(views.readings(spark, sf).select("event_id", "timestamp", "speed"), path)
    return spark.read.parquet(path).select("event_id", "speed", "hour", "day_of_week_sun1", "is_weekend", "date")


# -- streaming -------------------------------------------------------------------------------------

NOW = {"availableNow": True}


def _event_stream(spark, sf) -> DataFrame:
    schema = views.table(spark, sf, "events").schema
    return stream_sources.create_source(
        spark, "file", {"format": "parquet", "schema": schema, "path": sf, "glob": "events.parquet"}
    )


def _run_updates(df: DataFrame, keys: list[str], label: str, mode: str = "update") -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, label)
    stream_sinks.write_updates(df, path, trigger=NOW, mode=mode).awaitTermination()
    return stream_sinks.read_updates(spark, path, keys)


@query
def stm2_sliding(spark, sf):
    stream = stream_queries.process_stream(views.readings_of(_event_stream(spark, sf)))
    return rounded(_run_updates(stream, ["window_start", "window_end", "location_id"], "stm2"))


@query
def stm3_tumbling(spark, sf):
    stream = stream_queries.process_stream(views.readings_of(_event_stream(spark, sf)), "1 hour", None)
    return rounded(_run_updates(stream, ["window_start", "window_end", "location_id"], "stm3"))


@query
def stm1_json(spark, sf):
    """Payload text in, parsed on the stream, windows out."""
    r = views.readings_of(_event_stream(spark, sf))
    body = F.to_json(F.struct("sensor_id", "timestamp", "speed", "vehicle_count", "occupancy"))
    stream = stream_queries.process_stream(r.select(body.alias("value")), "1 hour", None)
    return rounded(_run_updates(stream, ["window_start", "window_end", "location_id"], "stm1"))


@query
def stm8_alert_feed(spark, sf):
    stream = stream_queries.alert_feed(views.readings_of(_event_stream(spark, sf)), "1 hour", None)
    return _run_updates(stream, ["location_id", "window_end"], "stm8")


@query
def cng1_stream(spark, sf):
    """CNG-1 row by row on the stream, appended to parquet (SNK-3)."""
    rated = congestion.detect_congestion(views.readings_of(_event_stream(spark, sf)))
    path = scratch_path(spark, "cng1")
    out = rated.select("event_id", "is_congested", "congestion_severity")
    stream_sinks.write_sink(out, "parquet", {"path": path}, trigger=NOW).awaitTermination()
    return spark.read.parquet(path)


@query
def stm9_live_stops(spark, sf):
    """Stops found by the stateful stream, with the watermark ten minutes behind the last fix."""
    fixes = views.readings_of(_event_stream(spark, sf)).select(
        F.col("sensor_id").alias("vehicle_id"), "timestamp", F.col("speed").alias("speed_kmh")
    )
    before = {name: spark.conf.get(name) for name in stream_queries.STATE_STORE}
    for name, value in stream_queries.STATE_STORE.items():
        spark.conf.set(name, value)
    try:
        path = scratch_path(spark, "stm9")
        stops = stream_queries.live_stops(fixes, speed_threshold=12.0, max_gap=864_000)
        stream_sinks.write_sink(stops, "parquet", {"path": path}, trigger=NOW).awaitTermination()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    return rounded(spark.read.parquet(path))


def _arriving(spark, sf, label: str, parts: list[Column]):
    """A growing folder of events: after each part lands, a new stream over the whole folder, as after a restart."""
    events = views.table(spark, sf, "events")
    folder = scratch_path(spark, label)
    for part in parts:
        events.filter(part).write.mode("append").parquet(folder)
        yield views.readings_of(spark.readStream.schema(events.schema).parquet(folder))


@query
def stm6_restart(spark, sf):
    """SNK-3, SNK-5: a file sink that is stopped and started again with default arguments while files keep arriving."""
    path = scratch_path(spark, "stm6")
    for stream in _arriving(spark, sf, "stm6-in", [F.col("event_id") % 3 == part for part in range(3)]):
        stream_sinks.write_sink(stream.select("event_id", "speed"), "parquet", {"path": path}, trigger=NOW).awaitTermination()
    return spark.read.parquet(path)


@query
def stm6_updates(spark, sf):
    """STM-6: updated windows go on from the last run's state and batch number."""
    path = scratch_path(spark, "stm6u")
    cut = F.to_date("ts") < F.lit("2024-01-15").cast("date")
    for stream in _arriving(spark, sf, "stm6u-in", [cut, ~cut]):
        stream_sinks.write_updates(stream_queries.process_stream(stream, "1 hour", None), path, trigger=NOW).awaitTermination()
    return rounded(stream_sinks.read_updates(spark, path, ["window_start", "window_end", "location_id"]))


@query
def stm6_compacted(spark, sf):
    """STM-6: a batch per three days, merged into the base after every third batch."""
    events = views.table(spark, sf, "events")
    folder, path = scratch_path(spark, "stm6c-in"), scratch_path(spark, "stm6c")
    for days in range(1, 32, 3):
        events.filter(F.dayofmonth("ts").between(days, days + 2)).coalesce(1).write.mode("append").parquet(folder)
    stream = views.readings_of(spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder))
    keys = ["window_start", "window_end", "location_id"]
    stream_sinks.write_updates(stream_queries.process_stream(stream, "1 hour", None), path, trigger=NOW, keys=keys, compact_every=3).awaitTermination()
    return rounded(stream_sinks.read_updates(spark, path, keys))


@query
def snk4_memory(spark, sf):
    """SNK-4: a stream into a table of the session."""
    name = f"memory_{uuid.uuid4().hex}"
    stream = views.readings_of(_event_stream(spark, sf)).select("event_id", "speed")
    stream_sinks.write_sink(stream, "memory", {"table_name": name}, trigger=NOW).awaitTermination()
    return spark.table(name)


@query
def stm5_late(spark, sf):
    """STM-5: rows that arrive behind the watermark change no window."""
    path = scratch_path(spark, "stm5")
    late = (F.col("event_id") % 50 == 0) & (F.to_date("ts") < F.lit("2024-01-10").cast("date"))
    early = F.to_date("ts") < F.lit("2024-01-20").cast("date")
    for stream in _arriving(spark, sf, "stm5-in", [early & ~late, ~early | late]):
        stream_sinks.write_updates(stream_queries.process_stream(stream, "1 hour", None), path, trigger=NOW).awaitTermination()
    return rounded(stream_sinks.read_updates(spark, path, ["window_start", "window_end", "location_id"]))


@query
def snk2_records(spark, sf):
    """SNK-2: records as a Kafka sink gets them, read back from their JSON."""
    rows = views.readings(spark, sf).select(F.col("sensor_id").alias("location_id"), "event_id", "speed", "timestamp")
    records = stream_sinks.kafka_records(rows)
    return records.select("key", F.from_json("value", rows.schema).alias("v")).select("key", "v.event_id", "v.speed", "v.timestamp")
