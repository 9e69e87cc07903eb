"""Schemas of the input and output tables."""

from pyspark.sql.types import StructType

# Field names and types of the tables.
TRAFFIC_READING = (
    StructType()
    .add("sensor_id", "string")
    .add("timestamp", "timestamp")
    .add("latitude", "double")
    .add("longitude", "double")
    .add("speed", "double")
    .add("vehicle_count", "integer")
    .add("occupancy", "double")
    .add("flow_rate", "double")
)
LOOP_DETECTOR = (
    StructType()
    .add("timestamp", "timestamp")
    .add("sensor_id", "string")
    .add("vehicle_count", "integer")
    .add("average_speed", "double")
    .add("occupancy", "double")
    .add("lane", "integer")
)
CAMERA = (
    StructType()
    .add("timestamp", "timestamp")
    .add("camera_id", "string")
    .add("vehicle_count", "integer")
    .add("congestion_level", "string")
    .add("latitude", "double")
    .add("longitude", "double")
)
RADAR = (
    StructType()
    .add("timestamp", "timestamp")
    .add("radar_id", "string")
    .add("speed", "double")
    .add("direction", "string")
    .add("vehicle_type", "string")
)
# Landed feeds carry text: values are coerced when they are cleaned. The time columns are candidates, in order of
# preference; a record has one of them.
TRAVEL_TIME_RAW = (
    StructType()
    .add("datetime", "string")
    .add("timestamp", "string")
    .add("travel_time", "string")
    .add("distance", "string")
    .add("speed", "string")
)
CITY_SENSOR_RAW = (
    StructType()
    .add("timestamp", "string")
    .add("datetime", "string")
    .add("created_date", "string")
    .add("date", "string")
    .add("speed", "string")
    .add("volume", "string")
    .add("occupancy", "string")
    .add("latitude", "string")
    .add("longitude", "string")
)
GPX_POINT = StructType().add("_lat", "double").add("_lon", "double").add("ele", "double").add("time", "string")
