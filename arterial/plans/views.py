"""Traffic-shaped views of the given star-schema tables.

Texts used by both engines are SQL select lists over one table; the oracle inlines them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arterial.session import configure

READINGS = """
  event_id, concat('S', cast(user_id as varchar(20))) as sensor_id, ts as timestamp,
  cast(40.70 + (user_id % 100) * 0.001 as double) as latitude,
  cast(-74.02 + (user_id % 37) * 0.002 as double) as longitude,
  case when value > 120 then cast(120.0 as double) else value end as speed,
  cast(event_id % 41 as int) as vehicle_count,
  case when event_id % 29 = 0 then null else cast((event_id * 37) % 101 as double) end as occupancy,
  cast(case user_id % 3 when 0 then 50.0 when 1 then 60.0 else 80.0 end as double) as speed_limit,
  cast(event_id % 4 + 1 as int) as lane,
  case when event_type in ('click', 'view') then 'loop_detector'
       when event_type in ('error', 'signup') then 'camera' else 'radar' end as sensor_type
"""
CITY_SENSOR_RAW = """
  event_id, case when event_id % 23 = 0 then null else cast(ts as varchar(40)) end as created_date,
  case when event_id % 17 = 0 then 'n/a' else cast(value as varchar(40)) end as speed,
  cast((event_id * 37) % 101 as varchar(40)) as occupancy
"""
ROAD_NODES = """
  c_custkey as id,
  cast(40.60 + floor(c_custkey / 50.0) * 0.005 as double) as latitude,
  cast(-74.10 + (c_custkey % 50) * 0.005 as double) as longitude
"""
FORECASTS = """
  l_orderkey, l_linenumber, l_returnflag as sensor_id,
  l_extendedprice as y_true, l_extendedprice * (1 - l_discount) as y_pred
"""
WEATHER = """
  event_id, ts as timestamp, value / 50 as precipitation, cast(event_id % 12 as double) as visibility
"""
TRAVEL_TIMES_RAW = """
  l_orderkey, l_linenumber,
  case when l_orderkey % 19 = 0 then null else cast(l_shipdate as varchar(40)) end as datetime,
  case when l_linenumber % 5 = 0 then '-' else cast(l_quantity as varchar(40)) end as travel_time,
  cast(l_discount as varchar(40)) as distance, cast(l_tax as varchar(40)) as speed
"""
REQUESTS = """
  s_suppkey as request_id,
  cast(40.60 + floor(s_suppkey / 50.0) * 0.005 + 0.001 as double) as origin_lat,
  cast(-74.10 + (s_suppkey % 50) * 0.005 + 0.001 as double) as origin_lon,
  cast(40.60 + floor(s_suppkey / 50.0) * 0.005 + 0.0105 as double) as dest_lat,
  cast(-74.10 + (s_suppkey % 50) * 0.005 + 0.0005 as double) as dest_lon,
  cast(20 + s_suppkey % 60 as double) as predicted_speed_kmh
"""


def _columns(text: str) -> list[str]:
    """The select list split at its top-level commas."""
    parts, depth, start = [], 0, 0
    for i, ch in enumerate(text):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            parts.append(text[start:i])
            start = i + 1
    return [p.strip() for p in (*parts, text[start:])]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings_of(events: DataFrame) -> DataFrame:
    return events.selectExpr(*_columns(READINGS))


def readings(spark, sf_dir) -> DataFrame:
    return readings_of(table(spark, sf_dir, "events"))


def crowded_readings(spark, sf_dir) -> DataFrame:
    """The readings with a third of the rows at one sensor and some without a sensor."""
    return readings(spark, sf_dir).withColumn(
        "sensor_id",
        F.when(F.col("event_id") % 3 == 0, "HOT").when(F.col("event_id") % 101 == 0, F.lit(None)).otherwise(F.col("sensor_id")),
    )


def city_sensor_raw(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*_columns(CITY_SENSOR_RAW))


def travel_times_raw(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*_columns(TRAVEL_TIMES_RAW))


def road_nodes(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*_columns(ROAD_NODES))


def road_edges(spark, sf_dir) -> DataFrame:
    """Each node's four neighbours by arithmetic, kept where the neighbour exists."""
    ids = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("src"))
    column = F.pmod(F.col("src"), F.lit(50))
    steps = F.array_compact(
        F.array(
            F.lit(50), F.lit(-50),
            F.when(column < 49, F.lit(1)),
            F.when(F.pmod(F.col("src") - 1, F.lit(50)) < 49, F.lit(-1)),
        )
    )
    edges = ids.select("src", F.explode(steps).alias("step")).select("src", (F.col("src") + F.col("step")).alias("dst"))
    edges = edges.join(ids.withColumnRenamed("src", "dst"), "dst", "left_semi")
    weight = (1 + F.pmod(F.col("src") * 7 + F.col("dst") * 3, F.lit(5))).cast("double")
    return edges.select("src", "dst", weight.alias("weight"))


def intersection_flow(spark, sf_dir) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey as intersection_id",
        "case l_linenumber % 4 when 0 then 'north' when 1 then 'south' when 2 then 'east' else 'west' end as approach",
        "l_quantity",
    )
    flow = F.when(F.col("intersection_id") % 25 == 0, F.lit(0.0)).otherwise(F.sum("l_quantity"))
    return lineitem.groupBy("intersection_id", "approach").agg(flow.alias("flow"))


def forecasts(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*_columns(FORECASTS))


def weather(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").filter("event_type = 'view'").selectExpr(*_columns(WEATHER))


def requests(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(*_columns(REQUESTS))


def gps_of(events: DataFrame) -> DataFrame:
    micros = F.lit(1704067200000000) + F.expr("(unix_micros(ts) - 1704067200000000) div 600")
    return events.select(
        F.concat(F.lit("V"), F.col("user_id").cast("string")).alias("vehicle_id"),
        "event_id",
        F.timestamp_micros(micros).alias("timestamp"),
        (F.lit(40.70) + (F.col("event_id") % 5) * 0.002).cast("double").alias("latitude"),
        F.lit(-74.0).alias("longitude"),
    )


def gps_points(spark, sf_dir) -> DataFrame:
    return gps_of(table(spark, sf_dir, "events"))


# -- the same views for the oracle -----------------------------------------------------------------

CTE = {
    "readings": f"select {READINGS} from events",
    "city_sensor_raw": f"select {CITY_SENSOR_RAW} from events",
    "travel_times_raw": f"select {TRAVEL_TIMES_RAW} from lineitem",
    "road_nodes": f"select {ROAD_NODES} from customer",
    "road_edges": """
  select a.c_custkey as src, b.c_custkey as dst, cast(1 + (a.c_custkey * 7 + b.c_custkey * 3) % 5 as double) as weight
  from customer a join customer b
    on b.c_custkey = a.c_custkey + 50 or a.c_custkey = b.c_custkey + 50
    or (b.c_custkey = a.c_custkey + 1 and a.c_custkey % 50 < 49)
    or (a.c_custkey = b.c_custkey + 1 and b.c_custkey % 50 < 49)""",
    "intersection_flow": """
  select l_suppkey as intersection_id,
         case l_linenumber % 4 when 0 then 'north' when 1 then 'south' when 2 then 'east' else 'west' end as approach,
         case when l_suppkey % 25 = 0 then cast(0.0 as double) else sum(l_quantity) end as flow
  from lineitem group by 1, 2, l_suppkey""",
    "forecasts": f"select {FORECASTS} from lineitem",
    "weather": f"select {WEATHER} from events where event_type = 'view'",
    "requests": f"select {REQUESTS} from supplier",
    "gps_points": """
  select concat('V', cast(user_id as varchar)) as vehicle_id, event_id,
         make_timestamp(1704067200000000 + (epoch_us(ts) - 1704067200000000) // 600) as timestamp,
         cast(40.70 + (event_id % 5) * 0.002 as double) as latitude, cast(-74.0 as double) as longitude
  from events""",
}


def with_views(*names: str, more: str = "", recursive: bool = False) -> str:
    """``with`` clause that defines the named views, and any further definitions."""
    parts = [f"{n} as ({CTE[n]})" for n in names]
    if more:
        parts.append(more)
    return ("with recursive " if recursive else "with ") + ",\n".join(parts) + "\n"
