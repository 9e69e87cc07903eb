"""Signal timings from approach flows (SIG-1 to SIG-4, AGG-7, MAP-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values, in seconds.
MIN_GREEN, MAX_GREEN, DEFAULT_CYCLE = 10, 120, 90
YELLOW = 3
DEFAULT_GREEN, DEFAULT_RED = 30, 57
DEFAULT_APPROACHES = ("north", "south", "east", "west")

_PHASE = "struct<green:int,yellow:int,red:int>"


def explode_flows(df: DataFrame) -> DataFrame:
    """Long form ``(intersection_id, approach, flow)`` of a ``traffic_flows`` map column.

    An empty or missing map gives one row without approach and flow, so that its intersection keeps a timing.
    """
    others = [c for c in df.columns if c != "traffic_flows"]
    return df.select(*others, F.explode_outer("traffic_flows").alias("approach", "flow"))


def signal_timing(
    flows: DataFrame,
    min_green: int = MIN_GREEN,
    max_green: int = MAX_GREEN,
    default_cycle: int = DEFAULT_CYCLE,
) -> DataFrame:
    """SIG-1 to SIG-3: one row per intersection with ``timing`` (approach to phase).

    Input is ``(intersection_id, approach, flow)`` and optionally ``has_timing`` (the intersection
    runs a timing already). Flows of an approach are added up first, so that what is gathered per
    intersection is its handful of approaches. A missing flow counts as none; rows without an approach name none, so
    their flow is left out. Intersections without approaches or without flow get the default timing.
    """
    timed = F.max(F.col("has_timing").cast("int")) if "has_timing" in flows.columns else F.max(F.lit(0))
    known = F.coalesce(F.col("flow").cast("double"), F.lit(0.0))
    known = F.when(F.isnan(known), 0.0).otherwise(known)
    summed = flows.groupBy("intersection_id", "approach").agg(F.sum(known).alias("flow"), timed.alias("_timed"))
    named = F.col("approach").isNotNull()
    per = summed.groupBy("intersection_id").agg(
        F.sum(F.when(named, F.col("flow"))).alias("total_flow"),
        F.count("approach").alias("_n"),
        F.sort_array(F.collect_list(F.when(named, F.struct("approach", "flow")))).alias("_flows"),
        F.max("_timed").alias("_timed"),
    )

    def with_green(entry):
        # multiplied first: a share that is a whole number of seconds must not fall below it by rounding
        share = F.floor(F.try_divide(default_cycle * entry["flow"], F.col("total_flow")))
        green = F.greatest(F.lit(min_green), F.least(F.lit(max_green), share)).cast("int")
        return F.struct(entry["approach"].alias("approach"), entry["flow"].alias("flow"), green.alias("green"))

    greens = per.withColumn("_green", F.transform("_flows", with_green))
    cycle = F.aggregate("_green", F.lit(0), lambda s, e: s + e["green"]) + YELLOW * F.col("_n").cast("int")
    greens = greens.withColumn("_cycle", cycle)

    def phase(entry):
        red = F.col("_cycle") - entry["green"] - YELLOW
        times = F.struct(
            entry["green"].alias("green"), F.lit(YELLOW).alias("yellow"), red.cast("int").alias("red")
        )
        return F.struct(entry["approach"].alias("key"), times.cast(_PHASE).alias("value"))

    default = F.map_from_entries(
        F.array(
            *[
                F.struct(
                    F.lit(a).alias("key"),
                    F.struct(
                        F.lit(DEFAULT_GREEN).alias("green"), F.lit(YELLOW).alias("yellow"), F.lit(DEFAULT_RED).alias("red")
                    ).cast(_PHASE).alias("value"),
                )
                for a in DEFAULT_APPROACHES
            ]
        )
    )
    idle = F.coalesce(F.col("total_flow") == 0, F.lit(True))
    label = F.when(idle, "maintain").when(F.col("_timed") == 1, "optimize").otherwise("implement")
    return greens.select(
        "intersection_id",
        F.when(idle, F.lit(default_cycle)).otherwise(F.col("_cycle")).cast("int").alias("cycle_time"),
        F.when(idle, default).otherwise(F.map_from_entries(F.transform("_green", phase))).alias("timing"),
        F.map_from_entries("_flows").alias("traffic_flows"),
        label.alias("recommendation"),
    )


def timing_rows(timings: DataFrame) -> DataFrame:
    """Long form: one row per intersection and approach."""
    return timings.select(
        "intersection_id", "cycle_time", "recommendation", F.explode("timing").alias("approach", "phase")
    ).select("intersection_id", "approach", "cycle_time", "phase.green", "phase.yellow", "phase.red", "recommendation")


def flow_totals(flows: DataFrame) -> DataFrame:
    """AGG-7."""
    return flows.groupBy("intersection_id").agg(F.sum("flow").alias("total_flow"))


def delay_reduction(
    df: DataFrame, current: str = "current_cycle_time", optimized: str = "optimized_cycle_time"
) -> DataFrame:
    """SIG-4: cycle and delay differences; the mean delay is half a cycle. Missing cycles count as 90."""
    now = F.coalesce(F.col(current).cast("double"), F.lit(float(DEFAULT_CYCLE)))
    then = F.coalesce(F.col(optimized).cast("double"), F.lit(float(DEFAULT_CYCLE)))

    def percent(change, base):
        return F.when(base > 0, change / base * 100).otherwise(F.lit(0.0))

    return df.withColumns(
        {
            current: now,
            optimized: then,
            "cycle_reduction_seconds": now - then,
            "cycle_reduction_percent": percent(now - then, now),
            "current_avg_delay": now / 2,
            "optimized_avg_delay": then / 2,
            "delay_reduction_seconds": now / 2 - then / 2,
            "delay_reduction_percent": percent(now / 2 - then / 2, now / 2),
        }
    )
