"""Aggregate tables for reports.

Large tables are always grouped before they are joined, and grouped by map task
before they are shuffled, so a session with very many rows costs one row per
task and group.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapwright.functions import exact_mean, mean_of_parts, spread_of_parts
from lapwright.operators import points_in_intervals
from lapwright.plans.common import ENTRY, RACE_TYPES, Tables, names, only
from lapwright.plans.states import SHOWN, state


def driver_performance(tables: Tables) -> DataFrame:
    """Pace, speed and pit stops per session and driver who set a clear lap."""
    speeds = [f"max_speed_{trap}" for trap in ("i1", "i2", "st")]
    pace = state(tables, "state_pace").select(
        *ENTRY, "total_laps", "fastest_lap_time", mean_of_parts().alias("avg_lap_time"),
        spread_of_parts().alias("lap_time_consistency"), *speeds,
    )
    stops = state(tables, "state_pit").select(*ENTRY, "stops", mean_of_parts().alias("avg_pit_duration"), "fastest_pit_stop")
    named = pace.join(names(tables), ENTRY, "left").join(stops, ENTRY, "left")
    return named.withColumn("pit_stop_count", F.coalesce("stops", F.lit(0))).select(
        *ENTRY, "full_name", "team_name", "total_laps", "fastest_lap_time", "avg_lap_time", "lap_time_consistency",
        *speeds, "pit_stop_count", "avg_pit_duration", "fastest_pit_stop",
    )


def race_summary(tables: Tables) -> DataFrame:
    """Laps, messages and weather of every Race and Sprint session.

    All timed laps count here, also those with an unknown pit flag; a pit stop is
    a timed lap that is known to start from the pit lane.
    """
    key = "session_key"
    conditions = state(tables, "state_weather").select(
        key, mean_of_parts("air_temperature_").alias("avg_air_temp"), mean_of_parts("track_temperature_").alias("avg_track_temp"),
        "rainfall_detected",
    )
    summary = only(tables["silver_sessions"], session_type=RACE_TYPES)
    for part in (state(tables, "state_race_laps"), state(tables, "state_messages"), conditions):
        summary = summary.join(part, key, "left")
    return summary.fillna(0, list(SHOWN)).select(
        key, "meeting_key", "session_name", "location", "date_start", "date_end", "total_laps", "fastest_lap",
        "total_pit_stops", *SHOWN, "avg_air_temp", "avg_track_temp", "rainfall_detected",
    )


def team_performance(tables: Tables) -> DataFrame:
    """Roll-up of driver performance; drivers without a known team share the NULL team.

    Means are of the drivers' means, so every driver weighs the same.
    """
    return tables["gold_driver_performance"].groupBy("session_key", "team_name").agg(
        F.count("driver_number").alias("drivers_count"),
        F.min("fastest_lap_time").alias("team_fastest_lap"),
        exact_mean("avg_lap_time").alias("team_avg_lap_time"),
        F.sum("pit_stop_count").alias("total_team_pit_stops"),
        exact_mean("avg_pit_duration").alias("team_avg_pit_duration"),
        F.max("max_speed_st").alias("team_max_speed"),
    )


def tyre_strategy(tables: Tables) -> DataFrame:
    """Lap times within each stint; a stint without any lap has no row."""
    laps = tables["silver_laps"].select(*ENTRY, "lap_number", "lap_duration")
    stints = tables["silver_stints"].select(
        *ENTRY, "stint_number", "lap_start", "lap_end", "compound", "tyre_age_at_start",
        (F.col("lap_end") - F.col("lap_start") + 1).alias("stint_laps"),
    )
    stint = [*ENTRY, "stint_number", "compound", "stint_laps", "tyre_age_at_start"]
    timed = points_in_intervals(laps, stints, ENTRY, "lap_number", "lap_start", "lap_end").groupBy(*stint).agg(
        exact_mean("lap_duration").alias("avg_lap_time_on_compound"),
        F.min("lap_duration").alias("best_lap_time_on_compound"),
    )
    return timed.join(names(tables), ENTRY, "left").select(
        *ENTRY, "full_name", "team_name", *stint[2:], "avg_lap_time_on_compound", "best_lap_time_on_compound"
    )


def fastest_laps(tables: Tables) -> DataFrame:
    """Best clear lap of each driver and its rank in the session.

    Equal times: the earlier lap is the driver's best, and the lower driver number
    ranks first. A session is ranked by one task, but only over one row per driver.
    """
    best = state(tables, "state_best_lap").select(
        *ENTRY,
        F.col("best.lap_number").alias("lap_number"),
        F.col("best.lap_duration").alias("fastest_lap_time"),
    )
    in_session = Window.partitionBy("session_key").orderBy("fastest_lap_time", "driver_number")
    sessions = tables["silver_sessions"].select("session_key", "session_name", "location", "date_start")
    return (
        best.join(names(tables), ENTRY, "left")
        .join(sessions, "session_key", "left")
        .withColumn("rank", F.row_number().over(in_session))
        .select(
            "session_key", "session_name", "location", "date_start", "rank", "driver_number", "full_name",
            "team_name", "lap_number", "fastest_lap_time",
        )
    )


def overtakes_analysis(tables: Tables) -> DataFrame:
    """Overtakes made per session and driver.

    A driver is named only if the driver row belongs to the same meeting.
    """
    who = [*ENTRY, "meeting_key"]
    listed = tables["silver_drivers"].select(*who, "full_name", "team_name")
    made = state(tables, "state_overtakes").join(listed, who, "left")
    return made.select(*ENTRY, "full_name", "team_name", "overtakes_made")


GOLD = {
    "gold_driver_performance": driver_performance,
    "gold_race_summary": race_summary,
    "gold_tyre_strategy": tyre_strategy,
    "gold_fastest_laps": fastest_laps,
    "gold_overtakes_analysis": overtakes_analysis,
    "gold_team_performance": team_performance,
}


# What each table is made from; all of it meets on the session.
SOURCES = {
    "gold_driver_performance": ("state_pace", "state_pit", "silver_drivers"),
    "gold_race_summary": ("silver_sessions", "state_race_laps", "state_messages", "state_weather"),
    "gold_tyre_strategy": ("silver_laps", "silver_stints", "silver_drivers"),
    "gold_fastest_laps": ("state_best_lap", "silver_drivers", "silver_sessions"),
    "gold_overtakes_analysis": ("state_overtakes", "silver_drivers"),
    "gold_team_performance": ("gold_driver_performance",),
}


def builders() -> Mapping:
    return dict(GOLD)
