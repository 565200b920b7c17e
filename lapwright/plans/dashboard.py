"""Dashboard answers over recent sessions.

``as_of`` is the day from which "recent" is counted back, today if left out.
Answers with a limit end their sort in columns that settle ties.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwright.functions import championship_points, mean_of, rain_label, rounded, since_days
from lapwright.functions.measures import exact_total
from lapwright.operators import join_rows, latest_value, top_rows
from lapwright.plans.common import ENTRY, RACE_TYPES, Tables, entrants, names, null_last, only

Day = str | dt.date | None


def _recent(tables: Tables, as_of: Day, days: int, *columns: str, kinds=None) -> DataFrame:
    sessions = only(tables["silver_sessions"], session_type=kinds)
    return sessions.where(since_days(F.col("date_start"), days, as_of)).select("session_key", *columns)


def _rounded(column: str, places: int, name: str | None = None):
    return rounded(column, places).alias(name or column)


def recent_sessions(tables: Tables, limit: int = 20, spread: int = 16) -> DataFrame:
    """Latest sessions with their meeting and the count of drivers.

    Sessions are repeated ``spread`` times and each copy meets its share of the
    driver numbers: in a left join Spark cannot itself split a key that is hot on
    the right. The copies carry different drivers, so the distinct count stands.
    """
    shown = ["session_name", "location", "country_name", "date_start", "session_type", "meeting_name"]
    meetings = tables["silver_meetings"].select("meeting_key", "meeting_name")
    share = F.pmod("driver_number", F.lit(spread)).alias("share")
    drivers = tables["silver_drivers"].select("session_key", "driver_number", share)
    copies = F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("share")
    listed = (
        tables["silver_sessions"]
        .join(meetings, "meeting_key")
        .select("session_key", *shown, copies)
        .join(drivers, ["session_key", "share"], "left")
        .groupBy(*shown)
        .agg(F.count_distinct("driver_number").alias("drivers_count"))
    )
    return top_rows(listed, limit, F.desc("date_start"), *null_last(*[c for c in shown if c != "date_start"]))


def fastest_laps(tables: Tables, as_of: Day = None, days: int = 90, limit: int = 50) -> DataFrame:
    """Best laps of recent sessions."""
    best = tables["gold_fastest_laps"].where(since_days(F.col("date_start"), days, as_of))
    return top_rows(best, limit, F.desc("date_start"), F.asc("rank"), F.asc("session_key")).select(
        "rank", F.col("full_name").alias("driver"), F.col("team_name").alias("team"), "session_name", "location",
        "lap_number", _rounded("fastest_lap_time", 3, "lap_time_seconds"), "date_start",
    )


def driver_comparison(tables: Tables, as_of: Day = None, days: int = 90) -> DataFrame:
    """Driver performance in recent races."""
    races = _recent(tables, as_of, days, "location", "session_name", "date_start", kinds=RACE_TYPES)
    rows = tables["gold_driver_performance"].join(races, "session_key")
    return rows.orderBy(F.desc("date_start"), "fastest_lap_time", *ENTRY).select(
        "location", "session_name", F.col("full_name").alias("driver"), F.col("team_name").alias("team"),
        "total_laps", _rounded("fastest_lap_time", 3, "fastest_lap"), _rounded("avg_lap_time", 3),
        _rounded("lap_time_consistency", 3, "consistency_std"), "pit_stop_count", _rounded("avg_pit_duration", 2),
        F.col("max_speed_st").alias("max_speed_kmh"),
    )


def team_rankings(tables: Tables, as_of: Day = None, days: int = 90) -> DataFrame:
    """Team performance in recent races."""
    races = _recent(tables, as_of, days, "location", "session_name", "date_start", kinds=RACE_TYPES)
    rows = tables["gold_team_performance"].join(races, "session_key")
    return rows.orderBy(F.desc("date_start"), "team_fastest_lap", "session_key", "team_name").select(
        "location", "session_name", "team_name", _rounded("team_fastest_lap", 3, "fastest_lap"),
        _rounded("team_avg_lap_time", 3, "avg_lap_time"), "total_team_pit_stops",
        _rounded("team_avg_pit_duration", 2, "avg_pit_duration"), "team_max_speed",
    )


def tyre_strategy(tables: Tables, as_of: Day = None, days: int = 90) -> DataFrame:
    """Stints of recent races."""
    races = _recent(tables, as_of, days, "location", "session_name", "date_start", kinds=RACE_TYPES)
    rows = tables["gold_tyre_strategy"].join(races, "session_key")
    return rows.orderBy(F.desc("date_start"), "driver_number", "stint_number", "session_key").select(
        "location", "session_name", F.col("full_name").alias("driver"), "team_name", "stint_number", "compound",
        "stint_laps", "tyre_age_at_start", _rounded("avg_lap_time_on_compound", 3, "avg_lap_time"),
        _rounded("best_lap_time_on_compound", 3, "best_lap_time"),
    )


def weather_impact(tables: Tables, as_of: Day = None, days: int = 90) -> DataFrame:
    """Mean weather beside the best lap, per session with weather.

    Meant as weather rows paired with every lap of the session. Pairing multiplies
    each session's weather by its number of laps and changes no mean within the
    session, so both sides are reduced to a row per session before they meet. The
    number of laps still weighs sessions that share place, name and start.
    """
    measured = {"air_temperature": 1, "track_temperature": 1, "humidity": 0, "wind_speed": 1}
    shown = {
        "air_temperature": "avg_air_temp_c",
        "track_temperature": "avg_track_temp_c",
        "humidity": "avg_humidity_pct",
        "wind_speed": "avg_wind_speed_ms",
    }
    weather = tables["silver_weather"].groupBy("session_key").agg(
        *[exact_total(c).alias(f"{c}_total") for c in measured],
        *[F.count(c).alias(f"{c}_n") for c in measured],
        F.max("rainfall").alias("rainfall"),
    )
    laps = tables["silver_laps"].groupBy("session_key").agg(
        F.count(F.lit(1)).alias("laps"), F.min("lap_duration").alias("best")
    )
    paired = (
        _recent(tables, as_of, days, "location", "session_name", "date_start")
        .join(weather, "session_key")
        .join(laps, "session_key", "left")
        .withColumn("weight", F.coalesce("laps", F.lit(1)).cast("decimal(13,0)"))
    )

    def mean(c: str):
        total = F.sum(F.col(f"{c}_total").cast("decimal(24,10)") * F.col("weight"))
        n = F.sum(F.col(f"{c}_n") * F.col("weight").cast("bigint"))
        return rounded(mean_of(total, n), measured[c]).alias(shown[c])

    return (
        paired.groupBy("location", "session_name", "date_start")
        .agg(
            mean("air_temperature"),
            mean("track_temperature"),
            mean("humidity"),
            F.max("rainfall").alias("rain_detected"),
            mean("wind_speed"),
            rounded(F.min("best"), 3).alias("fastest_lap_in_conditions"),
        )
        .orderBy(F.desc("date_start"), "location", "session_name")
    )


def incidents(tables: Tables, as_of: Day = None, days: int = 90, limit: int = 100) -> DataFrame:
    """Latest flag messages with the driver concerned.

    A session and driver have one name at most, so the name cannot change which
    messages are the latest: it is looked up for those alone.
    """
    flagged = only(tables["silver_race_control"], flag=("YELLOW", "RED", "BLUE"))
    ties = ["session_key", "driver_number", "category", "flag", "message", "lap_number"]
    latest = [F.desc("date"), *null_last(*ties)]
    recent = _recent(tables, as_of, days, "location", "session_name")
    found = top_rows(join_rows(flagged, recent, ["session_key"]), limit, *latest)
    return found.join(names(tables), ENTRY, "left").orderBy(*latest).select(
        "location", "session_name", "date", "category", "flag", "message", "lap_number",
        F.col("full_name").alias("driver_affected"),
    )


def pit_stops(tables: Tables, as_of: Day = None, days: int = 90, limit: int = 50) -> DataFrame:
    """Quickest pit stops of recent races."""
    races = _recent(tables, as_of, days, "location", "session_name", kinds=RACE_TYPES)
    stops = join_rows(tables["silver_pit"].where("pit_duration is not null"), entrants(tables, races), ENTRY)
    return top_rows(stops, limit, *null_last("pit_duration", "date", *ENTRY)).select(
        "location", "session_name", F.col("full_name").alias("driver"), "team_name", "lap_number",
        _rounded("pit_duration", 2, "pit_duration_seconds"), F.col("date").alias("pit_time"),
    )


def speed_trap(tables: Tables, as_of: Day = None, days: int = 90, limit: int = 50) -> DataFrame:
    """Highest speed and engine speed, and mean speed, per session and driver."""
    driven = tables["silver_car_data"].groupBy(*ENTRY).agg(
        F.max("speed").alias("speed"), F.max("rpm").alias("rpm"),
        exact_total("speed").alias("total"), F.count("speed").alias("n"),
    )
    recent = _recent(tables, as_of, days, "location", "session_name")
    shown = ["location", "session_name", "full_name", "team_name"]
    fastest = driven.join(entrants(tables, recent), ENTRY).groupBy(*shown).agg(
        F.max("speed").alias("max_speed_kmh"), F.max("rpm").alias("max_rpm"),
        mean_of(F.sum("total"), F.sum("n")).alias("avg_speed_kmh"),
    )
    return top_rows(fastest, limit, F.desc("max_speed_kmh"), *null_last(*shown)).withColumnRenamed(
        "full_name", "driver"
    )


def overtakes(tables: Tables, as_of: Day = None, days: int = 90, limit: int = 30) -> DataFrame:
    """Most overtakes in recent races."""
    races = _recent(tables, as_of, days, "location", "session_name", "date_start", kinds=RACE_TYPES)
    made = tables["gold_overtakes_analysis"].join(races, "session_key")
    order = [F.desc("overtakes_made"), F.desc("date_start"), *null_last(*ENTRY, "full_name", "team_name")]
    return top_rows(made, limit, *order).select(
        "location", "session_name", F.col("full_name").alias("driver"), "team_name", "overtakes_made"
    )


def race_summary(tables: Tables, limit: int = 20) -> DataFrame:
    """Latest race summaries."""
    latest = top_rows(tables["gold_race_summary"], limit, F.desc("date_start"), F.asc("session_key"))
    return latest.select(
        "session_name", "location", "date_start", "total_laps", _rounded("fastest_lap", 3, "fastest_lap_time"),
        "total_pit_stops", "yellow_flags", "red_flags", "safety_cars", _rounded("avg_air_temp", 1, "avg_air_temp_c"),
        _rounded("avg_track_temp", 1, "avg_track_temp_c"), rain_label(F.col("rainfall_detected")).alias("rain"),
    )


def championship(tables: Tables, as_of: Day = None, days: int = 365) -> DataFrame:
    """Points, wins and podiums from the last known position in each race."""
    races = _recent(tables, as_of, days, kinds="Race")
    finish = latest_value(tables["silver_position"], ENTRY, "position", "date", "final_position")
    place = F.col("final_position")
    return (
        finish.join(entrants(tables, races), ENTRY)
        .groupBy(F.col("full_name").alias("driver"), "team_name")
        .agg(
            F.count_distinct("session_key").alias("races_entered"),
            F.sum(championship_points(place)).alias("total_points"),
            F.count_if(place == 1).alias("wins"),
            F.count_if(place <= 3).alias("podiums"),
        )
        .orderBy(F.desc("total_points"), F.desc("wins"), "driver", "team_name")
    )
