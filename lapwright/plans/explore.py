"""Exploration answers over silver and gold tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwright.functions import exact_mean, mean_of, rain_label, rounded, track_temperature_band
from lapwright.functions.measures import exact_total, stddev_of
from lapwright.functions.wording import band_order
from lapwright.operators import exact_quantile, top_rows
from lapwright.operators.audit import row_counts
from lapwright.operators.quantiles import value_counts
from lapwright.plans.common import Tables, clear_laps, null_last, only


def _mean_min(column: str, mean: str, least: str):
    return exact_mean(column).alias(mean), F.min(column).alias(least)


def counts(tables: Tables, names: Sequence[str] = ("bronze_meetings", "bronze_sessions")) -> DataFrame:
    """Records per table."""
    return row_counts(tables, names)


def session_types(tables: Tables) -> DataFrame:
    """How many sessions of each type, and when the first and last were."""
    return (
        tables["silver_sessions"].groupBy("session_type")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.min("date_start").alias("first_session"),
            F.max("date_start").alias("last_session"),
        )
        .orderBy(F.desc("count"), "session_type")
    )


def driver_sessions(tables: Tables) -> DataFrame:
    """Sessions per driver as listed."""
    person = ["full_name", "name_acronym", "team_name", "country_code"]
    listed = tables["silver_drivers"].groupBy(*person).agg(F.count_distinct("session_key").alias("sessions_count"))
    return listed.orderBy(*person)


def top_drivers(tables: Tables, limit: int = 15) -> DataFrame:
    """Drivers by the mean of their best laps."""
    season = tables["gold_driver_performance"].groupBy("full_name", "team_name").agg(
        *_mean_min("fastest_lap_time", "avg_fastest_lap", "best_lap_ever"),
        exact_mean("pit_stop_count").alias("avg_pit_stops"),
        F.max("max_speed_st").alias("top_speed"),
        F.count_distinct("session_key").alias("races"),
    )
    return top_rows(season, limit, F.asc("avg_fastest_lap"), *null_last("full_name", "team_name"))


def driver_trend(tables: Tables) -> DataFrame:
    """Best lap and pit stops per driver from race to race."""
    races = only(tables["silver_sessions"], session_type="Race").select("session_key", "date_start", "location")
    shown = ["date_start", "location", "full_name", "team_name", "fastest_lap_time", "pit_stop_count"]
    return (
        tables["gold_driver_performance"].join(races, "session_key")
        .orderBy("date_start", "fastest_lap_time", "session_key", "driver_number")
        .select(*shown)
    )


def team_comparison(tables: Tables) -> DataFrame:
    """Season figures per team."""
    season = tables["gold_team_performance"].groupBy("team_name").agg(
        *_mean_min("team_fastest_lap", "avg_fastest_lap", "best_team_lap"),
        exact_mean("team_avg_pit_duration").alias("avg_pit_duration"),
        exact_mean("total_team_pit_stops").alias("avg_team_pit_stops"),
        F.max("team_max_speed").alias("max_speed"),
        F.count_distinct("session_key").alias("races"),
    )
    return season.orderBy("avg_fastest_lap", "team_name")


def race_summary(tables: Tables) -> DataFrame:
    """All race summaries, latest first."""
    return tables["gold_race_summary"].orderBy(F.desc("date_start"), "session_key").select(
        "session_name", "location", "date_start", "total_laps", "fastest_lap", "total_pit_stops", "yellow_flags",
        "red_flags", "safety_cars", "avg_air_temp", "avg_track_temp",
        rain_label(F.col("rainfall_detected")).alias("rain"),
    )


def _stint_figures(tables: Tables, *by: str):
    return tables["gold_tyre_strategy"].where("compound is not null").groupBy(*by)


def tyre_performance(tables: Tables) -> DataFrame:
    """Use, pace and stint length per compound."""
    return (
        _stint_figures(tables, "compound")
        .agg(
            F.count(F.lit(1)).alias("usage_count"),
            exact_mean("avg_lap_time_on_compound").alias("avg_lap_time"),
            F.min("best_lap_time_on_compound").alias("best_lap_time"),
            exact_mean("stint_laps").alias("avg_stint_length"),
        )
        .orderBy("avg_lap_time", "compound")
    )


def team_tyres(tables: Tables) -> DataFrame:
    """Use, pace and stint length per team and compound."""
    return (
        _stint_figures(tables, "team_name", "compound")
        .agg(
            F.count(F.lit(1)).alias("times_used"),
            exact_mean("avg_lap_time_on_compound").alias("avg_performance"),
            exact_mean("stint_laps").alias("avg_stint_length"),
        )
        .orderBy("team_name", "avg_performance", "compound")
    )


def weather_bands(tables: Tables) -> DataFrame:
    """Races by track temperature, coldest band first."""
    band = track_temperature_band(F.col("avg_track_temp")).alias("track_temp_category")
    return (
        tables["gold_race_summary"].where("avg_track_temp is not null").groupBy(band)
        .agg(
            F.count(F.lit(1)).alias("races"),
            exact_mean("fastest_lap").alias("avg_fastest_lap"),
            exact_mean("total_pit_stops").alias("avg_pit_stops"),
            exact_mean("safety_cars").alias("avg_safety_cars"),
        )
        .orderBy(band_order(F.col("track_temp_category")))
    )


def lap_distribution(tables: Tables) -> DataFrame:
    """Best, mean, median and spread of clear race laps per circuit.

    Everything is worked out from the count of each lap time per circuit, so one
    grouping of the laps serves all figures and the median needs no task that
    holds all laps of a circuit.
    """
    circuit = ["location", "circuit_short_name"]
    races = only(tables["silver_sessions"], session_type="Race").select("session_key", *circuit)
    # Equal times of a session are counted before the join, so a session with very many laps is no hot key there.
    per_session = value_counts(clear_laps(tables), ["session_key"], "lap_duration")
    times = value_counts(per_session.join(races, "session_key"), circuit, "lap_duration", weight="n")
    x, n = F.col("lap_duration"), F.col("n")
    total, squares = exact_total(x * n), exact_total(x * x * n)
    figures = times.groupBy(*circuit).agg(
        F.sum("n").alias("total_laps"),
        F.min(x).alias("fastest_lap"),
        mean_of(total, F.sum("n")).alias("avg_lap"),
        stddev_of(F.sum("n"), total, squares).alias("lap_consistency"),
    )
    medians = exact_quantile(times, circuit, "lap_duration", 0.5, "median")
    medians = medians.select(F.col("median").alias("median_lap"), *[F.col(c).alias(f"m_{c}") for c in circuit])
    same = [F.col(c).eqNullSafe(F.col(f"m_{c}")) for c in circuit]
    return (
        figures.join(medians, same)
        .orderBy("fastest_lap", *circuit)
        .select(*circuit, "total_laps", "fastest_lap", "avg_lap", "median_lap", "lap_consistency")
    )


def overtakes(tables: Tables) -> DataFrame:
    """Overtakes of the season and per race, of drivers who made any."""
    return (
        tables["gold_overtakes_analysis"].groupBy("full_name", "team_name")
        .agg(F.sum("overtakes_made").alias("total_overtakes"), F.count_distinct("session_key").alias("races"))
        .where("total_overtakes > 0")
        .withColumn("overtakes_per_race", rounded(F.col("total_overtakes") / F.col("races"), 2))
        .orderBy(F.desc("total_overtakes"), "full_name", "team_name")
    )


def leaderboard(tables: Tables, places: int = 20) -> DataFrame:
    """Laps that rank among the first places of their session."""
    return (
        tables["gold_fastest_laps"].where(F.col("rank") <= places)
        .orderBy("fastest_lap_time", "session_key", "rank")
        .select("rank", "full_name", "team_name", "location", "lap_number", "fastest_lap_time", "date_start")
    )


def data_quality(tables: Tables) -> DataFrame:
    """Records, distinct keys and missing values of three tables.

    The columns carry the names of the first line: for laps they count sessions
    and missing times, for telemetry drivers and missing speeds.
    """
    checked = (
        ("drivers", "driver_number", "full_name"),
        ("laps", "session_key", "lap_duration"),
        ("car_data", "driver_number", "speed"),
    )
    lines = [
        tables[f"silver_{name}"].agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("total_records"),
            F.count_distinct(key).alias("unique_drivers"),
            F.count_if(F.col(value).isNull()).alias("missing_names"),
        )
        for name, key, value in checked
    ]
    return lines[0].unionByName(lines[1]).unionByName(lines[2])
