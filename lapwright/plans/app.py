"""Answers behind an interactive season view.

``year``, ``session_key``, ``driver_numbers`` and ``teams`` narrow an answer; left
out, they ask nothing. Where an answer is about races, choosing a session takes
the place of the race condition, so any kind of session can be looked at.

Answers about a single race give one frame per ``session_key``. Without a key
they answer for all sessions at once, with the key as first column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapwright.functions import exact_mean, fixed_point, mean_of, session_label
from lapwright.functions.measures import exact_total
from lapwright.operators import join_rows, top_rows
from lapwright.plans.common import ENTRY, RACE_TYPES, Tables, chosen_sessions, entrants, names, null_last, only

_LISTED = ["session_key", "session_name", "location", "date_start", "session_type"]

# The compounds that get a column in the usage matrix.
COMPOUNDS = ("SOFT", "MEDIUM", "HARD", "INTERMEDIATE", "WET")


def sessions(tables: Tables, year: int | None = None, session_type: str | Sequence[str] | None = None) -> DataFrame:
    """Sessions to choose from, latest first."""
    found = chosen_sessions(tables, _LISTED[1:], year=year, session_type=session_type)
    return found.distinct().orderBy(F.desc("date_start"), "session_key")


def race_list(tables: Tables, year: int | None = None) -> DataFrame:
    """Races and sprints to choose from, latest first."""
    return sessions(tables, year, RACE_TYPES)


def session_labels(tables: Tables, year: int | None = None, session_type: str | Sequence[str] | None = None) -> DataFrame:
    """Menu entries for the sessions to choose from."""
    label = session_label(F.col("location"), F.col("session_type"), F.col("date_start"))
    return sessions(tables, year, session_type).select("session_key", label.alias("label"))


def metrics(tables: Tables, year: int | None = None) -> DataFrame:
    """Meetings and sessions of the year."""
    return only(tables["silver_sessions"], year=year).agg(
        F.count_distinct("meeting_key").alias("total_races"),
        F.count_distinct("session_key").alias("total_sessions"),
    )


def driver_count(tables: Tables, year: int | None = None) -> DataFrame:
    """Drivers seen in the year."""
    listed = tables["silver_drivers"].select(*ENTRY).join(chosen_sessions(tables, [], year=year), "session_key")
    return listed.agg(F.count_distinct("driver_number").alias("total_drivers"))


def recent_races(tables: Tables, year: int | None = None, limit: int = 10) -> DataFrame:
    """Latest sessions with the teams that took part, by name."""
    shown = ["session_name", "location", "country_name", "date_start", "session_type"]
    teams = tables["silver_drivers"].select("session_key", "team_name").distinct()
    listed = (
        chosen_sessions(tables, shown, year=year)
        .join(teams, "session_key", "left")
        .groupBy(*shown)
        .agg(F.array_sort(F.collect_set("team_name")).alias("found"))
    )
    ties = null_last("session_name", "location", "country_name", "session_type")
    return top_rows(listed, limit, F.desc("date_start"), *ties).select(
        *shown, F.size("found").cast("bigint").alias("teams_count"), F.concat_ws(", ", "found").alias("teams")
    )


def fastest_laps(tables: Tables, year: int | None = None, places: int = 10, limit: int = 10) -> DataFrame:
    """Fastest laps among the best of each session; all years unless one is given."""
    best = tables["gold_fastest_laps"].where(F.col("rank") <= places)
    if year is not None:
        best = best.join(chosen_sessions(tables, [], year=year), "session_key", "left_semi")
    return top_rows(best, limit, *null_last("fastest_lap_time", *ENTRY)).select(
        F.col("full_name").alias("driver"), "team_name", "location", F.col("fastest_lap_time").alias("lap_time")
    )


def driver_list(tables: Tables, year: int | None = None, session_key: int | None = None) -> DataFrame:
    """Drivers to choose from."""
    picked = chosen_sessions(tables, [], year=year, session_key=session_key)
    return entrants(tables, picked).select("full_name", "driver_number").distinct().orderBy(
        "full_name", "driver_number"
    )


def driver_numbers(drivers: DataFrame, chosen_names: Sequence[str]) -> DataFrame:
    """Numbers of the drivers chosen by name."""
    return only(drivers, full_name=list(chosen_names)).select("driver_number")


def _driven(tables: Tables, columns, year, session_key, drivers=None, session_type=None) -> DataFrame:
    """Driver performance of chosen sessions, under the names in the drivers table."""
    picked = chosen_sessions(tables, columns, year=year, session_key=session_key, session_type=session_type)
    driven = only(tables["gold_driver_performance"], driver_number=drivers).drop("full_name", "team_name")
    return driven.join(entrants(tables, picked), ENTRY)


def driver_stats(
    tables: Tables, year: int | None = None, session_key: int | None = None, drivers: Sequence[int] | None = None
) -> DataFrame:
    """Season figures of chosen drivers."""
    return (
        _driven(tables, [], year, session_key, drivers)
        .groupBy(F.col("full_name").alias("driver"), "team_name")
        .agg(
            F.count_distinct("session_key").alias("sessions_count"),
            exact_mean("fastest_lap_time").alias("avg_fastest_lap"),
            F.min("fastest_lap_time").alias("best_lap"),
            exact_mean("pit_stop_count").alias("avg_pit_stops"),
            F.max("max_speed_st").alias("top_speed"),
        )
        .orderBy("avg_fastest_lap", "driver", "team_name")
    )


def driver_cards(stats: DataFrame) -> DataFrame:
    """Driver figures as they are written on screen."""
    return stats.select(
        "driver", "team_name", F.col("sessions_count").cast("string").alias("sessions"),
        F.concat(fixed_point(F.col("avg_fastest_lap"), 3), F.lit("s")).alias("avg_best_lap"),
        F.concat(fixed_point(F.col("best_lap"), 3), F.lit("s")).alias("fastest_lap"),
        fixed_point(F.col("avg_pit_stops"), 1).alias("avg_pit_stops"),
        F.concat(fixed_point(F.col("top_speed"), 0), F.lit(" km/h")).alias("top_speed"),
    )


def lap_progression(
    tables: Tables, year: int | None = None, session_key: int | None = None, drivers: Sequence[int] | None = None
) -> DataFrame:
    """Best and mean lap of chosen drivers from session to session."""
    return (
        _driven(tables, ["location", "date_start"], year, session_key, drivers)
        .orderBy("date_start", "full_name", *ENTRY)
        .select(F.col("full_name").alias("driver"), "location", "date_start", "fastest_lap_time", "avg_lap_time")
    )


def team_stats(tables: Tables, year: int | None = None, session_key: int | None = None) -> DataFrame:
    """Race figures per team."""
    return (
        _driven(tables, [], year, session_key, session_type="Race")
        .groupBy("team_name")
        .agg(
            F.count_distinct("session_key").alias("race_count"),
            exact_mean("fastest_lap_time").alias("avg_fastest_lap"),
            F.min("fastest_lap_time").alias("best_lap"),
            exact_mean("max_speed_st").alias("avg_max_speed"),
            F.max("max_speed_st").alias("top_speed"),
            exact_mean("pit_stop_count").alias("avg_pit_stops"),
        )
        .orderBy("avg_fastest_lap", "team_name")
    )


def team_pits(tables: Tables, year: int | None = None, session_key: int | None = None) -> DataFrame:
    """Pit stop figures per team in races."""
    picked = chosen_sessions(tables, [], year=year, session_key=session_key, session_type="Race")
    stops = tables["silver_pit"].groupBy(*ENTRY).agg(
        exact_total("pit_duration").alias("total"), F.count("pit_duration").alias("timed"),
        F.min("pit_duration").alias("least"), F.count(F.lit(1)).alias("stops"),
    )
    return stops.join(entrants(tables, picked), ENTRY).groupBy("team_name").agg(
        mean_of(F.sum("total"), F.sum("timed")).alias("avg_pit_duration"),
        F.min("least").alias("fastest_pit_stop"),
        F.sum("stops").alias("total_pit_stops"),
    )


def team_merged(tables: Tables, year: int | None = None, session_key: int | None = None) -> DataFrame:
    """Race and pit stop figures per team, side by side."""
    pits = team_pits(tables, year, session_key).withColumnRenamed("team_name", "pit_team")
    return (
        team_stats(tables, year, session_key)
        .join(pits, F.col("team_name").eqNullSafe(F.col("pit_team")), "left")
        .drop("pit_team")
        .orderBy("avg_fastest_lap", "team_name")
    )


def team_leaders(merged: DataFrame) -> DataFrame:
    """Number of teams, the quickest on track and the quickest in the pits."""

    def best(metric: str):
        # A team without the figure is no candidate.
        return F.min_by("team_name", F.when(F.col(metric).isNotNull(), F.struct(metric, "avg_fastest_lap", "team_name")))

    return merged.agg(
        F.count(F.lit(1)).alias("total_teams"),
        best("avg_fastest_lap").alias("fastest_team"),
        best("avg_pit_duration").alias("fastest_pit_team"),
    )


def _per_race(session_key: int | None, *columns):
    return [*([] if session_key is not None else ["session_key"]), *columns]


def race_overview(tables: Tables, session_key: int | None = None) -> DataFrame:
    """Drivers, pace, speed and pit stops of a race in one row."""
    driven = only(tables["gold_driver_performance"], session_key=session_key)
    return driven.groupBy(*_per_race(session_key)).agg(
        F.count_distinct("driver_number").alias("total_drivers"),
        exact_mean("fastest_lap_time").alias("avg_fastest_lap"),
        F.min("fastest_lap_time").alias("fastest_lap"),
        F.max("max_speed_st").alias("top_speed"),
        exact_mean("max_speed_st").alias("avg_speed"),
        F.sum("pit_stop_count").alias("total_pit_stops"),
    )


def race_cards(overview: DataFrame) -> DataFrame:
    """Race figures as they are written on screen."""
    kept = [c for c in overview.columns if c == "session_key"]
    return overview.select(
        *kept,
        F.col("total_drivers").cast("string").alias("total_drivers"),
        F.concat(fixed_point(F.col("fastest_lap"), 3), F.lit("s")).alias("fastest_lap"),
        F.concat(fixed_point(F.col("avg_fastest_lap"), 3), F.lit("s")).alias("avg_lap_time"),
        F.concat(fixed_point(F.col("top_speed"), 0), F.lit(" km/h")).alias("top_speed"),
        F.col("total_pit_stops").cast("string").alias("total_pit_stops"),
    )


def race_drivers(tables: Tables, session_key: int | None = None, limit: int | None = None) -> DataFrame:
    """Driver figures of a race, quickest first; ``limit`` keeps the first rows for a chart."""
    driven = only(tables["gold_driver_performance"], session_key=session_key).drop("full_name", "team_name")
    order = null_last(*_per_race(session_key, "fastest_lap_time", "driver_number"))
    rows = driven.join(names(tables), ENTRY).orderBy(*order)
    if limit is not None:
        rows = rows.limit(limit)
    return rows.select(
        *_per_race(session_key), F.col("full_name").alias("Driver"), F.col("team_name").alias("Team"),
        F.col("fastest_lap_time").alias("fastest_lap"), "avg_lap_time", F.col("max_speed_st").alias("max_speed"),
        "pit_stop_count",
    )


def race_pits(tables: Tables, session_key: int | None = None) -> DataFrame:
    """Pit stops of a race by lap."""
    stops = only(tables["silver_pit"], session_key=session_key)
    return (
        join_rows(stops, names(tables), ENTRY)
        .orderBy(*_per_race(session_key, "lap_number", "date", "driver_number"))
        .select(
            *_per_race(session_key), F.col("full_name").alias("driver"), "team_name", "lap_number", "pit_duration",
            F.col("date").alias("pit_time"),
        )
    )


def race_pit_means(tables: Tables, session_key: int | None = None) -> DataFrame:
    """Mean pit stop per named driver of a race."""
    who = _per_race(session_key, "full_name", "team_name")
    stops = only(tables["silver_pit"], session_key=session_key).groupBy(*ENTRY).agg(
        exact_total("pit_duration").alias("total"), F.count("pit_duration").alias("timed")
    )
    named = stops.join(names(tables).dropna(), ENTRY)
    means = named.groupBy(*who).agg(mean_of(F.sum("total"), F.sum("timed")).alias("pit_duration"))
    return means.withColumnRenamed("full_name", "driver").orderBy(*_per_race(session_key, "driver", "team_name"))


def positions(tables: Tables, session_key: int | None = None, spread: bool | None = None) -> DataFrame:
    """Positions over the time of a race; ``spread`` says whether frequent keys are joined in slots."""
    seen = only(tables["silver_position"], session_key=session_key)
    return (
        join_rows(seen, names(tables), ENTRY, spread=spread)
        .orderBy(*_per_race(session_key, "date", "position", "driver_number"))
        .select(*_per_race(session_key), F.col("full_name").alias("driver"), "team_name", "date", "position")
    )


def race_teams(tables: Tables, session_key: int | None = None) -> DataFrame:
    """Team figures of a race."""
    driven = only(tables["gold_driver_performance"], session_key=session_key).drop("full_name", "team_name")
    return (
        driven.join(names(tables), ENTRY)
        .groupBy(*_per_race(session_key, "team_name"))
        .agg(
            F.count_distinct("driver_number").alias("drivers"),
            exact_mean("fastest_lap_time").alias("avg_lap"),
            F.min("fastest_lap_time").alias("best_lap"),
            exact_mean("max_speed_st").alias("avg_speed"),
            F.sum("pit_stop_count").alias("total_pits"),
        )
        .orderBy(*_per_race(session_key, "avg_lap", "team_name"))
    )


def team_list(tables: Tables, year: int | None = None, session_key: int | None = None) -> DataFrame:
    """Teams to choose from in race sessions."""
    picked = chosen_sessions(tables, [], year=year, session_key=session_key, session_type="Race")
    return entrants(tables, picked).select("team_name").distinct().orderBy("team_name")


def _stints(tables: Tables, year, session_key, teams) -> DataFrame:
    picked = chosen_sessions(tables, [], year=year, session_key=session_key, session_type="Race")
    raced = only(entrants(tables, picked), team_name=teams or None)
    return tables["gold_tyre_strategy"].drop("full_name", "team_name").join(raced, ENTRY)


def _usage():
    return [
        exact_mean("avg_lap_time_on_compound").alias("avg_lap_time"),
        exact_mean("stint_laps").alias("avg_stint_length"),
        F.count(F.lit(1)).alias("usage_count"),
    ]


def tyres_by_team(
    tables: Tables, year: int | None = None, session_key: int | None = None, teams: Sequence[str] | None = None
) -> DataFrame:
    """Pace, stint length and use per compound and team."""
    rows = _stints(tables, year, session_key, teams).groupBy("compound", "team_name").agg(*_usage())
    return rows.orderBy("compound", "avg_lap_time", "team_name")


def compound_summary(
    tables: Tables, year: int | None = None, session_key: int | None = None, teams: Sequence[str] | None = None
) -> DataFrame:
    """Pace, stint length, use and teams per compound."""
    rows = _stints(tables, year, session_key, teams).groupBy("compound").agg(
        *_usage(), F.count_distinct("team_name").alias("teams_used")
    )
    return rows.orderBy("avg_lap_time", "compound")


def compound_share(summary: DataFrame) -> DataFrame:
    """Share of each compound in all stints; the summary has one row per compound."""
    whole = F.sum("usage_count").over(Window.partitionBy())
    return summary.select("compound", "usage_count", (F.col("usage_count") / whole).alias("usage_share"))


def stint_quartiles(by_team: DataFrame, *by: str) -> DataFrame:
    """Least, quartiles and greatest of the teams' mean stint lengths.

    Grouped by compound and team unless told otherwise; a group has a row per team
    at most.
    """
    quartiles = F.percentile("avg_stint_length", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    spread = by_team.groupBy(*(by or ("compound", "team_name"))).agg(
        F.min("avg_stint_length").alias("min"), quartiles.alias("q"), F.max("avg_stint_length").alias("max")
    )
    kept = [c for c in spread.columns if c not in ("q", "min", "max")]
    return spread.select(
        *kept, "min", *[F.col("q")[i].alias(n) for i, n in enumerate(("q1", "median", "q3"))], "max"
    )


def usage_matrix(by_team: DataFrame, compounds: Sequence[str] | None = None) -> DataFrame:
    """Stints per team and compound: a column for each usual compound, then one for each other that was used.

    Unless ``compounds`` lists them, the compounds are looked up first: a few words, whatever the number of stints.
    """
    if compounds is None:
        used = {r[0] for r in by_team.where("team_name is not null and compound is not null").select("compound").distinct().collect()}
        compounds = [*COMPOUNDS, *sorted(used.difference(COMPOUNDS))]
    return (
        by_team.where("team_name is not null")
        .groupBy("team_name")
        .pivot("compound", list(compounds))
        .agg(F.sum("usage_count"))
        .fillna(0)
        .orderBy("team_name")
    )
