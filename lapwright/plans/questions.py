"""Season questions in one line each."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapwright.operators import top_rows
from lapwright.plans.common import ENTRY, Tables, names, null_last

_PERSON = ["full_name", "team_name"]


def pole_positions(tables: Tables) -> DataFrame:
    """Drivers by the number of first grid places."""
    first = tables["silver_starting_grid"].where("position = 1").select(*ENTRY)
    return (
        first.join(names(tables), ENTRY, "left").groupBy(*_PERSON).agg(F.count(F.lit(1)).alias("poles"))
        .orderBy(F.desc("poles"), *_PERSON)
    )


def grid_to_finish(tables: Tables) -> DataFrame:
    """Correlation of starting and final position."""
    grid = tables["silver_starting_grid"].select(*ENTRY, F.col("position").alias("start"))
    result = tables["silver_session_result"].select(*ENTRY, F.col("position").alias("finish"))
    # Sums of whole numbers do not depend on the order of rows.
    x, y = (F.col(c).cast("long") for c in ("start", "finish"))
    sums = grid.join(result, ENTRY).agg(
        F.count(F.lit(1)).alias("entries"), F.count(x + y).alias("n"),
        *[F.sum(F.when((x + y).isNotNull(), v)).alias(name) for name, v in dict(x=x, y=y, xx=x * x, yy=y * y, xy=x * y).items()],
    )
    n, sx, sy, xx, yy, xy = (F.col(c).cast("double") for c in ("n", "x", "y", "xx", "yy", "xy"))
    spread = F.sqrt((n * xx - sx * sx) * (n * yy - sy * sy))
    return sums.select("entries", ((n * xy - sx * sy) / F.nullif(spread, F.lit(0.0))).alias("correlation"))


def longest_pit_stop(tables: Tables) -> DataFrame:
    """The longest pit stop with driver and place."""
    longest = top_rows(
        tables["silver_pit"].where("pit_duration is not null"), 1, F.desc("pit_duration"), *null_last("date", *ENTRY)
    )
    sessions = tables["silver_sessions"].select("session_key", "session_name", "location")
    return longest.join(names(tables), ENTRY, "left").join(sessions, "session_key", "left").select(
        "session_name", "location", *_PERSON, "lap_number", "pit_duration"
    )


def overtakes_by_circuit(tables: Tables) -> DataFrame:
    """Circuits by overtakes made there."""
    per_session = tables["silver_overtakes"].groupBy("session_key").agg(F.count(F.lit(1)).alias("n"))
    place = ["location", "circuit_short_name"]
    sessions = tables["silver_sessions"].select("session_key", *place)
    return (
        per_session.join(sessions, "session_key").groupBy(*place).agg(F.sum("n").alias("overtakes"))
        .orderBy(F.desc("overtakes"), *place)
    )


def tyre_changes(tables: Tables) -> DataFrame:
    """Drivers by tyre changes, one less than the stints of each session."""
    changes = tables["silver_stints"].groupBy(*ENTRY).agg((F.max("stint_number") - 1).alias("changes"))
    return (
        changes.join(names(tables), ENTRY, "left").groupBy(*_PERSON).agg(F.sum("changes").alias("tyre_changes"))
        .orderBy(F.desc("tyre_changes"), *_PERSON)
    )


def safety_car_races(tables: Tables) -> DataFrame:
    """Races with a safety-car message."""
    return (
        tables["gold_race_summary"].where("safety_cars > 0")
        .orderBy(F.desc("safety_cars"), F.desc("date_start"), "session_key")
        .select("session_name", "location", "date_start", "safety_cars")
    )


def team_gaps(tables: Tables) -> DataFrame:
    """How far each team's mean lap is behind the quickest team of the session."""
    # A session has one row per team.
    quickest = F.min("team_avg_lap_time").over(Window.partitionBy("session_key"))
    return tables["gold_team_performance"].select(
        "session_key", "team_name", "team_avg_lap_time",
        (F.col("team_avg_lap_time") - quickest).alias("gap_to_fastest"),
    )
