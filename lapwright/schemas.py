"""What is known about each table: columns, key, quality rules, hints, layout.

Column names and types, key columns, rule predicates, hint types and layout
keys are fixed values: they define the tables that users query.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql.types import StructType


# Raw column with the text of a record that did not fit its columns.
RESCUED = "_rescued_data"


@dataclass(frozen=True)
class Rule:
    """A named predicate that a row has to satisfy (NULL does not satisfy it)."""

    name: str
    predicate: str
    drops: bool = True


@dataclass(frozen=True)
class TableSpec:
    endpoint: str
    columns: str
    hints: str = ""
    key: tuple[str, ...] = ()
    rules: tuple[Rule, ...] = ()
    layout: tuple[str, ...] = ()
    # Columns beyond the listed ones are kept as they arrive.
    open_schema: bool = False

    @cached_property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.columns)

    @property
    def hint_schema(self) -> StructType:
        return StructType.fromDDL(self.hints) if self.hints else StructType()

    @property
    def bronze(self) -> str:
        return f"bronze_{self.endpoint}"

    @property
    def silver(self) -> str:
        return f"silver_{self.endpoint}"


_SPECS = (
    TableSpec(
        "meetings",
        "meeting_key int, meeting_name string, meeting_official_name string, location string, "
        "country_name string, country_code string, circuit_short_name string, circuit_key int, "
        "date_start timestamp, year int, gmt_offset string",
        hints="meeting_key int, year int",
        key=("meeting_key",),
        rules=(
            Rule("valid_meeting_key", "meeting_key IS NOT NULL"),
            Rule("valid_year", "year BETWEEN 2018 AND 2030"),
        ),
        layout=("meeting_key", "year"),
    ),
    TableSpec(
        "sessions",
        "session_key int, session_name string, session_type string, meeting_key int, location string, "
        "country_name string, country_code string, circuit_short_name string, circuit_key int, "
        "date_start timestamp, date_end timestamp, gmt_offset string, year int",
        hints="session_key int, meeting_key int, year int",
        key=("session_key",),
        rules=(
            Rule("valid_session_key", "session_key IS NOT NULL"),
            Rule("valid_meeting_key", "meeting_key IS NOT NULL"),
        ),
        layout=("session_key", "meeting_key"),
    ),
    TableSpec(
        "drivers",
        "driver_number int, broadcast_name string, full_name string, first_name string, last_name string, "
        "name_acronym string, team_name string, team_colour string, country_code string, session_key int, "
        "meeting_key int, headshot_url string",
        hints="driver_number int, session_key int, meeting_key int",
        key=("driver_number", "session_key"),
        rules=(Rule("valid_driver_number", "driver_number IS NOT NULL"),),
        layout=("driver_number", "session_key"),
    ),
    TableSpec(
        "laps",
        "session_key int, meeting_key int, driver_number int, lap_number int, date_start timestamp, "
        "lap_duration double, is_pit_out_lap boolean, duration_sector_1 double, duration_sector_2 double, "
        "duration_sector_3 double, i1_speed int, i2_speed int, st_speed int, segments_sector_1 string, "
        "segments_sector_2 string, segments_sector_3 string",
        hints="session_key int, driver_number int, lap_number int",
        key=("session_key", "driver_number", "lap_number"),
        rules=(
            Rule("valid_lap", "lap_number > 0"),
            Rule("valid_duration", "lap_duration IS NULL OR lap_duration > 0"),
        ),
        layout=("session_key", "driver_number", "lap_number"),
    ),
    TableSpec(
        "pit",
        "session_key int, meeting_key int, driver_number int, date timestamp, lap_number int, pit_duration double",
        hints="session_key int, driver_number int, lap_number int",
        key=("session_key", "driver_number", "date"),
        layout=("session_key", "driver_number"),
    ),
    TableSpec(
        "stints",
        "session_key int, meeting_key int, driver_number int, stint_number int, lap_start int, lap_end int, "
        "compound string, tyre_age_at_start int",
        hints="session_key int, driver_number int, stint_number int",
        key=("session_key", "driver_number", "stint_number"),
        layout=("session_key", "driver_number", "stint_number"),
    ),
    TableSpec(
        "car_data",
        "session_key int, meeting_key int, driver_number int, date timestamp, speed int, rpm int, n_gear int, "
        "throttle int, brake int, drs int",
        hints="session_key int, driver_number int, speed int, rpm int",
        rules=(
            Rule("valid_speed", "speed BETWEEN 0 AND 400", drops=False),
            Rule("valid_rpm", "rpm BETWEEN 0 AND 15000", drops=False),
        ),
        layout=("session_key", "driver_number", "date"),
    ),
    TableSpec(
        "position",
        "session_key int, meeting_key int, driver_number int, date timestamp, position int",
        hints="session_key int, driver_number int, position int",
        layout=("session_key", "driver_number", "date"),
    ),
    TableSpec(
        "weather",
        "session_key int, meeting_key int, date timestamp, air_temperature double, track_temperature double, "
        "humidity int, pressure double, rainfall int, wind_speed double, wind_direction int",
        hints="session_key int, meeting_key int",
        key=("session_key", "date"),
        layout=("session_key", "date"),
    ),
    TableSpec(
        "race_control",
        "session_key int, meeting_key int, date timestamp, category string, flag string, lap_number int, "
        "message string, scope string, sector int, driver_number int",
        hints="session_key int, meeting_key int, driver_number int",
        layout=("session_key", "date"),
    ),
    TableSpec(
        "team_radio",
        "session_key int, meeting_key int, driver_number int, date timestamp, recording_url string",
        hints="session_key int, driver_number int",
        layout=("session_key", "driver_number", "date"),
    ),
    TableSpec(
        "intervals",
        "session_key int, meeting_key int, driver_number int, date timestamp, gap_to_leader double, interval double",
        hints="session_key int, driver_number int",
    ),
    TableSpec(
        "overtakes",
        "session_key int, meeting_key int, overtaking_driver_number int, overtaken_driver_number int, "
        "date timestamp, position int",
        open_schema=True,
    ),
    TableSpec(
        "session_result",
        "session_key int, meeting_key int, driver_number int, position int",
        open_schema=True,
    ),
    TableSpec(
        "starting_grid",
        "session_key int, meeting_key int, driver_number int, position int",
        open_schema=True,
    ),
)

TABLES: dict[str, TableSpec] = {spec.endpoint: spec for spec in _SPECS}

# Gold tables and the columns they are clustered by.
GOLD_LAYOUT: dict[str, tuple[str, ...]] = {
    "gold_driver_performance": ("session_key", "driver_number"),
    "gold_race_summary": (),
    "gold_tyre_strategy": (),
    "gold_fastest_laps": (),
    "gold_overtakes_analysis": (),
    "gold_team_performance": (),
}
GOLD_FROM_GOLD = ("gold_team_performance",)
GOLD_FROM_SILVER = tuple(n for n in GOLD_LAYOUT if n not in GOLD_FROM_GOLD)
