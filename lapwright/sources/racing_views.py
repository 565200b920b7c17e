"""Racing-shaped raw records over general business tables.

Each view is a list of expressions over a source; the expressions are text that
Spark SQL and other SQL engines read alike, so that a check outside Spark can
start from the same records. They only shape data.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwright.sources.tables import LazyTables

# Source relations: how Spark builds them, and the same in SQL text.
_NUMBER = "cast(l_partkey % 20 + 1 as int)"
_EVENT_SESSION = "user_id % 10"
_EVENT_DRIVER = "event_id % 20 + 1"

SOURCE_SQL = {
    "nation_region": "nation join region on n_regionkey = r_regionkey",
    "supplier_nation_region": (
        "supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey"
    ),
    "lineitem": "lineitem",
    "entries": (
        "(select distinct l_suppkey, l_partkey % 20 as seat from lineitem) as e join supplier on l_suppkey = s_suppkey"
    ),
    "events": "events",
    "events_supplier": "events join supplier on user_id % 10 = s_suppkey",
}


@dataclass(frozen=True)
class View:
    source: str
    columns: dict[str, str]
    where: str | None = None


VIEWS: dict[str, View] = {
    "meetings": View(
        "nation_region",
        {
            "meeting_key": "n_nationkey",
            "meeting_name": "n_name",
            "location": "n_name",
            "country_name": "r_name",
            "year": "2023 + n_nationkey % 3",
        },
    ),
    "sessions": View(
        "supplier_nation_region",
        {
            "session_key": "s_suppkey",
            "session_name": "concat('Session ', cast(s_suppkey as string))",
            "session_type": (
                "case s_suppkey % 5 when 0 then 'Race' when 1 then 'Sprint' when 2 then 'Qualifying' "
                "when 3 then 'Practice' else 'Race' end"
            ),
            "meeting_key": "s_nationkey",
            "location": "n_name",
            "country_name": "r_name",
            "circuit_short_name": "concat('C', cast(n_regionkey as string))",
            "circuit_key": "n_regionkey",
            "date_start": "timestamp '2024-01-01 14:00:00' + (s_suppkey % 365) * interval '1' day",
            "date_end": "timestamp '2024-01-01 16:00:00' + (s_suppkey % 365) * interval '1' day",
            "year": "2024 + s_suppkey % 2",
        },
    ),
    "drivers": View(
        "entries",
        {
            "driver_number": "cast(seat + 1 as int)",
            "full_name": "concat('Driver ', cast(seat + 1 as string))",
            "name_acronym": "concat('D', cast(seat + 1 as string))",
            "team_name": "concat('Team ', cast(cast(floor(seat / 2) as int) as string))",
            "country_code": "concat('N', cast((seat + 1) % 5 as string))",
            "session_key": "l_suppkey",
            "meeting_key": "s_nationkey",
        },
        where="not (seat = 19 and l_suppkey % 4 = 0)",
    ),
    "laps": View(
        "lineitem",
        {
            "session_key": "l_suppkey",
            "driver_number": _NUMBER,
            "lap_number": "cast(l_orderkey % 60 + 1 as int)",
            "date_start": "l_shipdate",
            "lap_duration": "case when l_discount = 0 then null else l_extendedprice / 1000 end",
            "is_pit_out_lap": "case when l_returnflag = 'A' and l_tax = 0 then null else l_returnflag = 'R' end",
            "i1_speed": "cast(200 + l_quantity as int)",
            "i2_speed": "cast(250 + l_quantity as int)",
            "st_speed": "cast(280 + l_quantity as int)",
        },
    ),
    "pit": View(
        "lineitem",
        {
            "session_key": "l_suppkey",
            "driver_number": _NUMBER,
            "date": "l_shipdate",
            "lap_number": "cast(l_orderkey % 60 + 1 as int)",
            "pit_duration": "18 + l_tax * 100",
        },
        where="l_returnflag = 'R' and l_linenumber = 1",
    ),
    "weather": View(
        "events",
        {
            "session_key": "event_id % 10",
            "date": "ts",
            "air_temperature": "15 + value / 20",
            "track_temperature": "20 + value / 12",
            "humidity": "cast(event_id % 60 + 30 as int)",
            "pressure": "1000 + value / 100",
            "rainfall": "case when event_type = 'error' and value > 300 then 1 else 0 end",
            "wind_speed": "value / 50",
            "wind_direction": "cast(event_id % 360 as int)",
        },
    ),
    "race_control": View(
        "events",
        {
            "session_key": _EVENT_SESSION,
            "date": "ts",
            "category": "case event_type when 'error' then 'SafetyCar' when 'purchase' then 'Other' else 'Flag' end",
            "flag": (
                "case event_type when 'click' then 'YELLOW' when 'signup' then 'RED' when 'view' then 'BLUE' "
                "else null end"
            ),
            "message": "props",
            "driver_number": f"case when event_id % 3 = 0 then null else {_EVENT_DRIVER} end",
        },
    ),
    "position": View(
        "events",
        {
            "session_key": _EVENT_SESSION,
            "driver_number": _EVENT_DRIVER,
            "date": "ts",
            "position": "user_id % 20 + 1",
        },
        where="event_type in ('view', 'click')",
    ),
    "overtakes": View(
        "events_supplier",
        {
            "session_key": _EVENT_SESSION,
            "meeting_key": "s_nationkey",
            "overtaking_driver_number": _EVENT_DRIVER,
            "overtaken_driver_number": "(event_id + 7) % 20 + 1",
            "date": "ts",
            "position": f"cast({_EVENT_DRIVER} as int)",
        },
        where="event_type = 'purchase'",
    ),
    "intervals": View(
        "events",
        {
            "session_key": _EVENT_SESSION,
            "driver_number": _EVENT_DRIVER,
            "date": "ts",
            "gap_to_leader": "case when event_type = 'error' then '+1 LAP' else cast(value as string) end",
            "interval": "value / 4",
        },
    ),
    "team_radio": View(
        "events",
        {
            "session_key": _EVENT_SESSION,
            "driver_number": _EVENT_DRIVER,
            "date": "ts",
            "recording_url": "concat('https://radio.example/', cast(event_id as string), '.mp3')",
        },
        where="event_type = 'signup'",
    ),
    "car_data": View(
        "events",
        {
            "session_key": _EVENT_SESSION,
            "driver_number": _EVENT_DRIVER,
            "date": "ts",
            "speed": "cast(floor(value) as int)",
            "rpm": "cast(floor(value * 40) as int)",
            "n_gear": "cast(event_id % 8 + 1 as int)",
            "throttle": "cast(event_id % 101 as int)",
            "brake": "case when event_type = 'error' then 100 else 0 end",
            "drs": "cast(event_id % 15 as int)",
        },
    ),
    # Text-only variants with values that do not parse and rows that break rules.
    "dirty_meetings": View(
        "nation_region",
        {
            "meeting_key": "cast(n_nationkey as string)",
            "meeting_name": "n_name",
            "location": "n_name",
            "country_name": "r_name",
            "year": "cast(2016 + n_nationkey % 16 as string)",
        },
    ),
    "keyless_meetings": View(
        "nation_region",
        {
            "meeting_key": "cast(null as string)",
            "meeting_name": "n_name",
            "location": "n_name",
            "country_name": "r_name",
            "year": "'2024'",
        },
        where="n_nationkey < 2",
    ),
    "dirty_laps": View(
        "lineitem",
        {
            "session_key": "cast(l_suppkey as string)",
            "driver_number": f"cast({_NUMBER} as string)",
            "lap_number": "case when l_orderkey % 97 = 0 then null else cast(l_orderkey % 61 as string) end",
            "lap_duration": (
                "case when l_discount = 0 then null when l_orderkey % 50 = 7 then 'n/a' "
                "when l_orderkey % 50 = 8 then concat('-', cast(l_extendedprice / 1000 as string)) "
                "else cast(l_extendedprice / 1000 as string) end"
            ),
            "is_pit_out_lap": "case when l_returnflag = 'R' then 'true' else 'false' end",
        },
    ),
}


def _sources(read: Callable[[str], DataFrame]) -> dict[str, Callable[[], DataFrame]]:
    def nation_region():
        return read("nation").join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))

    def supplier_nation_region():
        return read("supplier").join(nation_region(), F.col("s_nationkey") == F.col("n_nationkey"))

    def entries():
        pairs = read("lineitem").selectExpr("l_suppkey", "l_partkey % 20 as seat").distinct()
        return pairs.join(read("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))

    def events_supplier():
        return read("events").join(read("supplier"), F.expr("user_id % 10 = s_suppkey"))

    return {
        "nation_region": nation_region,
        "supplier_nation_region": supplier_nation_region,
        "lineitem": lambda: read("lineitem"),
        "entries": entries,
        "events": lambda: read("events"),
        "events_supplier": events_supplier,
    }


def _shape(view: View, source: DataFrame) -> DataFrame:
    rows = source.where(view.where) if view.where else source
    return rows.selectExpr(*[f"{text} as `{name}`" for name, text in view.columns.items()])


def _stints(laps: DataFrame) -> DataFrame:
    """Three stints of twenty laps for every driver of a session."""
    return (
        laps.select("session_key", "driver_number")
        .distinct()
        .withColumn("stint_number", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
        .selectExpr(
            "session_key",
            "driver_number",
            "stint_number",
            "20 * (stint_number - 1) + 1 as lap_start",
            "20 * stint_number as lap_end",
            "case (stint_number + driver_number) % 3 when 0 then 'SOFT' when 1 then 'MEDIUM' else 'HARD' end "
            "as compound",
            "cast((session_key + stint_number) % 4 as int) as tyre_age_at_start",
        )
    )


def raw_tables(spark: SparkSession, folder: str) -> Mapping[str, DataFrame]:
    """Raw records by endpoint, plus the ``dirty_*`` variants."""

    read = functools.cache(lambda name: spark.read.parquet(f"{folder}/{name}.parquet"))

    sources = _sources(read)

    def builder(view: View):
        return lambda _tables: _shape(view, sources[view.source]())

    builders = {name: builder(view) for name, view in VIEWS.items() if name != "keyless_meetings"}
    builders["dirty_meetings"] = lambda _tables: _shape(
        VIEWS["dirty_meetings"], sources["nation_region"]()
    ).unionByName(_shape(VIEWS["keyless_meetings"], sources["nation_region"]()))
    builders["stints"] = lambda tables: _stints(tables["laps"])
    return LazyTables(builders)
