"""All tables over a mapping of raw records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from lapwright.plans import gold, silver
from lapwright.plans.standings import final_positions, grid_positions
from lapwright.schemas import TABLES
from lapwright.sources.racing_views import raw_tables
from lapwright.sources.tables import LazyTables


def derived_tables(raw: Mapping[str, DataFrame]) -> LazyTables:
    """Bronze, silver and gold tables, each declared when first asked for."""
    known = {**silver.builders(raw), **gold.builders()}
    for endpoint, spec in TABLES.items():
        known[spec.bronze] = lambda _tables, e=endpoint: raw[e]
    return LazyTables(known)


def racing_tables(spark: SparkSession, folder: str) -> LazyTables:
    """Tables over the racing-shaped views of a folder of parquet files.

    These records carry no results; finishing and grid order come from lap times.
    """
    raw = raw_tables(spark, folder)
    complete = LazyTables(
        {
            **{name: (lambda _t, n=name: raw[n]) for name in raw},
            "session_result": lambda _t: final_positions(tables["silver_laps"]),
            "starting_grid": lambda _t: grid_positions(tables["silver_laps"]),
        }
    )
    tables = derived_tables(complete)
    return tables
