"""Audits of what was landed and of which tables exist."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwright.operators import first_n, violations
from lapwright.operators.audit import row_counts, table_audit
from lapwright.plans.common import ENTRY, Tables
from lapwright.plans.silver import distinct_typed
from lapwright.schemas import GOLD_LAYOUT, TABLES

APP_TABLES = ("silver_sessions", "silver_drivers", "gold_driver_performance", "gold_fastest_laps")
RULED = tuple(endpoint for endpoint, spec in TABLES.items() if spec.rules)
ALL_TABLES = (*[spec.silver for spec in TABLES.values()], *GOLD_LAYOUT)


def telemetry(
    tables: Tables,
    min_speed: int | None = None,
    since: str | dt.datetime | None = None,
    until: str | dt.datetime | None = None,
) -> DataFrame:
    """Telemetry at or above a speed and within a time span; each bound is optional."""
    rows = tables["silver_car_data"]
    if min_speed is not None:
        rows = rows.where(F.col("speed") >= min_speed)
    if since is not None:
        rows = rows.where(F.col("date") >= F.lit(str(since)).cast("timestamp"))
    if until is not None:
        rows = rows.where(F.col("date") <= F.lit(str(until)).cast("timestamp"))
    return rows


def _expected(tables: Tables, drivers_per_session: int | None) -> DataFrame:
    listed = tables["silver_drivers"].select(*ENTRY)
    if drivers_per_session is None:
        return listed
    return first_n(listed, ["session_key"], ["driver_number"], drivers_per_session)


def telemetry_sample(
    tables: Tables, min_speed: int | None = 50, drivers_per_session: int | None = None
) -> DataFrame:
    """Telemetry of all listed drivers, or of the first so many of each session."""
    return telemetry(tables, min_speed).join(_expected(tables, drivers_per_session), ENTRY, "left_semi")


def telemetry_coverage(
    tables: Tables, min_speed: int = 50, drivers_per_session: int | None = None
) -> DataFrame:
    """Drivers with and without telemetry per session, and those lost to the speed bound."""
    found = tables["silver_car_data"].groupBy(*ENTRY).agg(F.count_if(F.col("speed") >= min_speed).alias("fast"))
    available = F.count_if(F.col("fast").isNotNull())
    filtered = F.count_if(F.col("fast") > 0)
    return (
        _expected(tables, drivers_per_session)
        .join(found, ENTRY, "left")
        .groupBy("session_key")
        .agg(
            F.count(F.lit(1)).alias("expected"),
            available.alias("available"),
            (F.count(F.lit(1)) - available).alias("missing"),
            filtered.alias("available_fast"),
            (available - filtered).alias("lost_to_speed"),
        )
        .orderBy("session_key")
    )


def telemetry_totals(coverage: DataFrame) -> DataFrame:
    """Successful and expected fetches over all sessions; the summary is a fixed phrase of the ingest log."""
    total, ok = F.coalesce(F.sum("expected"), F.lit(0)), F.coalesce(F.sum("available_fast"), F.lit(0))
    return coverage.agg(
        total.alias("total_fetches"),
        ok.alias("successful"),
        F.concat(ok.cast("string"), F.lit("/"), total.cast("string"), F.lit(" fetches successful")).alias("summary"),
    )


def telemetry_missing(tables: Tables) -> DataFrame:
    """Listed drivers of a session without any telemetry."""
    seen = tables["silver_car_data"].select(*ENTRY).distinct()
    return _expected(tables, None).join(seen, ENTRY, "left_anti")


def landed_counts(
    tables: Tables, names: Sequence[str] = ("meetings", "sessions", "car_data", "laps")
) -> DataFrame:
    """Raw records per endpoint."""
    counted = row_counts(tables, [TABLES[n].bronze for n in names])
    return counted.withColumn("table_name", F.regexp_replace("table_name", "^bronze_", ""))


def app_tables(spark: SparkSession, tables: Tables) -> DataFrame:
    """The tables that the season view cannot do without."""
    return table_audit(spark, tables, APP_TABLES)


def expected_tables(spark: SparkSession, tables: Tables) -> DataFrame:
    """All silver and gold tables."""
    return table_audit(spark, tables, ALL_TABLES)


def rule_report(raw: Tables, endpoints: Sequence[str] = RULED) -> DataFrame:
    """Rows that pass and fail each data-quality rule."""
    reports = [violations(distinct_typed(raw[e], TABLES[e]), TABLES[e]) for e in endpoints]
    return reduce(DataFrame.unionByName, reports)
