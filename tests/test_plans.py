"""Physical plans: what reaches the scan, what is cut before a shuffle."""

import re

import pytest

import __spark_entry__ as entry
from lapwright.plans import app, dashboard, explore
from lapwright.plans.gold import GOLD
from lapwright.schemas import TABLES
from lapwright.sources.tables import LazyTables, StoredTables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Stored silver tables with gold on top, as after an update."""
    derived = entry.racing_tables(spark, FOLDER)
    tables = StoredTables(spark, str(tmp_path_factory.mktemp("stored")))
    for spec in TABLES.values():
        tables.overwrite(spec.silver, derived[spec.silver], spec.layout)
    silver = {s.silver: (lambda _t, n=s.silver: tables[n]) for s in TABLES.values()}
    return LazyTables({**silver, **GOLD})


@pytest.fixture
def configured(spark):
    """Whole plans in text, and no side small enough to broadcast."""
    settings = {"spark.sql.maxMetadataStringLength": "10000", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def plan(df):
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


def scans(df):
    return [line for line in plan(df).splitlines() if "FileScan" in line]


def test_session_filter_reaches_every_scan(stored, configured):
    for answer in (app.race_overview, app.race_teams, app.race_pits, app.positions):
        found = scans(answer(stored, 0))
        assert found and all("EqualTo(session_key,0)" in s for s in found), answer.__name__


def test_only_needed_columns_are_read(stored):
    laps = [s for s in scans(stored["gold_race_summary"]) if "silver_laps" in s]
    assert len(laps) == 1
    columns = laps[0].split("ReadSchema: struct<")[1]
    assert "segments" not in columns and "speed" not in columns and "duration_sector" not in columns


def test_groups_shuffle_once_and_joins_reuse_it(stored, configured):
    text = plan(stored["gold_driver_performance"])
    # Laps, drivers and pit stops meet on one key: one shuffle each at most.
    assert text.count("Exchange hashpartitioning(session_key, driver_number") == text.count("Exchange ") == 3


def test_stint_join_is_an_equality_join_with_bounds(stored):
    text = plan(stored["gold_tyre_strategy"])
    assert re.search(r"(SortMergeJoin|ShuffledHashJoin|BroadcastHashJoin) \[session_key, driver_number, __slot\]", text)


def test_top_rows_are_taken_without_a_full_sort(stored):
    for df in (dashboard.pit_stops(stored, "2024-04-04"), dashboard.incidents(stored, "2024-04-04"),
               dashboard.fastest_laps(stored, "2024-04-04"), explore.top_drivers(stored), app.fastest_laps(stored)):
        assert "TakeOrderedAndProject" in plan(df)


def test_ranks_are_cut_within_map_tasks(stored):
    assert "WindowGroupLimit" in plan(explore.leaderboard(stored))
    derived = entry.racing_tables(stored["silver_laps"].sparkSession, FOLDER)
    assert "Partial" in plan(derived["silver_laps"]) and "WindowGroupLimit" in plan(derived["silver_laps"])


def test_counts_of_lap_times_are_computed_once(stored, configured):
    df = explore.lap_distribution(stored)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert sum("silver_laps" in line for line in final.splitlines() if "FileScan" in line) == 1
    assert "ReusedExchange" in final
