"""Whole updates: landing to answers, incremental, again in full, and half-way failures."""

import datetime as dt
from types import SimpleNamespace

import pytest

from conftest import rows
from lapwright.plans import checks, dashboard, explore, landed
from lapwright.plans.cascade import PROCESSED_AT, update
from lapwright.sources import landing
from lapwright.sources.bucketed import BucketedTables
from lapwright.sources.tables import StoredTables, list_tables, preview, register, save_as_table, table

DAY = dt.datetime(2024, 3, 1, 14)


@pytest.fixture(scope="module")
def updated(spark, tmp_path_factory):
    home = str(tmp_path_factory.mktemp("cascade"))

    def drop(endpoint, ddl, *values):
        landing.land(spark.createDataFrame(list(values), ddl), f"{home}/landing", endpoint)

    drop("sessions", "session_key int, session_type string, meeting_key int, session_name string, location string, "
         "date_start timestamp, year int", (1, "Race", 9, "S1", "Spa", DAY, 2024))
    drop("drivers", "session_key int, driver_number int, full_name string, team_name string, meeting_key int",
         (1, 44, "A", "T", 9), (1, 16, "B", "U", 9))
    laps = "session_key int, driver_number int, lap_number int, lap_duration double, is_pit_out_lap boolean"
    drop("laps", laps, (1, 44, 1, 91.0, False), (1, 44, 1, 91.0, False), (1, 16, 1, 90.0, False), (1, 16, 2, -1.0, False))
    first = update(spark, f"{home}/landing", f"{home}/lake", buckets=4)
    drop("laps", laps, (1, 44, 2, 89.0, False))
    second = update(spark, f"{home}/landing", f"{home}/lake")
    third = update(spark, f"{home}/landing", f"{home}/lake", full_refresh=True)
    return home, first, second, third


def test_updates_add_only_new_records(updated):
    _, first, second, third = updated
    assert first.ingested == {"sessions": 1, "drivers": 2, "laps": 4}
    assert second.ingested == {"sessions": 0, "drivers": 0, "laps": 1}
    assert third.ingested == {"sessions": 1, "drivers": 2, "laps": 5}
    assert len(first.written) == 15 + 7 + 6
    assert [n for n in second.written if n.startswith("silver")] == ["silver_laps"]
    # Nothing about pit stops, weather, messages or overtakes is written again.
    assert {n for n in second.written if n.startswith("state")} == {"state_pace", "state_best_lap", "state_race_laps"}
    assert "gold_overtakes_analysis" not in second.written and len(second.written) == 1 + 3 + 5
    assert third.metrics["silver_laps"] == {"rows": 4, "valid_lap": 0, "valid_duration": 1}
    assert set(third.malformed.values()) == {0}


def test_nothing_new_writes_nothing_and_a_part_can_be_refreshed(spark, tmp_path):
    home = str(tmp_path)
    for endpoint in ("drivers", "laps"):
        landing.land(spark.createDataFrame([(1, 44)], "session_key int, driver_number int"), f"{home}/landing", endpoint)
    update(spark, f"{home}/landing", f"{home}/lake")
    assert update(spark, f"{home}/landing", f"{home}/lake").written == []
    part = update(spark, f"{home}/landing", f"{home}/lake", endpoints=["laps"], full_refresh=True)
    assert part.tables["silver_drivers"].count() == 1
    assert [n for n in part.written if n.startswith("silver")] == ["silver_laps"]
    again = update(spark, f"{home}/landing", f"{home}/lake")
    assert again.tables["silver_drivers"].count() == 1 and again.tables["bronze_drivers"].count() == 1


def test_a_failed_stream_does_not_stop_the_others(spark, tmp_path, monkeypatch):
    from lapwright.plans.cascade import PartlyFailed
    from lapwright.streaming.bronze import Bronze

    home, run = str(tmp_path), Bronze._run
    for endpoint in ("drivers", "laps"):
        landing.land(spark.createDataFrame([(1, 44)], "session_key int, driver_number int"), f"{home}/landing", endpoint)

    def broken(self, endpoint):
        if endpoint == "laps":
            raise ValueError("no such store")
        return run(self, endpoint)

    monkeypatch.setattr(Bronze, "_run", broken)
    with pytest.raises(PartlyFailed, match="laps: no such store") as told:
        update(spark, f"{home}/landing", f"{home}/lake")
    assert told.value.done.tables["silver_drivers"].count() == 1
    monkeypatch.undo()
    done = update(spark, f"{home}/landing", f"{home}/lake")
    assert "silver_laps" in done.written and done.tables["bronze_laps"].count() == 1


def test_broken_lines_are_counted_and_kept_out(spark, tmp_path):
    home = str(tmp_path)
    landing.land(spark.createDataFrame([(1, 44)], "session_key int, driver_number int"), f"{home}/landing", "position")
    (tmp_path / "landing" / "position" / "cut.json").write_text('{"session_key": 1, "driver_num\n')
    done = update(spark, f"{home}/landing", f"{home}/lake")
    assert done.malformed["position"] == 1 and done.metrics["silver_position"]["rows"] == 1
    assert done.tables["silver_position"].count() == 1


def test_tables_follow(updated):
    _, _, second, third = updated
    for done in (second, third):
        perf = done.tables["gold_driver_performance"]
        assert rows(perf, "driver_number", "fastest_lap_time", "total_laps") == [(16, 90.0, 1), (44, 89.0, 2)]
        assert PROCESSED_AT in perf.columns
        best = dashboard.fastest_laps(done.tables, as_of="2024-04-01").collect()
        assert [(r["rank"], r.driver) for r in best] == [(1, "A"), (2, "B")]
    assert rows(third.tables["bronze_laps"], "lap_number") == [(1,)] * 3 + [(2,)] * 2


def test_tables_by_name_in_sql(spark, updated):
    tables = updated[2].tables
    register(tables, ["silver_laps", "silver_sessions"])
    assert {"silver_laps", "silver_sessions"} <= set(list_tables(spark))
    assert spark.sql("select count(*) n from silver_laps l join silver_sessions using (session_key)").first().n == 3
    assert preview(table(spark, "silver_laps"), 2).count() == 2


def test_audits_see_missing_tables(spark, updated):
    home = updated[0]
    audit = checks.expected_tables(spark, updated[2].tables)
    assert {r.table_name: (r.exists, r.records) for r in audit.collect()} == {
        n: (True, updated[2].tables[n].count()) for n in checks.ALL_TABLES
    }
    # Counts come from file footers: no table is scanned for them.
    plan = audit._jdf.queryExecution().optimizedPlan().toString()
    assert "Relation [" not in plan and plan.count("RelationV2[count(") + plan.count("RelationV2[COUNT(") > 5
    nothing = StoredTables(spark, f"{home}/nowhere")
    assert rows(checks.app_tables(spark, nothing), "exists", "records") == [(False, None)] * 4
    assert list(nothing) == [] and len(nothing) == 0


def test_old_versions_are_pruned(spark, tmp_path):
    stored = StoredTables(spark, str(tmp_path))
    folders = [stored.overwrite("t", spark.createDataFrame([(n,)], "a int")) for n in range(4)]
    before = stored["t"]
    stored.overwrite("t", spark.createDataFrame([(9,)], "a int"))
    stored.prune("t", keep=2)
    assert rows(before) == [(3,)] and rows(stored["t"]) == [(9,)]
    assert stored._versions("t") == [4, 5] and len(folders) == 4


def test_a_failed_rewrite_leaves_the_table(spark, tmp_path):
    stored = StoredTables(spark, str(tmp_path))
    stored.overwrite("t", spark.createDataFrame([(1,)], "a int"))
    with pytest.raises(Exception):
        stored.overwrite("t", spark.range(100).selectExpr("assert_true(id < 50) as a"))
    assert rows(stored["t"]) == [(1,)]
    stored.overwrite("t", spark.createDataFrame([(2, "x")], "a int, b string"), layout=("a",))
    assert rows(stored["t"]) == [(2, "x")] and list(stored) == ["t"]
    with pytest.raises(KeyError):
        stored["absent"]


def test_an_answer_can_be_kept(spark, updated, tmp_path):
    spark.sql(f"create database if not exists kept location '{tmp_path}/kept'")
    for _ in range(2):
        save_as_table(explore.top_drivers(updated[2].tables), "kept.analysis_top_drivers")
    assert table(spark, "kept.analysis_top_drivers").count() == 2
    assert "analysis_top_drivers" in list_tables(spark, "kept")


def test_an_update_broadcasts_no_stored_table(spark, tmp_path, monkeypatch):
    """Stored tables read compressed look small however many rows they have."""
    home, plans = str(tmp_path), {}
    write = BucketedTables.write

    def noted(self, name, df, *args, **named):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(self, name, df, *args, **named)

    monkeypatch.setattr(BucketedTables, "write", noted)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for endpoint, ddl, row in (
        ("sessions", "session_key int, meeting_key int, session_name string", (1, 9, "S1")),
        ("drivers", "session_key int, driver_number int, full_name string", (1, 44, "A")),
        ("laps", "session_key int, driver_number int, lap_number int, lap_duration double, is_pit_out_lap boolean", (1, 44, 1, 91.5, False)),
    ):
        landing.land(spark.createDataFrame([row], ddl), f"{home}/landing", endpoint)
    update(spark, f"{home}/landing", f"{home}/lake", buckets=4)
    assert "SortMergeJoin" in plans["gold_fastest_laps"] and not [n for n, p in plans.items() if "Broadcast" in p]
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == threshold


def test_the_corrected_answer_broadcasts_no_stored_table(spark, racing, tmp_path, monkeypatch):
    made, kept = racing(), {}
    for name in ("driver_performance", "fastest_laps", "team_performance", "race_summary", "overtakes_analysis"):
        made[f"gold_{name}"].write.parquet(f"{tmp_path}/{name}")
        kept[f"gold_{name}"] = spark.read.parquet(f"{tmp_path}/{name}")
    monkeypatch.setattr(landed, "three_drops", lambda *_: SimpleNamespace(tables=kept))
    plan = landed.corrected(spark, kept)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 4 and "Broadcast" not in plan
