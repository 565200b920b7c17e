"""Stored tables in buckets: an update touches what it concerns and ends where a rebuild would."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lapwright.plans import cascade
from lapwright.plans.cascade import PROCESSED_AT, update
from lapwright.plans.quarantine import quarantine
from lapwright.plans.states import STATES, advanced
from lapwright.sources import landing
from lapwright.sources.bucketed import BucketedTables, bucket_of

BUCKETS = 4
DAY = dt.datetime(2024, 3, 1, 14)
LAPS = "session_key int, driver_number int, lap_number int, lap_duration double, is_pit_out_lap boolean, i1_speed int"


def drop(spark, home, endpoint, ddl, *values):
    landing.land(spark.createDataFrame(list(values), ddl).coalesce(1), f"{home}/landing", endpoint)


def run(spark, home, **options):
    return update(spark, f"{home}/landing", f"{home}/lake", buckets=BUCKETS, **options)


def content(done, name):
    hidden = {PROCESSED_AT, "__version"}
    table = done.stored.rows(name)
    return rows(table, *sorted(c for c in table.columns if c not in hidden))


def files_of(done, name):
    """File names by bucket."""
    table = done.stored.rows(name)
    found = table.select("_bucket", F.col("_metadata.file_path").alias("f")).distinct().collect()
    return {b: {r.f for r in found if r["_bucket"] == b} for b in {r["_bucket"] for r in found}}


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    home = str(tmp_path_factory.mktemp("lake"))
    draw = random.Random(4)
    drop(spark, home, "sessions", "session_key int, session_type string, meeting_key int, date_start timestamp, year int",
         *[(s, "Race", 9, DAY, 2024) for s in range(12)])
    drop(spark, home, "drivers", "session_key int, driver_number int, full_name string, team_name string, meeting_key int",
         *[(s, d, f"D{d}", f"T{d % 2}", 9) for s in range(12) for d in (1, 2, 3)])
    drop(spark, home, "overtakes", "session_key int, meeting_key int, overtaking_driver_number int",
         *[(s, 9, draw.choice([1, 2, 3])) for s in range(12) for _ in range(3)])
    drop(spark, home, "laps", LAPS, *[
        (s, d, n, 80 + draw.randrange(900) / 100, draw.choice([False, False, True, None]), 200 + n)
        for s in range(12) for d in (1, 2, 3) for n in range(1, 9)
    ], (None, 1, 1, 70.0, False, 1), (None, None, 2, 71.0, False, 1), (4, 1, -3, 60.0, False, 1), (4, 1, 20, -1.0, False, 1))
    first = run(spark, home)
    before = {n: files_of(first, n) for n in ("silver_laps", "state_pace", "gold_driver_performance", "gold_overtakes_analysis")}
    drop(spark, home, "laps", LAPS, (3, 1, 9, 75.5, False, 300), (3, 2, 1, 1.0, False, 201), (3, 2, 1, 99.0, False, 201),
         (3, 3, 2, -5.0, False, 1), (None, 1, 1, 69.0, False, 1))
    return home, first, before, run(spark, home)


def test_only_touched_buckets_get_new_files(spark, lake):
    _, _, before, second = lake
    key = spark.createDataFrame([(3,), (None,)], "k int").select(bucket_of(F.col("k"), BUCKETS))
    touched = {r[0] for r in key.collect()}
    assert 0 < len(touched) < BUCKETS
    for name in ("silver_laps", "state_pace", "gold_driver_performance"):
        now = files_of(second, name)
        assert {b for b in now if now[b] != before[name].get(b)} == touched, name
    assert files_of(second, "gold_overtakes_analysis") == before["gold_overtakes_analysis"]
    assert "gold_overtakes_analysis" not in second.written and "silver_drivers" not in second.written


def test_an_update_equals_a_rebuild(spark, lake):
    home, first, _, second = lake
    names = [*second.stored]
    got = {n: content(second, n) for n in names}
    old = content(first, "gold_driver_performance")
    third = run(spark, home, rebuild=True)
    assert {"silver_laps", "silver_overtakes", *(n for n in names if not n.startswith("silver"))} <= set(third.written)
    assert {n: content(third, n) for n in names} == got and got["gold_driver_performance"] == old
    laps = third.tables["silver_laps"]
    assert laps.where("session_key = 3 and driver_number = 2 and lap_number = 1").first().lap_duration == 1.0
    assert laps.where("session_key is null and driver_number = 1").first().lap_duration == 69.0
    assert third.metrics["silver_laps"] == second.metrics["silver_laps"]


def test_an_update_that_died_is_caught_up_with(spark, lake, monkeypatch):
    home = lake[0]
    drop(spark, home, "laps", LAPS, (5, 1, 30, 60.0, False, 9))
    with monkeypatch.context() as broken:
        broken.setattr(cascade._Refresh, "state", lambda self, name: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(spark, home)
    drop(spark, home, "laps", LAPS, (6, 1, 30, 61.0, False, 9), (5, 1, 30, 59.0, False, 9))
    done = run(spark, home)
    best = rows(done.tables["gold_fastest_laps"].where("lap_number = 30"), "session_key", "fastest_lap_time")
    assert best == [(5, 59.0), (6, 61.0)]
    got = {n: content(done, n) for n in done.stored}
    again = run(spark, home, rebuild=True)
    assert {n: content(again, n) for n in again.stored} == got
    assert run(spark, home).written == []


def test_refused_rows_and_counts_are_kept(spark, lake):
    home = lake[0]
    done = run(spark, home)
    got = rows(quarantine(done), "table_name", "rules")
    assert got == [("silver_laps", "valid_duration"), ("silver_laps", "valid_lap")]
    history = cascade.rule_history(spark, f"{home}/lake")
    lap = history.where("rule = 'valid_lap'").orderBy("run")
    runs = [(r.passed, r.failed) for r in lap.collect()]
    assert runs[0] == (291, 1) and runs[1] == (292, 1)
    assert rows(history.where("rule = 'valid_session_key'").limit(1), "passed", "failed") == [(12, 0)]


def test_old_versions_and_their_files_go(spark, tmp_path):
    stored = BucketedTables(spark, str(tmp_path))
    frame = lambda *v: spark.createDataFrame([(x, x % 4) for x in v], "a int, _bucket int")
    stored.write("t", frame(*range(8)))
    old = stored["t"]
    stored.write("t", frame(1, 5, 9), buckets={1})
    stored.write("t", frame(13), add=True, buckets={1})
    assert sorted(r.a for r in stored["t"].collect()) == [0, 1, 2, 3, 4, 5, 6, 7, 9, 13]
    assert stored.changed_buckets("t", 1) == {1} and stored.changed_buckets("t", 3) == set()
    assert sorted(r.a for r in old.collect()) == list(range(8))
    stored.prune("t", keep=1)
    assert stored.versions("t") == [3] and not (tmp_path / "t" / "_write=1" / "_bucket=1").exists()
    assert stored.changed_buckets("t", 1) is None
    stored.write("t", frame(), buckets={0})
    assert sorted(r.a for r in stored["t"].collect()) == [1, 2, 3, 5, 6, 7, 9, 13]
    with pytest.raises(KeyError):
        stored["absent"]


@pytest.mark.parametrize("name", ["state_pace", "state_best_lap", "state_race_laps"])
def test_states_merge_and_take_back(spark, name):
    draw, kind = random.Random(name), STATES[name]
    one = lambda v: (draw.choice([1, 2, None]), draw.choice([1, 2, None]), draw.randrange(6), draw.choice([None, 60 + draw.randrange(99) / 8]),
                     draw.choice([True, False, None]), 200, v)
    ddl = "session_key int, driver_number int, lap_number int, lap_duration double, is_pit_out_lap boolean, i1_speed int, v int"
    by_key = lambda many: {r[:3]: r for r in many}
    old = by_key([one(1) for _ in range(30)])
    new = {**old, **by_key([one(2) for _ in range(20)])}
    before, now = (spark.createDataFrame(list(x.values()), ddl).withColumns({"i2_speed": F.lit(1), "st_speed": F.lit(2)}) for x in (old, new))
    got = advanced(kind, kind.of(before), now, now.where("v = 2"), before)
    assert rows(got) == rows(kind.of(now))


def test_states_of_replaced_rows_take_no_join(spark):
    from lapwright.plans import cascade
    from lapwright.schemas import TABLES

    written = {}

    class Stored:
        def manifest(self, name):
            return type("M", (), {"version": 2, "read": {"silver_laps": 1}})

        def changed_buckets(self, name, since):
            return {0}

        def rows(self, name, buckets=None, version=None, kept=None):
            columns = [f"cast({v} as {f.dataType.simpleString()}) as {f.name}" for f, v in ((f, 60 if f.name == "lap_duration" else "false" if f.name == "is_pit_out_lap" else 1 if "number" in f.name else "null") for f in TABLES["laps"].schema)]
            return spark.range(3).selectExpr(*columns, "2 as __version", "0 as _bucket")

        def write(self, name, df, buckets=None, **more):
            written[name] = df

    steps = cascade._Refresh.__new__(cascade._Refresh)
    steps.stored, steps.rebuild = Stored(), False
    assert steps.state("state_best_lap") == "state_best_lap"
    assert "Join" not in written["state_best_lap"]._jdf.queryExecution().optimizedPlan().toString()
    assert written["state_best_lap"].first().best.lap_duration == 60


def test_counts_come_from_file_footers(spark, tmp_path):
    stored = BucketedTables(spark, str(tmp_path))
    listed = spark.conf.get("spark.sql.sources.useV1SourceList")
    frame = lambda *v: spark.createDataFrame([(x, "t", x % 4) for x in v], "a int, b string, _bucket int")
    stored.write("t", frame(*range(8)))
    stored.write("t", frame(1, 5, 9), buckets={1})
    stored.write("t", frame(13, 17), add=True, buckets={1})
    split = frame(*range(10)).withColumn("_kept", F.col("a") < 7)
    stored.write("s", split)
    stored.write("none", frame())
    for name in ("t", "s", "none"):
        assert stored.records(name).first().records == stored[name].count()
    assert rows(stored.records("t", by_bucket=True)) == [(0, 2), (1, 5), (2, 2), (3, 2)]
    for name in ("t", "s"):
        plan = stored.records(name)._jdf.queryExecution().executedPlan().toString()
        assert "PushedAggregation: [COUNT(*)]" in plan and "BatchScan" in plan
    # Other reads are as before.
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == listed
    assert "BatchScan" not in stored["t"]._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(KeyError):
        stored.records("absent")
