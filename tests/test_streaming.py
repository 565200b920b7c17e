"""Landing files to raw tables: each file once, across runs, failures and new columns."""

import datetime as dt
import os
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lapwright.plans import landed
from lapwright.plans.silver import clean
from lapwright.sources import landing
from lapwright.sources.raw_schema import merge
from lapwright.streaming import bronze
from lapwright.streaming.bronze import Bronze
from pyspark.sql.types import StructType


@pytest.fixture
def home(tmp_path):
    return str(tmp_path)


def drop(spark, home, endpoint, ddl, *values, **options):
    landing.land(spark.createDataFrame(list(values), ddl), f"{home}/landing", endpoint, **options)


def open_bronze(spark, home):
    return bronze.Bronze(spark, f"{home}/landing", f"{home}/raw")


def test_two_drops_one_checkpoint_and_a_new_column(spark, home):
    drop(spark, home, "laps", "session_key int, lap_number int, lap_duration double", (1, 1, 90.5), (1, 2, None))
    first = open_bronze(spark, home)
    assert first.ingest(["laps", "pit"]) == {"laps": 2}
    assert first.ingest(["laps"]) == {"laps": 0}
    drop(spark, home, "laps", "session_key int, lap_number int, tyre string", (1, 3, "SOFT"))
    second = open_bronze(spark, home)  # a new run over the same folders
    assert second.ingest(["laps"]) == {"laps": 1}
    table = second["laps"]
    assert rows(table, "lap_number", "lap_duration", "tyre") == [(1, 90.5, None), (2, None, None), (3, None, "SOFT")]
    # Hinted types, also for a column no record has.
    assert dict(table.dtypes)["lap_number"] == "int" and dict(table.dtypes)["driver_number"] == "int"
    assert table.where("_ingestion_timestamp is null or _source_file is null").count() == 0
    files = second.files("laps")
    assert bronze.ingested_files(second, "laps").count() == files.count() == second.listing("laps").count()
    assert rows(bronze.ledger(second, ["laps"])) == [("laps", 3, 0, files.count())]


def test_type_change_is_rescued_not_lost(spark, home):
    drop(spark, home, "intervals", "session_key int, interval double", (1, 0.5))
    raw = open_bronze(spark, home)
    raw.ingest(["intervals"])
    drop(spark, home, "intervals", "session_key int, interval string", (2, "+1 LAP"))
    raw.ingest(["intervals"])
    assert rows(raw["intervals"], "session_key", "interval") == [(1, 0.5), (2, None)]
    kept = raw["intervals"].where("session_key = 2").first()["_rescued_data"]
    assert "+1 LAP" in kept


def test_measures_are_not_frozen_as_whole_numbers(spark, home):
    drop(spark, home, "laps", "session_key int, lap_number int, lap_duration int, i1_speed int", (1, 1, 90, 300))
    raw = open_bronze(spark, home)
    raw.ingest(["laps"])
    drop(spark, home, "laps", "session_key int, lap_number int, lap_duration double, i1_speed string", (1, 2, 90.5, "301"))
    raw.ingest(["laps"])
    typed = clean(bronze.arrived(raw["laps"]), "laps")
    assert rows(typed, "lap_number", "lap_duration", "i1_speed") == [(1, 90.0, 300), (2, 90.5, 301)]


def test_files_with_an_old_time_are_read(spark, home):
    drop(spark, home, "pit", "session_key int", (1,))
    raw = open_bronze(spark, home)
    raw.ingest(["pit"])
    drop(spark, home, "pit", "session_key int, reason string", (2, "tyres"))
    old = time.time() - 30 * 86400
    for file in Path(home, "landing", "pit").rglob("*.json"):
        if "tyres" in file.read_text():
            os.utime(file, (old, old))
    assert raw.unread("pit").count() == 1
    assert raw.ingest(["pit"]) == {"pit": 1}
    assert rows(raw["pit"], "session_key", "reason") == [(1, None), (2, "tyres")]
    assert raw.unread("pit").count() == 0


def test_records_of_many_batches_are_counted(spark, home):
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    for i in range(5):
        drop(spark, home, "pit", "session_key int", (i,))
    raw = bronze.Bronze(spark, f"{home}/landing", f"{home}/raw", batch_bytes=1)
    assert raw.ingest(["pit"]) == {"pit": 5}
    spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_wider_values_of_columns_that_nobody_listed(spark, home):
    """25, then 12.5, then words: nothing is lost, and nothing has to be read from the files again."""
    drop(spark, home, "overtakes", "session_key int, points int, tags array<int>", (1, 25, [1]))
    raw = open_bronze(spark, home)
    raw.ingest(["overtakes"])
    assert dict(raw["overtakes"].dtypes)["points"] == "bigint"
    drop(spark, home, "overtakes", "session_key int, points double, tags array<double>", (2, 12.5, [0.5]))
    raw.ingest(["overtakes"])
    got = clean(bronze.arrived(raw["overtakes"]), "overtakes")
    assert rows(got, "session_key", "points", "tags") == [(1, 25.0, [1.0]), (2, 12.5, [0.5])]
    drop(spark, home, "overtakes", "session_key int, points string, `odd name` struct<`a b`: int>", (3, "none", (7,)))
    raw.ingest(["overtakes"])
    got = open_bronze(spark, home)["overtakes"]
    assert rows(got, "points") == [("12.5",), ("25",), ("none",)]
    assert got.where("`odd name`.`a b` = 7").count() == 1


def test_values_that_do_not_fit_a_hint_are_rescued(spark, home):
    file = Path(home, "landing", "pit", "x.json")
    file.parent.mkdir(parents=True)
    file.write_text('{"session_key": 1.5, "lap_number": 3}\n{"session_key": "7", "lap_number": 4000000000, "pit_duration": null}\n{}\n')
    raw = open_bronze(spark, home)
    assert raw.ingest(["pit"]) == {"pit": 3}
    got = sorted(raw["pit"].collect(), key=lambda r: repr(r.lap_number))
    assert [(r.session_key, r.lap_number) for r in got] == [(None, 3), (7, None), (None, None)]
    assert "1.5" in got[0]["_rescued_data"] and "4000000000" in got[1]["_rescued_data"] and got[2]["_rescued_data"] is None
    assert bronze.arrived(raw["pit"]).count() == 3


def test_lines_that_are_no_records_and_files_without_any(spark, home):
    folder = Path(home, "landing", "pit")
    folder.mkdir(parents=True)
    (folder / "a.json").write_text('{"session_key": 1}\n\n{"session_key": \n[1, 2]\nnull\n')
    (folder / "blank.json").write_text("\n \n")
    raw = open_bronze(spark, home)
    time.sleep(2.1)  # older than the run
    assert raw.ingest(["pit"]) == {"pit": 4}
    assert raw.unread("pit").count() == 0
    assert rows(raw.files("pit"), "records", "malformed") == [(0, 0), (1, 3)]
    assert rows(bronze.malformed(raw["pit"]), "_rescued_data") == [("[1, 2]",), ("null",), ('{"session_key": ',)]
    assert bronze.arrived(raw["pit"]).count() == 1
    assert raw.ingest(["pit"]) == {"pit": 0} and raw.files("pit").count() == 2


def test_unread_reads_the_ledger_and_not_the_table(spark, home):
    drop(spark, home, "pit", "session_key int", (1,))
    raw = open_bronze(spark, home)
    raw.ingest(["pit"])
    files = raw.unread("pit")
    assert all("/_ledger/" in f or "/landing/" in f for f in files.inputFiles())
    plan = raw["pit"]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == plan.count("Scan") == 1 and "struct<record:struct<" in plan


def test_many_small_batches_are_brought_together(spark, home):
    raw = bronze.Bronze(spark, f"{home}/landing", f"{home}/raw", batch_bytes=1)
    for i in range(12):
        drop(spark, home, "pit", "session_key int", (i,))
    assert raw.ingest(["pit"]) == {"pit": 12}
    before = raw["pit"]
    assert len(raw._folders("pit")) >= 12 and raw.compact("pit") == 1
    assert sorted(r[0] for r in raw["pit"].select("session_key").collect()) == list(range(12))
    assert sorted(r[0] for r in before.select("session_key").collect()) == list(range(12))  # who reads still can
    drop(spark, home, "pit", "session_key int", (12,))
    again = open_bronze(spark, home)
    assert again.ingest(["pit"]) == {"pit": 1} and again.last_batch("pit") > raw.last_batch("pit") - 1
    assert again.since("pit", again.last_batch("pit") - 1).count() <= 1 and again.since("pit", 0).count() >= 12
    assert again.compact("pit", target_bytes=1) >= 2 and again.compact("pit") == 1
    assert sorted(r[0] for r in again["pit"].select("session_key").collect()) == list(range(13))
    assert rows(bronze.ledger(again, ["pit"]), "records") == [(13,)]


def test_new_generation_reads_everything_again(spark, home):
    drop(spark, home, "pit", "session_key int", (1,), (2,))
    raw = open_bronze(spark, home)
    raw.ingest(["pit"])
    again = raw.restarted()
    assert "pit" not in again
    assert again.ingest(["pit"]) == {"pit": 2}
    assert open_bronze(spark, home).generation == 2
    assert again["pit"].count() == 2 and raw["pit"].count() == 2


def test_restart_after_a_failed_run(spark, home, monkeypatch):
    drop(spark, home, "pit", "session_key int, pit_duration double", *[(n, 20.0) for n in range(50)])
    raw = open_bronze(spark, home)
    healthy = raw.stream
    bad = F.when(F.expr("variant_get(record, '$.session_key', 'int')") == 30, F.raise_error(F.lit("boom")))
    monkeypatch.setattr(raw, "stream", lambda e: healthy(e).where(F.coalesce(bad.cast("int"), F.lit(0)) == 0))
    with pytest.raises(Exception, match="boom"):
        raw.ingest(["pit"])
    monkeypatch.undo()
    assert open_bronze(spark, home).ingest(["pit"]) == {"pit": 50}
    assert open_bronze(spark, home)["pit"].select("session_key").distinct().count() == 50


def test_batches_files_and_hidden_names(spark, home):
    ddl = "session_key int, driver_number int, speed int"
    df = spark.createDataFrame([(s, d, v) for s in (1, 2) for d in (4, 44) for v in range(30)], ddl)
    landing.land_batches(df, f"{home}/landing", "car_data")
    landing.land(df.coalesce(1), f"{home}/landing", "car_data", records_per_file=50)
    listed = landing.data_files(spark, f"{home}/landing", "car_data")
    names = [r.path for r in listed.collect()]
    assert len(names) == 4 + 3 and all("/_" not in n for n in names)
    assert sum("batch=session_key_1_driver_number_44/" in n for n in names) == 1
    assert landing.read_landed(spark, f"{home}/landing", "car_data").count() == 240
    raw = open_bronze(spark, home)
    assert raw.ingest(["car_data"]) == {"car_data": 240}
    assert raw["car_data"].where("driver_number = 44").count() == 120


def test_empty_batch_lands_nothing_to_read(spark, home):
    drop(spark, home, "pit", "session_key int")
    assert open_bronze(spark, home).ingest(["pit"]) in ({}, {"pit": 0})


def test_replacing_an_endpoint(spark, home):
    drop(spark, home, "meetings", "meeting_key int", (1,))
    landing.replace_endpoint(spark.createDataFrame([(2,)], "meeting_key int"), f"{home}/landing", "meetings")
    assert rows(landing.read_landed(spark, f"{home}/landing", "meetings")) == [(2,)]


def test_landed_times_keep_microseconds(spark, home):
    at = dt.datetime(2024, 3, 1, 14, 0, 0, 123456)
    drop(spark, home, "pit", "session_key int, date timestamp", (1, at))
    assert landing.read_landed(spark, f"{home}/landing", "pit").first().date == "2024-03-01T14:00:00.123456Z"


def test_schema_merge_only_widens():
    known = StructType.fromDDL("a int, b double")
    found = StructType.fromDDL("b string, c bigint, d bigint")
    got = merge(known, found, StructType.fromDDL("d int, e int"))
    assert got.simpleString() == "struct<a:int,b:string,d:int,e:int,c:bigint>"
    assert merge(got, StructType.fromDDL("c double"), StructType(), None)["c"].dataType.simpleString() == "double"
    listed = merge(known, found, StructType(), known)
    assert listed["b"].dataType.simpleString() == "double"  # a listed number stays one; the text stays in the record


def test_many_small_batches_share_files(spark, home):
    """One file may hold many batches; each record still tells its batch, and tables do not show the name."""
    values = [(s, d, n) for s in range(300) for d in (4, 44) for n in range(s % 3 + 1)] + [(None, 4, 1)]
    df = spark.createDataFrame(values, "session_key int, driver_number int, lap_number int")
    landing.land_packed(df, f"{home}/landing", "pit")
    assert landing.data_files(spark, f"{home}/landing", "pit").count() < 50
    raw = open_bronze(spark, home)
    assert raw.ingest(["pit"]) == {"pit": len(values)}
    found = raw["pit"].groupBy(landing.LANDED_BATCH).count().collect()
    assert len(found) == 601 and {r[1] for r in found} == {1, 2, 3}
    counts = dict(map(tuple, found))
    assert counts["session_key_5_driver_number_44"] == 3 and counts["session_key_driver_number_4"] == 1
    assert sorted(bronze.records(raw["pit"]).columns) == ["driver_number", "lap_number", "session_key"]
    assert landing.LANDED_BATCH not in bronze.arrived(raw["pit"]).columns


def test_compressed_files_are_small_and_read_by_several_tasks(spark, home, monkeypatch):
    monkeypatch.setattr(landing, "RECORDS", 1000)
    df = spark.range(5000).selectExpr("id as session_key", "'a message that is always the same' as message").coalesce(1)
    landing.land(df, f"{home}/landing", "race_control", compressed=True)
    landing.land(df, f"{home}/plain", "race_control")
    small, plain = ([r.length for r in landing.data_files(spark, f"{home}/{at}", "race_control").collect()] for at in ("landing", "plain"))
    assert len(small) == 5 and sum(small) * 4 < sum(plain)
    assert landing.read_landed(spark, f"{home}/landing", "race_control").count() == 5000
    raw = open_bronze(spark, home)
    assert raw.ingest(["race_control"]) == {"race_control": 5000} and raw.ingest(["race_control"]) == {"race_control": 0}
    assert raw["race_control"].select("session_key").distinct().count() == 5000 and raw.unread("race_control").isEmpty()


def test_broken_lines_are_told_by_what_is_stored(spark, home):
    """Records with misfits, lines that are none: told apart without taking a column out of a record, and without a task for nothing."""
    drop(spark, home, "laps", "session_key string, lap_number string, lap_duration string", ("1", "1", "90.5"), ("2", "x", "n/a"))
    Path(home, "landing", "laps", "more.json").write_text('{"session_key": 3}\nnot a record\n{"session_key": \n  {"lap_number": 4}\n[1]\n')
    raw = open_bronze(spark, home)
    raw.ingest(["laps"])
    assert rows(raw.arrived("laps")) == rows(bronze.arrived(raw["laps"])) and raw.arrived("laps").count() == 4
    assert rows(raw.malformed("laps")) == rows(bronze.malformed(raw["laps"])) and raw.malformed("laps").count() == 3
    for table in (raw.arrived("laps"), raw.malformed("laps")):
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert "Filter" in plan and not [x for x in plan.splitlines() if "Filter" in x and "variant_get" in x]
    assert raw.arrived("laps", raw.last_batch("laps")).rdd.getNumPartitions() == 0


def test_landed_endpoints_follow_each_other_compressed_and_leave_no_files(spark, racing, tmp_path, monkeypatch):
    """On disk at a time: the landed files of one endpoint, and no shuffle of an earlier one."""
    seen, ingest = [], Bronze.ingest

    def noted(self, endpoints, failed=None):
        names = [str(p.relative_to(tmp_path / "home" / "landing")) for p in (tmp_path / "home" / "landing").rglob("part-*")]
        seen.append((list(endpoints), names))
        return ingest(self, endpoints, failed)

    monkeypatch.setattr(Bronze, "ingest", noted)
    monkeypatch.setattr(landed, "home", lambda _spark: str(tmp_path / "home"))
    tables = racing(
        sessions=[{"session_key": k, "meeting_key": 1} for k in range(3)], drivers=[{"session_key": k, "driver_number": 4} for k in (0, 0, 5)]
    )
    wanted = ["sessions", "drivers", "pit"]
    raw = landed.streamed(spark, tables, wanted, parts=2)
    assert [e for e, _ in seen] == [["sessions"], ["drivers"], ["pit"]]
    assert all(n.startswith(f"{e[0]}/batch=part_") and n.endswith(".json.gz") for e, names in seen for n in names)
    assert [len(names) for _, names in seen] == [2, 2, 0]
    assert rows(bronze.ledger(raw, wanted)) == [("drivers", 3, 0, 2), ("pit", 0, 0, 0), ("sessions", 3, 0, 2)]
    assert not list((tmp_path / "home" / "landing").rglob("part-*"))
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
