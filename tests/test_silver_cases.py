"""Casts, one row per key, and rules, on hand-written rows."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lapwright.operators import conform, enforce, keep_first, observed, violations
from lapwright.plans.silver import clean
from lapwright.schemas import TABLES


def raw(spark, ddl, *values):
    return spark.createDataFrame(list(values), ddl)


def test_text_that_does_not_parse_becomes_null(spark):
    df = raw(spark, "lap_number string, lap_duration string, is_pit_out_lap string",
             ("1.9", "n/a", "maybe"), ("2", "90.5", "true"))
    assert rows(conform(df, TABLES["laps"]), "lap_number", "lap_duration", "is_pit_out_lap") == [
        (2, 90.5, True), (None, None, None)]


def test_lapped_gap_becomes_null(spark):
    df = raw(spark, "gap_to_leader string", ("+1 LAP",), ("1.25",))
    assert rows(conform(df, TABLES["intervals"]), "gap_to_leader") == [(1.25,), (None,)]


def test_segments_keep_their_written_form(spark):
    df = raw(spark, "segments_sector_1 array<int>", ([2049, None],))
    assert rows(conform(df, TABLES["laps"]), "segments_sector_1") == [("[2049, null]",)]


def test_times_are_utc(spark):
    df = raw(spark, "date string", ("2024-03-01T15:00:00.123456+01:00",))
    text = conform(df, TABLES["pit"]).select(F.date_format("date", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    assert text.first()[0] == "2024-03-01 14:00:00.123456"


def test_all_columns_in_order_even_if_none_arrived(spark):
    for spec in TABLES.values():
        assert clean(raw(spark, "session_key int"), spec.endpoint).schema == spec.schema


def test_open_tables_keep_further_columns(spark):
    got = clean(raw(spark, "session_key string, points double", ("7", 1.5)), "session_result").first()
    assert (got.session_key, got.points, got.position) == (7, 1.5, None)


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_survivor_does_not_depend_on_order_or_partitions(spark, partitions):
    copies = [(1, 44, n % 3, None if n % 5 == 0 else float(n % 4), n) for n in range(200)]
    ddl = "session_key int, driver_number int, lap_number int, lap_duration double, st_speed int"
    key = ["session_key", "driver_number", "lap_number"]
    expected = rows(keep_first(raw(spark, ddl, *copies).coalesce(1), key))
    shuffled = raw(spark, ddl, *copies[::-1]).repartition(partitions)
    assert rows(keep_first(shuffled, key)) == expected
    assert [r[3] for r in expected] == [0.0, 0.0, 0.0]  # NULL last


def test_null_is_a_key(spark):
    df = raw(spark, "k int, v int", (None, 2), (None, 1), (3, 4))
    assert rows(keep_first(df, ["k"])) == [(3, 4), (None, 1)]


def test_unknown_year_is_dropped_and_unknown_duration_kept(spark):
    meetings = raw(spark, "meeting_key int, year int", (1, None), (2, 2024), (None, 2024), (3, 2017), (4, 2030), (5, 2018))
    assert rows(clean(meetings, "meetings"), "meeting_key") == [(2,), (4,), (5,)]
    laps = raw(spark, "lap_number int, lap_duration double", (1, None), (2, 90.0), (3, -1.0), (4, 0.0), (0, 90.0), (None, 90.0))
    assert rows(clean(laps, "laps"), "lap_number") == [(1,), (2,)]


def test_a_good_copy_survives_a_bad_one(spark):
    df = raw(spark, "session_key int, driver_number int, lap_number int, lap_duration double",
             (1, 1, 1, -5.0), (1, 1, 1, 90.0), (1, 1, 2, -5.0), (1, 1, 2, -6.0), (1, 1, 3, float("nan")))
    assert rows(clean(df, "laps"), "lap_number", "lap_duration") == [(1, 90.0), (3, None)]


def test_means_of_odd_values(spark):
    from lapwright.functions import exact_mean, rounded

    df = raw(spark, "k int, x double", (1, 90.0), (1, None), (2, 2e18), (2, 4e18), (3, None))
    assert rows(df.groupBy("k").agg(exact_mean("x").alias("m"))) == [(1, 90.0), (2, 3e18), (3, None)]
    assert rows(df.select("k", rounded("x", 1).alias("r")).where("r is not null")) == [(1, 90.0), (2, 2e18), (2, 4e18)]


def test_warning_rules_keep_rows_and_count(spark):
    spec = TABLES["car_data"]
    df = conform(raw(spark, "speed int, rpm int", (100, 9000), (401, 9000), (None, 20000), (400, 15000)), spec)
    assert enforce(df, spec).count() == 4
    got = [tuple(r) for r in violations(df, spec).select("rule", "action", "passed", "failed").collect()]
    assert got == [("valid_speed", "warn", 2, 2), ("valid_rpm", "warn", 3, 1)]


def test_violations_are_counted_while_a_table_is_written(spark):
    from pyspark.sql import Observation

    spec, seen = TABLES["car_data"], Observation("telemetry")
    df = conform(raw(spark, "speed int, rpm int", (401, 1), (1, None)), spec)
    observed(df, spec, seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 2, "valid_speed": 1, "valid_rpm": 1}
