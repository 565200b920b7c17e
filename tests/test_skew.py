"""One session holds a third of all rows: no task may be left with all of them."""

import pytest
from pyspark.sql import functions as F

from lapwright.operators import conform, keep_first
from lapwright.plans import app, dashboard, explore
from lapwright.plans.catalog import derived_tables
from lapwright.schemas import TABLES

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64kb",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64kb",
}
ROWS = 120_000


@pytest.fixture
def small_shuffles(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.fixture
def skewed(spark):
    """Session 0 has a third of the rows of every large table, most of them of one driver."""
    keys = ("case when id % 3 = 0 then 0 else cast(id % 400 as int) + 1 end as session_key",
            "case when id % 3 = 0 then 44 else cast(id % 20 as int) end as driver_number")
    base = spark.range(0, ROWS, 1, 8)
    at = "timestamp_micros(1704067200000000 + id * 1000) as date"
    frames = {
        "laps": base.selectExpr(
            *keys, "cast(id as int) + 1 as lap_number", "60 + (id * 7919) % 40000 / 1000 as lap_duration",
            "id % 10 = 0 as is_pit_out_lap"),
        "pit": base.selectExpr(*keys, at, "cast(id as int) as lap_number", "20 + id % 977 / 100 as pit_duration"),
        "position": base.selectExpr(*keys, at, "cast(id % 20 as int) + 1 as position"),
        "race_control": base.selectExpr(*keys, at, "'RED' as flag", "cast(id as string) as message"),
        "sessions": spark.range(401).selectExpr(
            "cast(id as int) as session_key", "1 as meeting_key", "'Race' as session_type", "'S' as session_name",
            "cast(id % 7 as string) as location", "'C' as circuit_short_name",
            "timestamp '2024-03-01 14:00:00' as date_start", "2024 as year"),
        "drivers": spark.range(401 * 45).selectExpr(
            "cast(id div 45 as int) as session_key", "cast(id % 45 as int) as driver_number",
            "concat('D', id % 45) as full_name", "concat('T', id % 10) as team_name", "1 as meeting_key"),
    }
    for endpoint, spec in TABLES.items():
        frames.setdefault(endpoint, spark.createDataFrame([], spec.schema))
    return derived_tables(frames)


@pytest.mark.parametrize(
    "answer", [lambda t: app.positions(t), lambda t: dashboard.pit_stops(t, as_of="2024-04-01"),
               lambda t: dashboard.incidents(t, as_of="2024-04-01")],
    ids=["positions", "pit_stops", "incidents"],
)
def test_joins_of_large_tables_are_split(spark, small_shuffles, skewed, answer):
    df = answer(skewed)
    df.collect()
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_equal_lap_times_are_counted_before_the_join(spark, skewed):
    plan = explore.lap_distribution(skewed)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner, (session_key" in line]
    below = plan.split(joins[0], 1)[1].lstrip()
    assert joins and "Aggregate [session_key" in below.splitlines()[0] + below.splitlines()[1]


def test_median_of_a_hot_circuit_is_exact(spark, skewed):
    got = {r.location: r for r in explore.lap_distribution(skewed).collect()}
    laps = skewed["silver_laps"].where("not is_pit_out_lap").join(skewed["silver_sessions"], "session_key")
    want = laps.groupBy("location").agg(
        F.median("lap_duration").alias("m"), F.stddev("lap_duration").alias("s"), F.count("*").alias("n"))
    for r in want.collect():
        assert got[r.location].total_laps == r.n and abs(got[r.location].median_lap - r.m) < 1e-9
        assert abs(got[r.location].lap_consistency - r.s) < 1e-5


def test_copies_of_one_key_are_cut_before_the_shuffle(spark):
    copies = spark.range(0, ROWS, 1, 8).selectExpr(
        "case when id % 3 = 0 then 0 else cast(id as int) end as session_key", "1 as driver_number", "1 as lap_number",
        "cast(id % 1000 as double) + 1 as lap_duration")
    kept = keep_first(conform(copies, TABLES["laps"]), TABLES["laps"].key)
    written = _shuffled_rows(spark, kept)
    # Two thirds are single rows; the hot key adds at most one row for each of eight tasks.
    assert written <= ROWS * 2 // 3 + 8


def test_groups_are_reduced_before_the_shuffle(spark, skewed):
    laps = skewed["bronze_laps"]
    per_driver = laps.groupBy("session_key", "driver_number").agg(F.count(F.lit(1)).alias("n"))
    assert _shuffled_rows(spark, per_driver) < ROWS // 2


def _shuffled_rows(spark, df) -> int:
    """Rows that the first shuffle of a frame wrote."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    return _find(node.finalPhysicalPlan())


def _find(node) -> int:
    if node.nodeName().startswith("Exchange"):
        return node.metrics().apply("shuffleRecordsWritten").value()
    if node.nodeName() in ("ShuffleQueryStage", "ResultQueryStage"):
        return _find(node.plan())
    children = node.children()
    for i in range(children.size()):
        found = _find(children.apply(i))
        if found is not None:
            return found
    return None
