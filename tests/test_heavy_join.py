"""Joins by slots of frequent keys give what plain joins give, in even tasks."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lapwright.operators import heavy_keys, join_heavy, join_rows
from lapwright.plans import app, dashboard
from test_skew import ROWS, skewed  # noqa: F401

OFF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.enabled": "false",
    "spark.sql.adaptive.skewJoin.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def no_skew_handling(spark):
    before = {k: spark.conf.get(k, None) for k in OFF}
    for k, v in OFF.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def _tasks(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("task")).count().collect())


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_tasks_are_even_without_adaptive_execution(spark, no_skew_handling, skewed, how):  # noqa: F811
    rows, names = skewed["silver_position"], skewed["silver_drivers"].select("session_key", "driver_number", "team_name")
    if how == "left_anti":
        names = names.where("session_key < 0")
    on = ["session_key", "driver_number"]
    plain, spread = _tasks(rows.join(names, on, how)), _tasks(join_heavy(rows, names, on, how))
    assert sum(spread) == sum(plain) == ROWS
    assert plain[-1] > 3 * plain[len(plain) // 2]
    assert spread[-1] < 2 * spread[len(spread) // 2]


def test_answers_take_slots_where_nothing_else_splits(spark, no_skew_handling, skewed):  # noqa: F811
    for answer in (app.positions, app.race_pits, dashboard.pit_stops, dashboard.incidents):
        more = {"as_of": "2024-04-01"} if answer in (dashboard.pit_stops, dashboard.incidents) else {}
        plan = answer(skewed, **more)._jdf.queryExecution().optimizedPlan().toString()
        assert "approx_top_k" in plan and "__slot" in plan


def test_adaptive_sessions_keep_the_plain_join(spark, skewed):  # noqa: F811
    assert "__slot" not in app.positions(skewed)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_same_rows_as_the_plain_join(spark, how):
    r = random.Random(7)
    keys = [None, 1, 1, 1, 1, *range(2, 30)]
    # Equal rows, null keys, keys on one side only, several rows of a key on the other side.
    rows = spark.createDataFrame([(r.choice(keys), r.choice("ab"), r.randrange(5)) for _ in range(3000)], "k int, l string, x int")
    other = spark.createDataFrame([(k, l, f"{k}{l}{i}") for k in [None, *range(1, 25)] for l in "abc" for i in range(2)], "k int, l string, y string")
    for a, b in ((rows, other), (rows.limit(0), other), (rows, other.limit(0))):
        plain, spread = a.join(b, ["k", "l"], how), join_heavy(a, b, ["k", "l"], how, tasks=8)
        assert spread.columns == plain.columns
        assert Counter(map(tuple, spread.collect())) == Counter(map(tuple, plain.collect()))


def test_frequent_keys_are_found_and_few(spark):
    rows = spark.range(200_000).select(F.when(F.col("id") % 3 == 0, -5).when(F.col("id") % 20 == 1, -6).otherwise(F.col("id")).alias("k"))
    found = {x["__key"]: x["__slots"] for x in heavy_keys(rows, ["k"], 16).collect()}
    hashes = [x[0] for x in spark.createDataFrame([(-5,), (-6,)], "k long").select(F.xxhash64("k")).collect()]
    # A third of all rows is 5.3 of 16 shares, a thirtieth of them about half of one.
    assert set(found) <= set(hashes) and 80 <= found[hashes[0]] <= 90
    assert heavy_keys(rows.where("k > 0"), ["k"], 16).count() == 0
    assert heavy_keys(rows.limit(0), ["k"], 16).count() == 0


def test_joins_that_keep_the_other_side_are_refused(spark):
    rows = spark.range(3)
    with pytest.raises(ValueError):
        join_heavy(rows, rows, ["id"], "full")
    assert join_rows(rows, rows, ["id"], spread=True).count() == 3
