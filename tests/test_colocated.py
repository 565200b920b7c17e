"""Tables in buckets: joins without a shuffle, versions, uneven keys."""

import re

import pytest
from conftest import rows

import __spark_entry__ as entry
from lapwright.plans import dashboard, landed
from lapwright.plans.gold import GOLD
from lapwright.sources import files
from lapwright.sources.colocated import Colocated, is_even

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def derived(spark):
    return entry.racing_tables(spark, FOLDER)


@pytest.fixture(scope="module")
def kept(spark, derived):
    return landed.colocated(spark, derived, ["silver_sessions", "gold_driver_performance", "gold_fastest_laps"])


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def exchanges(df):
    plan = re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())
    return [line for line in plan.splitlines() if re.search("Exchange", line)]


def test_drivers_meet_their_states_without_a_shuffle(kept, no_broadcast):
    assert exchanges(GOLD["gold_driver_performance"](kept)) == []


def test_only_the_rank_shuffles_best_laps(kept, no_broadcast):
    found = exchanges(GOLD["gold_fastest_laps"](kept))
    assert len(found) == 1 and "hashpartitioning(session_key, " in found[0]


def test_sessions_meet_their_drivers_without_a_shuffle(kept, no_broadcast):
    found = exchanges(dashboard.driver_comparison(kept, "2024-04-04"))
    assert len(found) == 1 and "rangepartitioning" in found[0]  # the order of the answer


def test_rows_are_those_of_derived_tables(kept, derived):
    for name in ("silver_drivers", "gold_driver_performance", "gold_fastest_laps"):
        columns = derived[name].columns
        assert rows(kept[name], *columns) == rows(derived[name], *columns)


def test_versions(spark, tmp_path):
    store = Colocated(spark, str(tmp_path), buckets=4)
    df = spark.range(100).selectExpr("id % 7 as session_key", "id")
    assert store.write("t", df, ["session_key"])
    reader = store.tables(["t"])["t"]
    assert store.write("t", df.where("id < 50"), ["session_key"])
    assert reader.count() == 100 and store.tables(["t"])["t"].count() == 50
    store.write("t", df.limit(0), ["session_key"])
    assert store.tables(["t"])["t"].count() == 0
    assert sorted(files.child_names(spark, f"{tmp_path}/t")) == ["v=2", "v=3"]
    store.drop()
    assert not spark.catalog.tableExists(f"{store.prefix}t")


def test_null_keys_and_uneven_keys(spark, tmp_path):
    store = Colocated(spark, str(tmp_path), buckets=8)
    df = spark.range(60).selectExpr("if(id % 3 = 0, null, id % 5) as session_key", "id")
    assert store.write("nulls", df, ["session_key"])
    assert rows(store.tables(["nulls"])["nulls"]) == rows(df)
    hot = spark.range(300_000).selectExpr("if(id % 3 < 2, 1, id) as session_key", "id")
    assert not is_even(hot, ["session_key"], 8) and is_even(hot, ["id"], 8)
    assert not store.write("hot", hot, ["session_key"])
    assert store.tables(["hot"])["hot"].count() == 300_000
    assert is_even(hot.limit(0), ["session_key"], 8)
