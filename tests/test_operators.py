"""Operators against brute force, with one key that holds a large part of the rows."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lapwright.functions import exact_mean, fixed_point, session_label
from lapwright.operators import clustered, exact_quantile, first_n, latest_value, points_in_intervals
from lapwright.operators.quantiles import value_counts


def _numbers(n, seed):
    return random.Random(seed), range(n)


@pytest.mark.parametrize("slots", [1, 4, 1024])
def test_interval_join(spark, slots):
    rnd, every = _numbers(400, 1)
    points = [(0 if i % 3 == 0 else rnd.randint(1, 5), rnd.randint(-40, 300), i) for i in every]
    intervals = [(rnd.randint(0, 5), a, a + rnd.choice([-2, 0, 3, 30, 5000]), i)
                 for i, a in ((i, rnd.randint(-50, 300)) for i in range(60))]
    intervals += [(0, None, 5, 900), (0, 5, None, 901), (1, -10, 2_000_000_000, 902)]
    got = points_in_intervals(
        spark.createDataFrame(points, "k int, p int, i int"),
        spark.createDataFrame(intervals, "k int, lo int, hi int, j int"),
        ["k"], "p", "lo", "hi", slots=slots,
    )
    want = sorted((i, j) for (k, p, i), (k2, lo, hi, j) in itertools.product(points, intervals)
                  if k == k2 and lo is not None and hi is not None and lo <= p <= hi)
    assert sorted(tuple(r) for r in got.select("i", "j").collect()) == want


def test_interval_join_spreads_a_hot_key(spark):
    points = spark.range(64_000).selectExpr("cast(id div 1000000 as int) as k", "cast(id as int) as p")
    lines = spark.createDataFrame([(0, 0, 1_000_000)], "k int, lo int, hi int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = points_in_intervals(points, lines.hint("merge"), ["k"], "p", "lo", "hi")
        assert "SortMergeJoin [k" in joined._jdf.queryExecution().executedPlan().toString()
        per_task = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # All points have one key, yet every task gets a share.
    assert sum(per_task) == 64_000 and len(per_task) == 4 and max(per_task) < 32_000


@pytest.mark.parametrize("fraction", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_quantiles(spark, fraction):
    rnd, every = _numbers(3000, 2)
    data = [("hot" if i % 3 else rnd.choice(["a", "b", None]), round(rnd.uniform(-5, 95), rnd.choice([0, 1, 5])))
            for i in every] + [("one", 7.5), ("void", None)]
    df = spark.createDataFrame(data, "g string, x double")
    got = exact_quantile(value_counts(df, ["g"], "x"), ["g"], "x", fraction, "q")
    want = df.where("x is not null").groupBy("g").agg(F.percentile("x", fraction).alias("q"))
    assert {r.g: round(r.q, 9) for r in got.collect()} == {r.g: round(r.q, 9) for r in want.collect()}


def test_exact_mean_is_the_same_in_any_partitioning(spark):
    rnd, every = _numbers(5000, 3)
    df = spark.createDataFrame([(rnd.uniform(0, 100),) for _ in every] + [(None,)], "x double")
    means = {df.repartition(n).agg(exact_mean("x")).first()[0] for n in (1, 2, 7, 16)}
    assert len(means) == 1
    assert abs(means.pop() - df.agg(F.avg("x")).first()[0]) < 1e-9
    assert df.where("x < 0").agg(exact_mean("x")).first()[0] is None


def test_latest_and_first(spark):
    df = spark.createDataFrame([(1, 1, 9), (1, 2, 5), (1, 2, 3), (2, 1, None)], "k int, at int, v int")
    assert rows(latest_value(df, ["k"], "v", "at", "last")) == [(1, 3), (2, None)]
    listed = spark.createDataFrame([(s, d) for s in (1, 2) for d in range(9)], "s int, d int")
    top = first_n(listed, ["s"], ["d"], 5)
    assert rows(top) == [(s, d) for s in (1, 2) for d in range(5)]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_layout_splits_a_hot_key_and_sorts(spark, tmp_path):
    df = spark.range(300_000).repartition(6).selectExpr(
        "case when id % 3 = 0 then 7 else cast(id as int) end as k", "cast(hash(id) as int) as d", "uuid() as v")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256kb")
    try:
        clustered(df, ["k", "d"]).write.parquet(f"{tmp_path}/t")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    written = spark.read.parquet(f"{tmp_path}/t").select("*", F.input_file_name().alias("f"))
    assert written.count() == 300_000
    assert written.where("k = 7").select("f").distinct().count() > 3
    seen = {}
    for path, k, d in written.where("k = 7 or k < 1000").select("f", "k", "d").toPandas().itertuples(index=False):
        assert seen.get(path, (k, d)) <= (k, d)
        seen[path] = (k, d)


def test_wording(spark):
    row = spark.sql("select 90.0005D as x, 3.25D as y, 312 as z, 'Spa' as l, 'Race' as t, timestamp '2024-03-01 14:00:00' as d").select(
        fixed_point(F.col("x"), 3), fixed_point(F.col("y"), 1), fixed_point(F.col("z"), 0),
        session_label(F.col("l"), F.col("t"), F.col("d"))).first()
    assert tuple(row) == ("90.001", "3.3", "312", "Spa - Race (2024-03-01 14:00:00)")
