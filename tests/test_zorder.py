"""Layout by several columns: codes, ranks, and what a filter skips."""

import glob
import random

import pyarrow.parquet as pq

from pyspark.sql import functions as F
from lapwright.operators.zorder import cut_points, interleaved, rank, z_ordered


def test_ranks_and_bits(spark):
    draw = random.Random(1)
    values = [draw.randrange(-50, 50) for _ in range(200)] + [None]
    cuts = sorted({draw.randrange(-50, 50) for _ in range(9)})
    df = spark.createDataFrame([(v,) for v in values], "v int")
    for r in df.select("v", rank(F.col("v"), cuts).alias("k")).collect():
        assert r.k == (0 if r.v is None else sum(c <= r.v for c in cuts))
    assert {r.k for r in df.select(rank(F.col("v"), []).alias("k")).collect()} == {0}
    pairs = spark.createDataFrame([(draw.randrange(64), draw.randrange(64), draw.randrange(64)) for _ in range(50)], "a int, b int, c int")
    for r in pairs.select("*", interleaved([F.col("a"), F.col("b"), F.col("c")]).alias("z")).collect():
        bits = "".join(f"{r.a:06b}"[i] + f"{r.b:06b}"[i] + f"{r.c:06b}"[i] for i in range(6))
        assert r.z == int(bits, 2)


def test_steps_hold_about_as_many_rows(spark):
    df = spark.range(10_000).selectExpr("id * id as v", "timestamp_micros(id * 1000) as t", "cast(null as int) as n")
    cuts = cut_points(df, ["v", "t", "n"], bits=4)
    assert len(cuts["v"]) == len(cuts["t"]) == 15 and cuts["n"] == []
    sizes = [r["count"] for r in df.groupBy(rank(F.col("v"), cuts["v"])).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 1.2 * min(sizes)


def test_a_filter_on_any_column_skips_most_files(spark, tmp_path):
    base = spark.range(0, 60_000, 1, 4)
    df = base.selectExpr("cast(pmod(hash(id), 100) as int) as session_key", "cast(pmod(hash(id, 1), 20) as int) as driver_number", "id")
    z_ordered(df, ["session_key", "driver_number"], 128).write.parquet(f"{tmp_path}/z")
    back = spark.read.parquet(f"{tmp_path}/z")
    assert back.count() == 60_000 and back.columns == df.columns
    groups = [
        [(c.statistics.min, c.statistics.max) for c in (meta.row_group(g).column(k) for k in (0, 1))]
        for f in glob.glob(f"{tmp_path}/z/*.parquet") for meta in [pq.ParquetFile(f).metadata] for g in range(meta.num_row_groups)
    ]
    for column, value in ((0, 17), (1, 7)):
        met = sum(g[column][0] <= value <= g[column][1] for g in groups)
        assert met <= len(groups) / 4, (column, met, len(groups))
    assert z_ordered(df.limit(0), ["session_key", "driver_number"], 4).count() == 0
