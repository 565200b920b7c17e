"""Exact quantiles for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def value_counts(df: DataFrame, keys: Sequence[str], value: str, weight: str | None = None) -> DataFrame:
    """Rows per distinct value, column ``n``; repeated values shrink before the shuffle."""
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(n.alias("n"))


def exact_quantile(
    counts: DataFrame, keys: Sequence[str], value: str, fraction: float, name: str, step: float = 0.25
) -> DataFrame:
    """Interpolated quantile per group, from ``value_counts``.

    The built-in exact percentile holds all distinct values of a group in one
    task. Here values are first counted in steps of ``step``; a running total
    over the steps tells in which one or two the wanted ranks lie, and only the
    values of those steps are ordered. Work per task depends on the step, not on
    the group.
    """
    keys = list(keys)
    stepped = counts.withColumn("__step", F.floor(F.col(value) / step))
    by_step = stepped.groupBy(*keys, "__step").agg(F.sum("n").alias("__size"))
    upto = Window.partitionBy(*keys).orderBy("__step").rowsBetween(Window.unboundedPreceding, -1)
    rank = (F.sum("__size").over(Window.partitionBy(*keys)) - 1) * F.lit(fraction)
    wanted = (
        by_step.withColumn("__before", F.coalesce(F.sum("__size").over(upto), F.lit(0)))
        .withColumn("__rank", rank)
        .where(
            (F.col("__before") <= F.ceil("__rank"))
            & (F.floor("__rank") < F.col("__before") + F.col("__size"))
        )
        .select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                F.col("__step").alias("__s"), "__before", "__rank")
    )
    # Null-safe throughout: a plain equality would add a filter to one reading of the
    # counts, and Spark reuses a shuffle only between equal plans.
    same = F.col("__step").eqNullSafe(F.col("__s"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    inside = Window.partitionBy(*keys, "__step").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    placed = stepped.join(wanted, same).withColumn(
        "__start", F.col("__before") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    )

    def at(rank_column):
        hit = (F.col("__start") <= rank_column) & (rank_column < F.col("__start") + F.col("n"))
        return F.max(F.when(hit, F.col(value)))

    below, above = at(F.floor("__rank")), at(F.ceil("__rank"))
    share = F.max(F.col("__rank") - F.floor("__rank"))
    return placed.groupBy(*keys).agg((below + (above - below) * share).alias(name))
