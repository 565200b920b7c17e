"""Latest, first n and top rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__nth_of_group"


def latest_value(df: DataFrame, key: Sequence[str], value: str, at: str, name: str) -> DataFrame:
    """Value at the latest time per key; of two values at that time, the lower.

    An aggregate, not a window: every map task sends one row per key.
    """
    return df.groupBy(*key).agg(F.max_by(value, F.struct(F.col(at), -F.col(value))).alias(name))


def first_n(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], n: int) -> DataFrame:
    """First ``n`` rows per group; map tasks cut to ``n`` before the shuffle."""
    within = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(within)).where(F.col(_RANK) <= n).drop(_RANK)


def top_rows(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """First ``n`` rows of the whole frame.

    ``order`` has to end in columns that settle ties, or the answer may change
    between runs.
    """
    return df.orderBy(*order).limit(n)
