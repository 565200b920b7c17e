"""One row per key, the same one on every run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__nth_of_key"


def keep_first(
    df: DataFrame, key: Sequence[str], order: Sequence[str] | None = None, prefer: Column | None = None
) -> DataFrame:
    """Keep, per key, the row that sorts first by all other columns (NULL last).

    ``order`` lists the columns to sort by where others are known to be constant.
    Rows for which ``prefer`` is true come before all others.

    Ordering by every other column makes the survivor independent of row order
    and partitioning: rows that still tie are equal. The ``= 1`` filter lets
    Spark cut each map task to one row per key before the shuffle
    (``WindowGroupLimit``), so a key with very many copies costs one row per task.

    A hash of the key is put in front of it. A sort compares the first column
    fastest, and the hash alone nearly always decides. It also keeps this shuffle
    apart from that of a later join on the key: adaptive execution splits a hot join
    key only where both sides were shuffled for the join.
    """
    others = [F.col(f"`{c}`").asc_nulls_last() for c in (order or df.columns) if c not in key]
    if prefer is not None:
        others.insert(0, F.coalesce(prefer, F.lit(False)).desc())
    if not others:
        return df.distinct()
    per_key = Window.partitionBy(F.xxhash64(*key), *key).orderBy(*others)
    return df.select("*", F.row_number().over(per_key).alias(_RANK)).where(F.col(_RANK) == 1).drop(_RANK)
