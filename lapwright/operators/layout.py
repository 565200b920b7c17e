"""File layout: rows of one key in few files, sorted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def clustered(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bring rows of the first key together and sort by all keys, for writing.

    Readers that filter by key then skip nearly all row groups by their minimum and
    maximum. ``rebalance`` needs no pass to sample the rows, as ranges would; it cuts
    a partition that one common key has made too large into several files, and puts
    small ones together.
    """
    if not keys:
        return df
    return df.hint("rebalance", keys[0]).sortWithinPartitions(*keys)
