"""File layout by several columns at once: rows that are near in each of them lie in the same files.

The rank of a value among all values of its column, in steps of equal size, is a whole number of a few bits. The bits of
several columns' ranks are interleaved, highest first, into one code, and the table is cut into ranges of the code. A
filter on any one of the columns then skips most files, where a sort by all columns helps the first of them alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 6


def cut_points(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list]:
    """Per column, the values at which its rows fall into steps of about equal size: fewer than 2 ** bits values.

    From quantile sketches that every task makes of its rows and that merge, so one pass serves all columns and no row
    leaves its task. Columns are whole numbers, doubles or timestamps.
    """
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    numbers = [_number(df, c) for c in columns]
    found = df.agg(*[F.percentile_approx(n, shares, 100 << bits).alias(f"q{i}") for i, n in enumerate(numbers)]).first()
    return {c: sorted(set(found[i] or ())) for i, c in enumerate(columns)}


def _number(df: DataFrame, column: str) -> Column:
    kind = dict(df.dtypes)[column]
    return F.unix_micros(F.col(column).cast("timestamp")) if kind.startswith("timestamp") else F.col(column)


def rank(value: Column, cuts: Sequence) -> Column:
    """How many cut points a value has reached, by halving: as many comparisons as the rank has bits. NULL comes first."""

    def within(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value < F.lit(cuts[middle]), within(low, middle)).otherwise(within(middle + 1, high))

    return F.when(value.isNull(), F.lit(0)).otherwise(within(0, len(cuts)))


def interleaved(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """One number of the bits of several, the highest bit of the first number first."""
    n = len(ranks)
    parts = [
        F.shiftleft(F.shiftright(r.cast("long"), b).bitwiseAND(1), b * n + (n - 1 - k))
        for k, r in enumerate(ranks) for b in range(bits)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def z_code(df: DataFrame, cuts: Mapping[str, Sequence], bits: int = BITS) -> Column:
    """The code of a row, from the ranks of its values among ``cuts``.

    The ranks of a column with few values are spread over all the bits, else it would count for little.
    """
    ranks = [F.floor(rank(_number(df, c), points) * (1 << bits) / (len(points) + 1)) for c, points in cuts.items()]
    return interleaved(ranks, bits)


def z_ordered(df: DataFrame, columns: Sequence[str], files: int, bits: int = BITS) -> DataFrame:
    """Rows in ``files`` ranges of their code, in order within each, for writing."""
    code = "__z"
    coded = df.withColumn(code, z_code(df, cut_points(df, columns, bits), bits))
    return coded.repartitionByRange(files, code).sortWithinPartitions(code, *columns).drop(code)
