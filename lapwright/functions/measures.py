"""Aggregate expressions whose value does not depend on the order of rows.

A floating-point sum changes in its last digits with the order in which
partial sums meet, so a plain mean differs between two runs on a cluster.
Summing as decimals is associative; only the final division is in doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DECIMAL = "decimal(28,10)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_total(c: Column | str) -> Column:
    """Sum over a group, as a decimal with ten places."""
    return F.sum(_col(c).try_cast(DECIMAL))


def mean_of(total: Column, count: Column) -> Column:
    """Mean from a decimal total and a row count; NULL where nothing was counted."""
    return total.cast("double") / F.nullif(count, F.lit(0))


def exact_mean(c: Column | str) -> Column:
    """Mean of the non-NULL values of a group.

    Where a value is no number of that many places (NaN, or 10**18 and more), it is the mean of doubles.
    """
    c = _col(c)
    fits = F.count(c.try_cast(DECIMAL)) == F.count(c)
    return F.when(fits, mean_of(exact_total(c), F.count(c))).otherwise(F.avg(c.cast("double")))


def rounded(c: Column | str, places: int) -> Column:
    """Half-up rounding of a measure.

    Through a decimal with ten places, so that a value whose last binary digit
    puts it just under a half is still rounded up.
    """
    exact = F.round(_col(c).try_cast(DECIMAL), places).cast("double")
    return F.coalesce(exact, F.round(_col(c).cast("double"), places))


def parts_of_mean(c: Column | str) -> dict[str, Column]:
    """Aggregates that add up over parts of a group and give its mean: see `mean_of_parts`."""
    c = _col(c)
    return {
        "n": F.count(c), "fit": F.count(c.try_cast(DECIMAL)), "total": exact_total(c), "rough_total": F.sum(c.cast("double")),
    }


def mean_of_parts(prefix: str = "") -> Column:
    """Mean from sums; of doubles only where a value is no decimal of ten places."""
    n, fit, total, rough = (F.col(f"{prefix}{p}") for p in ("n", "fit", "total", "rough_total"))
    return F.when(fit == n, mean_of(total, n)).otherwise(rough / F.nullif(n, F.lit(0)))


def parts_of_spread(c: Column | str) -> dict[str, Column]:
    """Those of the mean, and sums of squares for the standard deviation."""
    x = _col(c).cast("double")
    return {
        **parts_of_mean(c), "square_fit": F.count((x * x).try_cast(DECIMAL)), "squares": exact_total(x * x),
        "rough_squares": F.sum(x * x),
    }


def spread_of_parts() -> Column:
    """Sample standard deviation from sums; NULL for a single value."""
    n, fits = F.col("n"), (F.col("fit") == F.col("n")) & (F.col("square_fit") == F.col("n"))
    total = F.when(fits, F.col("total").cast("double")).otherwise(F.col("rough_total"))
    return stddev_of(n, total, F.when(fits, F.col("squares").cast("double")).otherwise(F.col("rough_squares")))


def stddev_of(count: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation from a count, a sum and a sum of squares; NULL for a single value."""
    n, s, q = (c.cast("double") for c in (count, total, squares))
    spread = F.greatest((q - s * s / n) / F.nullif(n - 1, F.lit(0.0)), F.lit(0.0))
    return F.when(count > 1, F.sqrt(spread))
