"""Join of points with the intervals that contain them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SLOT = "__slot"


def points_in_intervals(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    point: str,
    low: str,
    high: str,
    width: int = 16,
    slots: int = 1024,
) -> DataFrame:
    """Inner join on ``keys`` where ``low <= point <= high``.

    The number line is cut into steps of ``width``, and steps are numbered round
    ``slots``. A point has one slot; an interval is repeated for the slots it
    touches, one or two for a usual interval and never more than ``slots`` however
    wide it is. The slot joins the equality keys, so points of a single hot key
    spread over many tasks. The bounds are still compared, hence nothing is
    matched wrongly or twice, and NULL bounds match nothing.
    """
    first = F.floor(F.col(low) / width)
    last = F.least(F.floor(F.col(high) / width), first + slots - 1)
    spread = intervals.where(F.col(low) <= F.col(high)).withColumn(
        _SLOT, F.explode(F.transform(F.sequence(first, last), lambda step: F.pmod(step, F.lit(slots)).cast("int")))
    )
    placed = points.withColumn(_SLOT, F.pmod(F.floor(F.col(point) / width), F.lit(slots)).cast("int"))
    return (
        placed.join(spread, [*keys, _SLOT], "inner")
        .where(F.col(point).between(F.col(low), F.col(high)))
        .drop(_SLOT)
    )
