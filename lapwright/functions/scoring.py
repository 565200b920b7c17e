"""Points for a finishing position."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Points for places one to ten.
POINTS = (25, 18, 15, 12, 10, 8, 6, 4, 2, 1)


def championship_points(position: Column) -> Column:
    table = F.array(*[F.lit(p) for p in POINTS])
    return F.coalesce(F.get(table, position - 1), F.lit(0))
